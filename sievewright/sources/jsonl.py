"""JSON lines in and out."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """record (text), v (VARIANT; null for a malformed line) of non-blank lines; strict: a malformed line fails."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.col("value").alias("record"), (F.parse_json("value") if strict else F.try_parse_json("value")).alias("v"))


def errors(spark: SparkSession, path: str) -> DataFrame:
    """path, line, record, error of the malformed non-blank lines; lines are numbered from 1 in each file.

    Lines of a block are numbered where they are read; only one number a block is added up.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("path", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    starts = blocks.select("path", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    wrong = lines.where((F.trim("value") != "") & F.try_parse_json("value").isNull()).join(starts, ["path", "block"])
    return wrong.select("path", (F.col("id") + F.col("shift")).alias("line"), F.col("value").alias("record"), _reason("value").alias("error"))


def _reason(x: Column | str) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_why)

    return F.pandas_udf(run, "string")(x)


def _why(text: str) -> str:
    try:
        json.loads(text)
    except ValueError as e:
        return str(e)
    return "not accepted"


def line(*columns: Column | str) -> Column:
    """One object a line; nulls are written."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write(records: DataFrame, path: str, column: str = "record", mode: str = "overwrite") -> None:
    records.select(F.col(column).alias("value")).write.mode(mode).text(path)
