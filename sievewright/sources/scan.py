"""Parquet tables for work that is heavy per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(rows: DataFrame) -> DataFrame:
    """The same rows, dealt to all cores where they come from fewer files than there are cores.

    A row group is read by one task, so a table of one small file would keep one core busy. Tables of many files, as all large ones are, stay as they are: nothing is shuffled.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if 0 < len(rows.inputFiles()) < cores else rows


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spread(spark.read.parquet(path))
