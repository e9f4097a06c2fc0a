"""What an analyst does with one file: parse and preview it, profile its fields, list a field's values."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.operators import explore
from sievewright.sources import jsonl, tabular, xml


def parse_file(spark: SparkSession, path: str, row_tag: str = "Designation", sheet: int | str = 0) -> DataFrame:
    """record (JSON text) of an .xml, .csv, .xlsx or .jsonl file, by its suffix; another one is a ValueError."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix == ".xml":
        return xml.read(spark, path, row_tag)
    if suffix == ".jsonl":
        return jsonl.read(spark, path).select("record")
    if suffix in (".csv", ".xlsx"):
        rows = tabular.read_csv(spark, path) if suffix == ".csv" else tabular.read_xlsx(spark, path, sheet)
        return rows.select(jsonl.line("*").alias("record"))
    raise ValueError(f"unsupported suffix {suffix!r}")


def show(records: DataFrame, limit: int = 50) -> list[str]:
    """The first records, for the eye."""
    return [r[0] for r in records.limit(limit).collect()]


def profile(spark: SparkSession, path: str) -> DataFrame:
    """The schema profile of a JSON lines file."""
    return explore.schema_profile(spark.read.text(path))


def profile_errors(spark: SparkSession, path: str) -> DataFrame:
    """The lines that a profile leaves out: path, line, record, error."""
    return jsonl.errors(spark, path)


def values(spark: SparkSession, path: str, field: str) -> tuple[DataFrame, DataFrame]:
    """The distinct non-blank values of a field of a JSON lines file, and its malformed lines."""
    records = jsonl.read(spark, path)
    return explore.distinct_values(records, field, blanks=False), records.where(F.col("v").isNull()).select("record")
