"""One stage at a time, from file to file: ingestion to JSON lines, pre-normalisation, mapping, post-normalisation."""

from __future__ import annotations

from datetime import datetime
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.plans import mapping, postnorm, prenorm
from sievewright.sources import jsonl, tabular, xml


def rule_table(spark: SparkSession, path: str, sheet: int | str = 0) -> list[dict[str, str | None]]:
    """The rows of a rule table (.xlsx, .csv, or JSON lines); blank cells are None. Rule tables are small and held by the driver."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix in (".jsonl", ".json"):
        return [r.asDict() for r in spark.read.json(path).collect()]
    if suffix not in (".xlsx", ".csv"):
        raise ValueError(f"unsupported suffix {suffix!r}")
    rows = tabular.read_xlsx(spark, path, sheet) if suffix == ".xlsx" else tabular.read_csv(spark, path)
    return [{k: v or None for k, v in r.asDict().items()} for r in rows.collect()]


def raw_name(path: str, now: datetime | None = None) -> str:
    """`stem_raw.jsonl`, or with a time `stem_time.jsonl`, beside the file."""
    p = PurePosixPath(path)
    return str(p.with_name(f"{p.stem}_{now:%Y%m%d_%H%M%S}.jsonl" if now else f"{p.stem}_raw.jsonl"))


def ingest_xml(spark: SparkSession, path: str, out: str | None = None, row_tag: str = "Designation") -> int:
    """Writes an XML file's records as JSON lines; returns their number."""
    out = out or raw_name(path)
    jsonl.write(xml.read(spark, path, row_tag), out)
    return spark.read.text(out).count()


def ingest_table(spark: SparkSession, path: str, out: str | None = None, sheet: int | str = 0) -> int:
    """Writes a CSV or XLSX file's rows as JSON lines; returns their number."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix not in (".csv", ".xlsx"):
        raise ValueError(f"unsupported suffix {suffix!r}")
    rows = tabular.read_csv(spark, path) if suffix == ".csv" else tabular.read_xlsx(spark, path, sheet)
    out = out or raw_name(path, datetime.now())
    jsonl.write(rows.select(jsonl.line("*").alias("record")), out)
    return spark.read.text(out).count()


def _written(records: DataFrame, out: str) -> DataFrame:
    jsonl.write(records, out)
    return records


def pre_normalize_file(spark: SparkSession, source: str, path: str, out: str, rules: str, configs: str) -> DataFrame:
    plan = prenorm.compile_rules(*prenorm.load(rule_table(spark, rules), rule_table(spark, configs)), source)
    return _written(prenorm.normalize_records(jsonl.read(spark, path, strict=True).select("record"), plan), out)


def map_file(spark: SparkSession, path: str, rules: str, out: str, source: str) -> DataFrame:
    records = jsonl.read(spark, path, strict=True)
    return _written(mapping.map_records(records, mapping.load_rules(rule_table(spark, rules), source)).select(F.col("mapped").alias("record")), out)


def post_normalize_file(spark: SparkSession, path: str, rules: str, out: str) -> DataFrame:
    made = postnorm.load(rule_table(spark, rules))
    records = jsonl.read(spark, path, strict=True)
    return _written(records.select(postnorm.post_normalize(F.col("record"), made).alias("record")), out)
