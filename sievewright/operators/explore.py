"""Exploration of JSON records: schema profile, distinct values, preview."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import paths
from sievewright.functions.text import strip


def _kind(value) -> str:
    for kind, name in ((type(None), "null"), (bool, "boolean"), (int, "integer"), (float, "float"), (str, "string"), (list, "array")):
        if isinstance(value, kind):
            return name
    return "object"


def _walk(value, path: str, out: dict) -> None:
    """Counts (path, type) of keyed values; a list also counts once as path[] of type array, its items only through their fields."""
    if isinstance(value, dict):
        for key, own in value.items():
            inner = f"{path}.{key}" if path else str(key)
            out[inner, _kind(own)] = out.get((inner, _kind(own)), 0) + 1
            _walk(own, inner, out)
    elif isinstance(value, list):
        out[f"{path}[]", "array"] = out.get((f"{path}[]", "array"), 0) + 1
        for item in value:
            _walk(item, f"{path}[]", out)


def schema_profile(records: DataFrame, column: str = "value") -> DataFrame:
    """field, type, optional, occurrences of every path in JSON lines; blank and malformed lines are left out (`jsonl.errors` lists these).

    Each task counts its own records first, so that the shuffle has a row for each path, type and batch. `optional` compares a path's count with the number of
    records: fields below lists can exceed it and then read as not optional.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for batch in batches:
            sums: dict = {}
            for line in batch["line"]:
                try:
                    record = json.loads(line) if isinstance(line, str) and line.strip() else None
                except ValueError:
                    record = None
                if isinstance(record, dict):
                    sums["", "record"] = sums.get(("", "record"), 0) + 1
                    _walk(record, "", sums)
            yield pd.DataFrame([(p, t, n) for (p, t), n in sums.items()], columns=["field", "type", "n"]).astype({"field": "str", "type": "str", "n": "int64"})

    counts = records.select(F.col(column).cast("string").alias("line")).mapInPandas(run, "field string, type string, n long").groupBy("field", "type").agg(F.sum("n").alias("n"))
    of_field = counts.groupBy("field").agg(F.array_join(F.array_sort(F.collect_set("type")), " | ").alias("type"), F.sum("n").alias("occurrences"))
    total = of_field.where("type = 'record' and field = ''").select(F.col("occurrences").alias("records"))
    rows = of_field.where("field <> ''").crossJoin(F.broadcast(total.agg(F.max("records").alias("records"))))  # one row
    return rows.select("field", "type", (F.col("occurrences") < F.col("records")).alias("optional"), "occurrences")


def write_profile(profile: DataFrame, path: str) -> None:
    """The profile as one JSON file of {field, type, optional, occurrences}, by field."""
    profile.orderBy("field").coalesce(1).write.mode("overwrite").json(path)


def values_at(record: Column, path: str) -> Column:
    """Trimmed texts of all scalar, non-null values at a path of a VARIANT record (explorer dialect)."""
    scalar = F.filter(paths.explore(record, path), lambda v: ~F.is_variant_null(v) & ~F.schema_of_variant(v).rlike("^(ARRAY|OBJECT)"))
    return F.transform(scalar, lambda v: strip(paths.text(v)))


def distinct_values(records: DataFrame, path: str, column: str = "v", blanks: bool = True) -> DataFrame:
    """value: distinct texts at a path, in code point order; blanks=False leaves empty ones out."""
    found = records.select(F.explode(values_at(F.col(column), path)).alias("value")).distinct()
    return (found if blanks else found.where("value <> ''")).orderBy("value")


def write_values(values: DataFrame, path: str) -> None:
    """One value a line, in order."""
    values.select("value").orderBy("value").coalesce(1).write.mode("overwrite").text(path)


def preview(rows: DataFrame, *order: str, limit: int = 50) -> DataFrame:
    return rows.orderBy(*order).limit(limit)
