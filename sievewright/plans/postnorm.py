"""Post-normalisation of mapped records: dates, dependencies between arrays, duplicates, empty fields.

Rules run by priority (ties in the order of the table). Typed arrays have Column forms that stay in the JVM; records of
unknown shape travel as JSON text through one Arrow-batched UDF.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions import dates
from sievewright.registry import find, known, register

#: Top-level fields that are left out where they hold nothing (fixed values).
DROPPED_IF_EMPTY = ("Reference Number", "comment")


@dataclass(frozen=True)
class Rule:
    priority: float
    kind: str
    condition: str = ""
    target: str = ""
    value: str = ""


@register("postnorm", "DATE_NORMALIZATION")
def normalise_dates(record: dict, rule: Rule) -> None:
    """Each object of the list becomes the dates of its date_full, else of its year; without any it stays only if it has a year. Items that are no objects stay."""
    items = record.get(rule.condition)
    if not isinstance(items, list):
        return
    out = []
    for item in items:
        if not isinstance(item, dict):
            out.append(item)
            continue
        found = dates.parse(item.get("date_full") or item.get("year"))
        out += [dict(zip(("date_full", "year", "month", "day"), d, strict=True)) for d in found] or ([item] if item.get("year") else [])
    record[rule.condition] = out


@register("postnorm", "EMPTY_DEPENDENCY")
def fill_dependent(record: dict, rule: Rule) -> None:
    """Where the condition's key is null or empty, the target's key at the same place gets the value; the shorter array is filled with {}."""
    (a, _, key), (b, _, other) = rule.condition.partition("[]."), rule.target.partition("[].")
    if not isinstance(record.get(a), list) or not isinstance(record.get(b), list):
        return
    size = max(len(record[a]), len(record[b]))
    for name in (a, b):
        record[name] += [{} for _ in range(size - len(record[name]))]
    for x, y in zip(record[a], record[b], strict=True):
        if isinstance(x, dict) and isinstance(y, dict) and x.get(key) in (None, ""):
            y[other] = rule.value


def distinct(value):
    """Arrays at any depth without later equal items; the order of keys does not matter."""
    if isinstance(value, dict):
        return {k: distinct(v) for k, v in value.items()}
    if not isinstance(value, list):
        return value
    kept: dict = {}
    for item in map(distinct, value):
        kept.setdefault(_identity(item), item)
    return list(kept.values())


def _identity(value):
    """A key that equal values share: the order of keys does not count, and 1, 1.0 and true are equal."""
    if isinstance(value, dict):
        return frozenset((k, _identity(v)) for k, v in value.items())
    return tuple(map(_identity, value)) if isinstance(value, list) else value


@register("postnorm", "DEDUPLICATE_ALL_ARRAYS")
def deduplicate(record: dict, rule: Rule) -> None:
    record.update(distinct(record))


def drop_empty(record: dict) -> dict:
    return {k: v for k, v in record.items() if k not in DROPPED_IF_EMPTY or v not in (None, "", [])}


def ordered(rules: list[Rule]) -> list[tuple[Rule, Callable[[dict, Rule], None]]]:
    """Known rules by priority; unknown kinds are ignored."""
    return [(r, find("postnorm", r.kind)) for r in sorted(rules, key=lambda r: r.priority) if r.kind in known("postnorm")]


def post_normalize(records: Column, rules: list[Rule]) -> Column:
    """Mapped records (JSON text) after all rules."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        steps = ordered(rules)

        def one(text):
            if text is None:
                return None
            record = json.loads(text)
            for rule, step in steps:
                step(record, rule)
            return json.dumps(drop_empty(record), ensure_ascii=False)

        for batch in batches:
            yield batch.map(one)

    return run(records)


def load(rows: list[dict]) -> list[Rule]:
    text = lambda row, name: "" if row.get(name) is None or row[name] != row[name] else str(row[name]).strip()
    return [Rule(float(r.get("priority") or 0), text(r, "rule_type"), text(r, "condition_path"), text(r, "target_path"), text(r, "value")) for r in rows]


# Column forms for typed arrays


def dependent_items(a: Column, key: str, b: Column, other: str, value: str) -> Column:
    """EMPTY_DEPENDENCY of two arrays of structs, zipped and padded: array of {a, b}."""
    zipped = F.arrays_zip(a.alias("a"), b.alias("b"))

    def one(z):
        return F.when(
            F.coalesce(z["a"][key], F.lit("")) == "",
            F.struct(z["a"].alias("a"), F.coalesce(z["b"], F.from_json(F.lit("{}"), "struct<" + other + ":string>")).withField(other, F.lit(value)).alias("b")),
        ).otherwise(F.struct(z["a"].alias("a"), z["b"].alias("b")))

    return F.transform(zipped, one)


def distinct_items(items: Column) -> Column:
    """DEDUPLICATE_ALL_ARRAYS of one typed array: first occurrences, in order."""
    return F.array_distinct(items)
