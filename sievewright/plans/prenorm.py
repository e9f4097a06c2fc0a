"""Pre-normalisation: rules that rewrite values in place at paths of a nested record.

VARIANT has no setter, so records travel as JSON text and one Arrow-batched UDF applies all rules of a source; the rules are
parsed, sorted by entity type and bound to their handlers once, on the driver.
"""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.text import parse_enum
from sievewright.registry import find, known, register


@dataclass(frozen=True)
class Rule:
    source: str
    entity_type: str
    field: str
    kind: str
    spec: str = ""


Handler = Callable[[object], object]


@register("prenorm", "enum")
def _enum(spec: str) -> Handler:
    table = parse_enum(spec)
    return lambda x: None if x is None else table.get(str(x).strip(), x)


@register("prenorm", "remove_list_markers")
def _markers(spec: str) -> Handler:
    marker = re.compile(r"\([A-Za-z]\)\s*")
    return lambda x: None if x is None else marker.sub("", str(x)).strip()


@register("prenorm", "before_parenthesis")
def _before(spec: str) -> Handler:
    return lambda x: None if x is None else str(x).partition("(")[0].replace(":", "").strip()


def matches(record, path: str) -> Iterator[tuple]:
    """(container, key) of every place a path names; keys are exact, `a[]` needs a list, and a list on the way needs []."""

    def walk(node, parts):
        name = parts[0].removesuffix("[]")
        if not isinstance(node, dict) or name not in node:
            return
        if parts[0].endswith("[]"):
            if not isinstance(node[name], list):
                return
            for k, item in enumerate(node[name]):
                if len(parts) == 1:
                    yield node[name], k
                else:
                    yield from walk(item, parts[1:])
        elif len(parts) == 1:
            yield node, name
        else:
            yield from walk(node[name], parts[1:])

    parts = path.split(".") if path else []
    return walk(record, parts) if parts else iter(())


@dataclass(frozen=True)
class Plan:
    """The rules of one source: where its entity type stands, that field's enum, and the steps of each entity type."""

    source: str
    entity_field: str | None
    entity_rule: Rule | None
    rules: tuple[Rule, ...]

    def handlers(self) -> tuple[Handler | None, list[tuple[Rule, Handler]]]:
        own = [(r, find("prenorm", r.kind)(r.spec)) for r in self.rules if r.kind in known("prenorm")]
        return (find("prenorm", "enum")(self.entity_rule.spec) if self.entity_rule else None), own


def compile_rules(rules: list[Rule], entity_fields: dict[str, str], source: str) -> Plan:
    own = tuple(r for r in rules if r.source == source)
    for r in own:
        if r.kind not in known("prenorm"):
            warnings.warn(f"unknown normalisation {r.kind!r} of {r.field}: the rule is skipped", stacklevel=2)
    field = entity_fields.get(source)
    return Plan(source, field, next((r for r in own if r.field == field and r.kind == "enum"), None), own)


def apply(record, plan: Plan, bound) -> object:
    """The rewritten record. The detected type is written to all its places first, so its enum may act twice; without one only * rules act."""
    entity_enum, steps = bound
    found = list(matches(record, plan.entity_field)) if plan.entity_field else []
    kind = None
    if found:
        box, key = found[0]
        kind = entity_enum(box[key]) if entity_enum else box[key]
        for box, key in found:
            box[key] = kind
    for rule, handler in steps:
        if rule.entity_type == "*" or kind is not None and rule.entity_type == kind:
            for box, key in list(matches(record, rule.field)):
                box[key] = handler(box[key])
    return record


def pre_normalize(records: Column, plan: Plan) -> Column:
    """JSON records (text) rewritten by a plan."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bound = plan.handlers()
        for batch in batches:
            yield batch.map(lambda t: None if t is None else json.dumps(apply(json.loads(t), plan, bound), ensure_ascii=False))

    return run(records)


def entity_type(records: Column, plan: Plan) -> Column:
    """The type that the plan detects, from the JSON text alone: no Python."""
    if not plan.entity_field:
        return F.lit(None).cast("string")
    from sievewright.functions.text import enum_map

    found = F.get_json_object(records, "$." + plan.entity_field.replace("[]", "[0]"))
    return enum_map(found, plan.entity_rule.spec) if plan.entity_rule else found


def load(rows: list[dict], configs: list[dict]) -> tuple[list[Rule], dict[str, str]]:
    """Rules and entity fields from rows of the two tables; a later row of a source wins."""
    text = lambda row, name: "" if row.get(name) is None or row[name] != row[name] else str(row[name]).strip()
    rules = [Rule(text(r, "source"), text(r, "entity_type"), text(r, "field"), text(r, "normalization_type"), text(r, "normalization_rule")) for r in rows]
    return rules, {text(c, "source"): text(c, "entity_field") for c in configs}


def normalize_records(records: DataFrame, plan: Plan, column: str = "record") -> DataFrame:
    return records.withColumn(column, pre_normalize(F.col(column), plan))
