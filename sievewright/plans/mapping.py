"""The mapping compiler: rule tables become one Column per entity type, over VARIANT records.

Source types: path, constant, raw, expand, parallel_path, path_expand, concat_path, explode, conditional_path. Rules with a group make
an array of objects, the others values. Everything is decided on the driver: parsing, grouping, composite blocks, defaults; a record only
evaluates expressions.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import paths
from sievewright.functions.text import canonical_type, strip


@dataclass(frozen=True)
class Rule:
    entity_type: str
    target: str
    target_type: str = ""
    group: str | None = None
    kind: str | None = None
    value: str | None = None

    @property
    def leaf(self) -> str:
        return self.target.rpartition("[]")[2].lstrip(".") if "[]" in self.target else self.target

    @property
    def root(self) -> str:
        return self.target.partition("[]")[0]


#: Defaults by target type (fixed values); any other type is an empty text.
DEFAULTS = {"object": "{}", "dict": "{}", "array": "[]", "list": "[]", "json": "null", "raw": "null"}


def variant(json: str) -> Column:
    return F.parse_json(F.lit(json))


def default(rule: Rule) -> Column:
    return variant(DEFAULTS.get(rule.target_type.strip().lower(), '""'))


def as_variant(text: Column) -> Column:
    return text.cast("variant")


def unquoted(text: str | None) -> str:
    text = (text or "").strip()
    return text[1:-1] if len(text) >= 2 and text[0] == text[-1] == '"' else text


def pieces(text: str | None, by: str = "|") -> list[str]:
    return [p.strip() for p in (text or "").split(by) if p.strip()]


@dataclass(frozen=True)
class Context:
    """The root record, and inside a generated group its item with the path that it came from."""

    root: Column
    item: Column | None = None
    anchor: str | None = None

    def _short(self, expr: str) -> str | None:
        """The path without the anchor in front, with or without [] (None if it does not start with it)."""
        for start in {(self.anchor or "").strip(), (self.anchor or "").strip().replace("[]", "")} - {""}:
            if expr == start:
                return ""
            if expr.startswith(start + "."):
                return expr[len(start) + 1 :]
        return None

    def first(self, expr: str | None) -> Column:
        expr = (expr or "").strip()
        if not expr:
            return self.item if self.item is not None else F.lit(None).cast("variant")
        tries = []
        if self.item is not None:
            tries.append(paths.get(self.item, expr))
            if (short := self._short(expr)) is not None:
                tries.append(paths.get(self.item, short) if short else self.item)
        return F.coalesce(*tries, paths.get(self.root, expr))

    def every(self, expr: str | None) -> Column:
        expr = (expr or "").strip()
        if not expr:
            return paths.as_list(self.item) if self.item is not None else F.array().cast("array<variant>")
        tries = []
        if self.item is not None:
            tries.append(paths.get_all(self.item, expr))
            if (short := self._short(expr)) is not None:
                tries.append(paths.get_all(self.item, short) if short else paths.as_list(self.item))
        found = paths.get_all(self.root, expr)
        for values in reversed(tries):  # the next one is looked up only where this one is empty
            found = paths.let(values, _or_else(found))
        return found


def _or_else(other: Column) -> Callable[[Column], Column]:
    return lambda a: F.when(F.size(a) > 0, a).otherwise(other)


# Source types. Each gives a variant, or an array of variants where it is marked as one.


def _path(rule: Rule, at: Context) -> Column:
    return at.first(rule.value)


def _constant(rule: Rule, at: Context) -> Column:
    value = unquoted(rule.value)
    return as_variant(F.lit(value.lower() if value.upper() in ("TRUE", "FALSE") else value))


def _raw(rule: Rule, at: Context) -> Column:
    return at.root


def _expand(rule: Rule, at: Context) -> Column:
    values = [as_variant(F.lit(unquoted(p))) for p in pieces(rule.value)]
    return F.array(*values) if values else F.array().cast("array<variant>")


def _parallel(rule: Rule, at: Context) -> Column:
    values = [at.first(p) for p in pieces(rule.value)]
    return F.array(*values) if values else F.array().cast("array<variant>")


def _every(rule: Rule, at: Context) -> Column:
    return at.every(rule.value)


def _concat(rule: Rule, at: Context) -> Column:
    parts = [strip(paths.text(at.first(p))) for p in pieces(rule.value)]
    return as_variant(F.array_join(F.filter(F.array(*parts), lambda t: t != ""), " ") if parts else F.lit(""))


def separator(expr: str) -> tuple[str, str]:
    """(path, separator) of an explode expression: `path`, `path,;` or `path,,`."""
    expr = expr.strip()
    if expr.endswith(",,"):
        return expr[:-2].strip(), ","
    path, comma, by = expr.rpartition(",")
    return (path.strip(), by.strip()) if comma else (expr, "|")


def _explode(rule: Rule, at: Context) -> Column:
    if not rule.value:
        return F.array().cast("array<variant>")
    path, by = separator(rule.value)
    literal = "".join("\\" + c if not c.isalnum() else c for c in by)
    texts = F.filter(F.transform(at.every(path), paths.text), lambda t: t.isNotNull())
    split = F.flatten(F.transform(texts, lambda t: F.split(t, literal)))
    cut = F.transform(split, lambda t: F.regexp_replace(strip(t), r"^\.+|\.+$", ""))
    return F.transform(F.filter(cut, lambda t: (t != "") & (F.upper(t) != "N/A")), lambda t: t.cast("variant"))


def _same(actual: Column, expected: str) -> Column:
    """Equal as trimmed lower-case texts; a missing value is the text none."""
    return F.lower(strip(F.coalesce(paths.text(actual), F.lit("none")))) == expected.strip().lower()


def _conditional(rule: Rule, at: Context) -> Column:
    """The first alternative whose condition holds decides, even with a null; NULL if none does."""
    hits = []  # arrays of no or one struct, by falling priority
    for block in pieces(rule.value, "OR"):
        parts = [p.strip() for p in block.split("|")]
        if len(parts) != 3:
            continue
        condition, expected, result = parts[0], unquoted(parts[1]), parts[2]
        quoted = len(result) >= 2 and result.startswith('"') and result.endswith('"')
        literal = as_variant(F.lit(unquoted(result)))
        if at.item is not None:
            one = F.array(F.struct((literal if quoted else at.first(result)).alias("r")))
            hits.append(F.filter(one, _holds(at.first(condition), expected)))
        if "[]" in condition:
            base = condition.partition("[]")[0] + "[]"
            hits.append(_found(at.root, base, condition, expected, literal if quoted else None, result))
    if not hits:
        return F.lit(None).cast("variant")
    return F.get(F.concat(*hits), F.lit(0))["r"]


def _holds(actual: Column, expected: str):
    return lambda _: _same(actual, expected)


def _found(root: Column, base: str, condition: str, expected: str, literal: Column | None, result: str) -> Column:
    """The result for the first item at a list path that meets the condition."""
    inside = Context(root, anchor=base)
    test, then = (e if inside._short(e) is None else inside._short(e) for e in (condition, result))
    items = F.slice(F.filter(paths.get_all(root, base), lambda i: _same(paths.get(i, test), expected)), 1, 1)
    return F.transform(items, lambda i: F.struct((literal if literal is not None else paths.get(i, then)).alias("r")))


@dataclass(frozen=True)
class Source:
    build: Callable[[Rule, Context], Column]
    many: bool = False


SOURCES: dict[str, Source] = {
    "path": Source(_path),
    "constant": Source(_constant),
    "raw": Source(_raw),
    "expand": Source(_expand, True),
    "parallel_path": Source(_parallel, True),
    "path_expand": Source(_every, True),
    "concat_path": Source(_concat),
    "explode": Source(_explode, True),
    "conditional_path": Source(_conditional),
}


def _source(rule: Rule) -> Source | None:
    kind = (rule.kind or "").strip().lower()
    if kind and kind not in SOURCES:
        warnings.warn(f"unknown source type {kind!r} of {rule.target}: the rule is skipped", stacklevel=2)
    return SOURCES.get(kind)


def _scalar(value: Column, many: bool, fallback: Column) -> Column:
    """An empty list gives the fallback, a list of one its item; another list stays a list."""
    if many:
        return paths.let(value, lambda a: F.when(F.size(a) == 0, fallback).when(F.size(a) == 1, F.get(a, F.lit(0))).otherwise(a.cast("variant")))

    def body(v):
        items = F.try_variant_get(v, "$", "array<variant>")
        single = F.when(F.size(items) == 0, fallback).when(F.size(items) == 1, F.get(items, F.lit(0)))
        return F.when(v.isNull(), fallback).otherwise(F.coalesce(single, v))

    return paths.let(value, body)


def _group_object(rules: list[Rule], at: Context, driver: Column | None = None, position: Column | None = None) -> Column:
    """The struct of a group's leaves. driver: the value that expand and explode leaves take."""
    leaves: dict[str, Column] = {r.leaf: default(r) for r in rules if r.leaf}
    for rule in rules:
        source, kind = _source(rule), (rule.kind or "").strip().lower()
        if not rule.leaf or source is None or kind == "path_expand" and (at.item is not None or driver is not None):
            continue
        if driver is not None and kind in ("expand", "explode"):
            leaves[rule.leaf] = driver
        elif driver is not None and kind == "parallel_path":
            leaves[rule.leaf] = F.coalesce(F.get(source.build(rule, at), position), leaves[rule.leaf])
        else:
            leaves[rule.leaf] = _scalar(source.build(rule, at), source.many, leaves[rule.leaf])
    return F.struct(*(c.alias(name) for name, c in leaves.items())) if leaves else F.struct(F.lit(None).cast("string").alias("_"))


def composite(rules: list[Rule]) -> list[list[Rule]]:
    """Blocks of a group whose types or values are lists by `*`: block i takes the i-th part of each, or its last."""
    if not any("*" in (r.kind or "") for r in rules):
        return [rules]
    parts = [(pieces(r.kind, "*") or [r.kind], pieces(r.value, "*") or [r.value]) for r in rules]
    count = max(len(x) for both in parts for x in both)
    return [
        [replace(r, kind=kinds[min(i, len(kinds) - 1)], value=values[min(i, len(values) - 1)]) for r, (kinds, values) in zip(rules, parts, strict=True)]
        for i in range(count)
    ]


def _block(rules: list[Rule], root: Column) -> Column:
    """The array of objects of one block."""
    by_kind: dict[str, Rule] = {}
    for rule in rules:
        by_kind.setdefault((rule.kind or "").strip().lower(), rule)

    names = list(dict.fromkeys(r.leaf for r in rules if r.leaf))

    def meaningful(o: Column) -> Column:
        held = F.lit(False)
        for name in names:
            held = held | ~paths.is_empty(o.getField(name))
        return held

    if lead := by_kind.get("path_expand"):
        return F.filter(F.transform(_every(lead, Context(root)), lambda x: _group_object(rules, Context(root, x, lead.value))), meaningful)
    if lead := by_kind.get("expand") or by_kind.get("explode"):
        values = SOURCES[lead.kind.strip().lower()].build(lead, Context(root))
        return F.filter(F.transform(values, lambda x, i: _group_object(rules, Context(root), x, i)), meaningful)
    # a group without a generator needs a value that the source really has: constants and the raw record do not count
    real = F.lit(False)
    for rule in rules:
        source, kind = _source(rule), (rule.kind or "").strip().lower()
        if source is not None and kind not in ("constant", "raw"):
            value = source.build(rule, Context(root))
            real = real | (F.size(value) > 0 if source.many else ~paths.is_empty(value))
    return F.filter(F.array(_group_object(rules, Context(root))), lambda _: real)


def group_column(rules: list[Rule], root: Column) -> Column:
    blocks = [_block(b, root) for b in composite(rules)]
    return F.concat(*blocks) if len(blocks) > 1 else blocks[0]


def _object_or_list(values: list[tuple[Rule, Column | None]]) -> Column:
    """Ungrouped rules with [] in their targets: an object of the leaves that have a value, or without any a list of one item with the last
    rule's default. So the shape follows the record.
    """
    last = values[-1][0]
    empty = F.array(F.to_variant_object(F.create_map(F.lit(last.leaf), default(last)))).cast("variant")
    there = [F.struct(F.lit(r.leaf).alias("key"), v.alias("value")) for r, v in values if v is not None]
    if not there:
        return empty
    # a later rule of the same leaf wins
    kept = F.aggregate(
        F.filter(F.array(*there), lambda e: e["value"].isNotNull()),
        F.create_map().cast("map<string,variant>"),
        lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])),
    )
    return paths.let(kept, lambda m: F.when(F.size(m) > 0, F.to_variant_object(m)).otherwise(empty))


def record_column(rules: list[Rule], root: Column) -> Column:
    """The mapped entity of one entity type's rules, as a struct: values in order, then groups, nested by their targets."""
    tree: dict = {}

    def put(path: str, value: Column) -> None:
        parts, node = [p for p in path.replace("[]", "").split(".") if p], tree
        for p in parts[:-1]:
            if not isinstance(node.get(p), dict):
                node[p] = {}
            node = node[p]
        node[parts[-1]] = value

    listed: dict[str, list[tuple[Rule, Column | None]]] = {}
    for rule in (r for r in rules if not r.group):
        source, base = _source(rule), default(rule)
        value = None
        if source is not None:
            value = source.build(rule, Context(root))
            value = value.cast("variant") if source.many else value
        if "[]" in rule.target and rule.leaf:
            listed.setdefault(rule.root, []).append((rule, value))
            put(rule.root, _object_or_list(listed[rule.root]))
        else:
            put(rule.target, base if value is None else F.coalesce(value, base))
    groups: dict[str, list[Rule]] = {}
    for rule in rules:
        if rule.group:
            groups.setdefault(rule.group, []).append(rule)
    for own in groups.values():
        put(own[0].root, group_column(own, root))

    def struct(node: dict) -> Column:
        return F.struct(*((struct(x) if isinstance(x, dict) else x).alias(name) for name, x in node.items()))

    return struct(tree)


def entity_type(root: Column) -> Column:
    """Individual, Organization or Vessel: from the record's type fields, or from vessel fields."""

    def truthy(path):
        return F.nullif(paths.text(paths.get(root, path)), F.lit(""))

    vessel = truthy("IMO number").isNotNull() | truthy("Vessel name at designation time").isNotNull()
    return canonical_type(F.coalesce(truthy("entity_type"), truthy("generalInfo.entityType.text"), truthy("Type")), vessel)


def map_records(records: DataFrame, rules: list[Rule], column: str = "v") -> DataFrame:
    """All columns of records (a VARIANT column), with mapped_type and mapped (JSON text; null where no rule has the type)."""
    kinds = list(dict.fromkeys(r.entity_type for r in rules))
    typed = records.withColumn("mapped_type", entity_type(F.col(column)))
    mapped = F.lit(None).cast("string")
    for kind in kinds:
        own = [r for r in rules if r.entity_type == kind and r.target]
        json = F.to_json(record_column(own, F.col(column)), {"ignoreNullFields": "false"})
        mapped = F.when(F.col("mapped_type") == kind, json).otherwise(mapped)
    return typed.withColumn("mapped", F.coalesce(mapped, F.lit("{}")))


def load_rules(rows: list[dict], source: str) -> list[Rule]:
    """Rules of a source from rows of the mapping table: Entity Type, Final Json Path, Final Json Path Type, Group, <source> TYPE, <source>."""

    def text(row, name):
        value = row.get(name)
        return None if value is None or value != value else str(value).strip()

    made = [
        Rule(
            text(row, "Entity Type") or "",
            text(row, "Final Json Path") or "",
            text(row, "Final Json Path Type") or "",
            text(row, "Group"),
            (text(row, f"{source} TYPE") or "").lower() or None,
            text(row, source),
        )
        for row in rows
    ]
    return [r for r in made if r.entity_type and r.target]
