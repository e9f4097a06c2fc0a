"""Path expressions over VARIANT records, compiled to Columns. A path is parsed once, on the driver.

Two dialects: the mapper's (`a[].b`; single objects count as lists of one; a missing key may differ in outer blanks) and the
explorer's (`a.b`; lists on the way are flattened at every depth).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Step:
    key: str
    each: bool


def parse(path: str | None) -> list[Step]:
    parts = [p.strip() for p in (path or "").split(".")]
    return [Step(p.removesuffix("[]"), p.endswith("[]")) for p in parts if p]


def let(x: Column, body: Callable[[Column], Column]) -> Column:
    """body of x, with x evaluated and spelt out once, however often body uses it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def first_of(values: Column) -> Column:
    """The first item of an array of variants; NULL if there is none or it is a JSON null."""
    return F.get(F.filter(F.slice(values, 1, 1), lambda x: x.isNotNull() & ~F.is_variant_null(x)), F.lit(0))


def as_list(v: Column) -> Column:
    """A variant list's items; any other value as a list of one; none for NULL. v should be short: a column or a lambda's variable."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(v.isNotNull(), F.array(v)), F.array().cast("array<variant>"))


def child(v: Column, key: str) -> Column:
    """A key's value, else that of the first key that equals it without outer blanks; NULL if neither is there or it is a JSON null."""
    quoted = key.replace("\\", "\\\\").replace('"', '\\"')
    exact = F.try_variant_get(v, f'$["{quoted}"]', "variant")
    entries = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    loose = F.get(F.filter(entries, lambda e: (F.trim(e["key"]) == key.strip()) & ~F.is_variant_null(e["value"])), F.lit(0))["value"]
    # the entries are looked through only where the exact key gives nothing
    return F.coalesce(_there(exact), loose)


def _there(v: Column) -> Column:
    """NULL for a JSON null."""
    return F.get(F.filter(F.array(v), lambda x: x.isNotNull() & ~F.is_variant_null(x)), F.lit(0))


def _children(items: Column, key: str) -> Column:
    return F.filter(F.transform(items, lambda i: child(i, key)), lambda x: x.isNotNull())


def get_all(v: Column, path: str | None) -> Column:
    """All values at a path (mapper dialect), as an array of variants."""
    steps = parse(path)
    if not steps:
        return F.flatten(F.transform(F.filter(F.array(v), lambda x: x.isNotNull() & ~F.is_variant_null(x)), as_list))
    items = F.array(v)
    for step in steps:
        values = _children(F.flatten(F.transform(items, as_list)), step.key)
        items = F.flatten(F.transform(values, as_list)) if step.each else values
    return items


def get(v: Column, path: str | None) -> Column:
    """The first value at a path, NULL if none."""
    return first_of(get_all(v, path))


def _exact(items: Column, key: str) -> Column:
    return F.filter(F.transform(items, lambda i: F.try_variant_get(i, f'$["{key}"]', "variant")), lambda x: x.isNotNull())


def explore(v: Column, path: str) -> Column:
    """All values at a path (explorer dialect): keys are exact, lists on the way are flattened; the last value may be a list."""
    items = F.array(v)
    for key in path.split("."):
        items = _exact(_flat(items), key)
    return items


def _flat(items: Column) -> Column:
    """The items with every list, at whatever depth, replaced by what it holds."""

    def is_list(x: Column) -> Column:
        return F.try_variant_get(x, "$", "array<variant>").isNotNull()

    def step(a: Column) -> Column:
        return F.flatten(F.transform(a, as_list))

    def deeper(a: Column) -> Column:
        # lists directly in lists are rare; no list is deeper than there are opening brackets
        text = F.array_join(F.transform(a, lambda x: F.to_json(x)), "")
        levels = F.length(text) - F.length(F.replace(text, F.lit("["), F.lit("")))
        return F.aggregate(F.sequence(F.lit(1), levels), a, lambda got, _: F.when(F.exists(got, is_list), step(got)).otherwise(got))

    return let(step(items), lambda a: F.when(F.exists(a, is_list), deeper(a)).otherwise(a))


def text(v: Column) -> Column:
    """A variant as text: strings as they are, booleans as True and False, lists and objects as JSON."""

    def body(x):
        string = F.try_variant_get(x, "$", "string")
        made = F.when(F.schema_of_variant(x) == "BOOLEAN", F.initcap(string)).otherwise(F.coalesce(string, F.to_json(x)))
        return F.when(x.isNotNull() & ~F.is_variant_null(x), made)

    return let(v, body)


def is_empty(v: Column) -> Column:
    """Null, an empty text, list or object."""
    return F.coalesce(F.to_json(v), F.lit("null")).isin("null", '""', "[]", "{}")
