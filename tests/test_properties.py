"""Compiled paths, dates and duplicates against small independent models, on generated records."""

import datetime
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.functions import dates, paths
from sievewright.plans import postnorm

KEYS = st.sampled_from(["a", "b", "c c", "d"])
LEAVES = st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from(["", "x", " y ", "z.z"])
VALUES = st.recursive(LEAVES, lambda inner: st.lists(inner, max_size=3) | st.dictionaries(KEYS, inner, max_size=3), max_leaves=12)
RECORDS = st.lists(st.dictionaries(KEYS, VALUES, max_size=4), min_size=20, max_size=40)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)


def model(value, steps):
    """All values at a path: a list stands for its items on the way, and for itself at the end unless its step has []."""
    if not steps:
        return [value]
    (key, each), rest = steps[0], steps[1:]
    out = []
    for node in value if isinstance(value, list) else [value]:
        found = node.get(key) if isinstance(node, dict) else None
        if found is None:
            continue
        for item in found if each and isinstance(found, list) else [found]:
            out += model(item, rest)
    return out


@FEW
@given(RECORDS)
def test_mapper_paths(spark, records):
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, j string").select("i", F.parse_json("j").alias("v"))
    for path in ("a", "a[]", "a.b", "a[].b[]", "c c[].a.d", "b[].c c"):
        steps = [(p.removesuffix("[]"), p.endswith("[]")) for p in path.split(".")]
        json_of = F.transform(paths.get_all(F.col("v"), path), lambda x: F.coalesce(F.to_json(x), F.lit("null")))
        got = {r.i: [json.loads(x) for x in r.x] for r in frame.select("i", json_of.alias("x")).collect()}
        assert got == {i: model(r, steps) for i, r in enumerate(records)}, path


@FEW
@given(RECORDS)
def test_emptiness_and_text(spark, records):
    values = [v for r in records for v in r.values()]
    if not values:
        return
    frame = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, j string").select("i", F.parse_json("j").alias("v"))
    got = {r.i: (r.e, r.t) for r in frame.select("i", paths.is_empty(F.col("v")).alias("e"), paths.text(F.col("v")).alias("t")).collect()}
    for i, v in enumerate(values):
        assert got[i][0] == (v is None or v == "" or v == [] or v == {}) or v in (0, False)
        if not isinstance(v, (list, dict)):
            assert got[i][1] == (None if v is None else str(v))


@given(st.recursive(LEAVES, lambda inner: st.lists(inner, max_size=4) | st.dictionaries(KEYS, inner, max_size=3), max_leaves=15))
def test_duplicates_go_and_nothing_else(value):
    once = postnorm.distinct(value)
    assert postnorm.distinct(once) == once

    def check(before, after):
        if isinstance(before, list):
            kept = []
            for x in map(postnorm.distinct, before):
                kept += [] if x in kept else [x]
            assert after == kept
        elif isinstance(before, dict):
            assert before.keys() == after.keys()
            for k in before:
                check(before[k], after[k])
        else:
            assert before == after or before != before

    check(value, once)


@given(st.lists(st.dates(min_value=datetime.date(1000, 1, 1)), min_size=1, max_size=5), st.sampled_from(["%Y-%m-%d", "%d %B %Y", "%B %d, %Y", "%d/%m/%Y"]))
def test_every_date_of_a_text_is_found_once(days, form):
    text = " and ".join(f"{d:%Y-%m-%d}" if form == "%Y-%m-%d" else d.strftime(form) for d in days)
    want = list(dict.fromkeys((f"{d.year:04d}", f"{d.month:02d}", f"{d.day:02d}") for d in days))
    assert [d[1:] for d in dates.parse(text)] == want
