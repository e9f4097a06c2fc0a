"""The mapping compiler, source type by source type, and its traps."""

import json

import pytest
from pyspark.sql import functions as F

from sievewright.plans.mapping import Rule, load_rules, map_records, separator

ITEMS = {"entity_type": "Organization", "code": "C1", "a": [{"x": "1", "k": "P"}, {"x": "2", "k": "S", "n": None}, {"k": "Z"}], "one": {"x": "9", "k": "P"}}


def rule(target, kind=None, value=None, group=None, target_type="", entity="Organization"):
    return Rule(entity, target, target_type, group, kind, value)


@pytest.fixture
def mapped(spark):
    def run(record, *rules):
        rows = [record] if isinstance(record, dict) else record
        frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "i int, j string").select("i", F.parse_json("j").alias("v"))
        out = [json.loads(r.mapped) for r in map_records(frame, list(rules)).orderBy("i").collect()]
        return out[0] if isinstance(record, dict) else out

    return run


def test_values_and_defaults(mapped):
    record = {**ITEMS, "list": [["p"], "q"], "t": True, "nul": None, "odd key ": "blank", "a/b": 1.5}
    out = mapped(
        record,
        rule("code", "path", "code"),
        rule("deep.er.first", "path", "a[].x"),
        rule("whole", "path", "list"),
        rule("loose", "path", "odd key"),
        rule("slash", "path", "a/b"),
        rule("c", "constant", ' "A b" '),
        rule("yes", "constant", "TRUE"),
        rule("no", "path", "missing"),
        rule("null", "path", "nul"),
        rule("obj", None, None, target_type="Object"),
        rule("arr", "path", "missing", target_type="list"),
        rule("raw", "path", "missing", target_type="raw"),
        rule("implicit", "path", "a.k"),
        rule("of_one", "path", "one[].x"),
    )
    assert out["code"] == "C1" and out["deep"] == {"er": {"first": "1"}} and out["whole"] == [["p"], "q"]
    assert (out["loose"], out["slash"], out["c"], out["yes"]) == ("blank", 1.5, "A b", "true")
    assert (out["no"], out["null"], out["obj"], out["arr"], out["raw"]) == ("", "", {}, [], None)
    assert (out["implicit"], out["of_one"]) == ("P", "9")


def test_raw_keeps_the_record(mapped):
    assert mapped(ITEMS, rule("r", "raw"))["r"] == ITEMS


def test_ungrouped_lists_stay_lists(mapped):
    out = mapped(
        {"entity_type": "entity", "v": "a|b.|N/A| |c", "w": "x;y"},
        rule("e", "expand", 'one | "two" | '),
        rule("single", "expand", "only"),
        rule("x", "explode", "v"),
        rule("s", "explode", "w,;"),
        rule("p", "parallel_path", "w | missing"),
        rule("all", "path_expand", "w"),
    )
    assert out == {"e": ["one", "two"], "single": ["only"], "x": ["a", "b", "c"], "s": ["x", "y"], "p": ["x;y", None], "all": ["x;y"]}


@pytest.mark.parametrize("expr, want", [("a.b", ("a.b", "|")), ("a,;", ("a", ";")), ("a,,", ("a", ",")), ("a , / ", ("a", "/"))])
def test_separators(expr, want):
    assert separator(expr) == want


def test_concat_skips_blanks(mapped):
    record = {"entity_type": "entity", "f": " Ann ", "m": "", "l": "Lee", "t": True}
    assert mapped(record, rule("n", "concat_path", "f | m | nope | l | t"))["n"] == "Ann Lee True"


def test_path_expand_groups_fall_back_to_the_root(mapped):
    out = mapped(ITEMS, rule("o[].x", "path", "a[].x", "g"), rule("o[].k", "path", "k", "g"), rule("o[].code", "path", "code", "g"), rule("o[].gen", "path_expand", "a[]", "g"))
    assert out["o"] == [{"x": x, "k": k, "code": "C1", "gen": ""} for x, k in (("1", "P"), ("2", "S"), ("1", "Z"))]


def test_constant_only_groups(mapped):
    generated = mapped(ITEMS, rule("o[].c", "constant", "x", "g"), rule("o[].gen", "path_expand", "a[]", "g"))
    assert len(generated["o"]) == 3
    assert mapped(ITEMS, rule("o[].c", "constant", "x", "g"), rule("o[].v", "path", "missing", "g"))["o"] == []
    assert mapped(ITEMS, rule("o[].gen", "path_expand", "a[]", "g"), rule("o[].v", "path", "missing", "g"))["o"] == []


def test_expand_with_parallel_paths(mapped):
    out = mapped(ITEMS, rule("o[].t", "expand", "A | B | C", "g"), rule("o[].v", "parallel_path", "code | missing", "g"), rule("o[].w", "path", "one.x", "g"))
    assert out["o"] == [{"t": "A", "v": "C1", "w": "9"}, {"t": "B", "v": "", "w": "9"}, {"t": "C", "v": "", "w": "9"}]


def test_composite_blocks_repeat_their_last_part(mapped):
    out = mapped(ITEMS, rule("o[].t", "constant * constant", "A * B * C", "g"), rule("o[].v", "path", "code * missing * one.k", "g"))
    assert out["o"] == [{"t": "A", "v": "C1"}, {"t": "C", "v": "P"}]


def test_conditions(mapped):
    record = {**ITEMS, "flag": True}
    out = mapped(
        record,
        rule("first", "conditional_path", "a[].k | s | a[].x"),
        rule("literal", "conditional_path", 'a[].k | nope | a[].x OR a[].k | P | "primary"'),
        rule("null", "conditional_path", 'a[].k | Z | a[].x OR a[].k | P | "later"'),
        rule("never", "conditional_path", "code | C1 | one.x"),
        rule("broken", "conditional_path", 'a[].k | MAJOR | "m"'),
        rule("o[].gen", "path_expand", "one", "g"),
        rule("o[].c", "conditional_path", 'k | p | "yes"', "g"),
        rule("o[].b", "conditional_path", "flag | TRUE | x", "g"),
        rule("o[].none", "conditional_path", 'missing | none | "absent"', "g"),
    )
    assert (out["first"], out["literal"], out["null"], out["never"], out["broken"]) == ("2", "primary", "", "", "")
    assert out["o"] == [{"gen": "", "c": "yes", "b": "9", "none": "absent"}]


def test_groups_keep_their_order_and_unknown_types_are_skipped(mapped):
    with pytest.warns(UserWarning, match="unknown source type"):
        out = mapped(ITEMS, rule("z", "nonsense", "x"), rule("b[].v", "path", "code", "b"), rule("y", "path", "code"), rule("a[].v", "path", "code", "a"))
    assert out == {"z": "", "y": "C1", "b": [{"v": "C1"}], "a": [{"v": "C1"}]} and list(out) == ["z", "y", "b", "a"]


def test_entity_types_choose_the_rules(mapped):
    records = [{"entity_type": "person"}, {"generalInfo": {"entityType": {"text": "Entity"}}}, {"Type": " Vessel "}, {"IMO number": "1"}, {"Type": "?"}, {}]
    rules = [rule("t", "constant", kind, entity=kind) for kind in ("Individual", "Organization", "Vessel")]
    assert [r["t"] for r in mapped(records, *rules)] == ["Individual", "Organization", "Vessel", "Vessel", "Individual", "Individual"]
    assert mapped({"Type": "vessel"}, rule("t", "constant", "x")) == {}


def test_ungrouped_targets_with_brackets_change_their_shape(mapped):
    rules = (rule("l[].a", "path", "x"), rule("l[].b", "path", "y", target_type="list"), rule("m[].c", None, None))
    records = [{"entity_type": "entity", **r} for r in ({"x": "1", "y": "2"}, {"x": "1"}, {"y": "2"}, {})]
    assert [r["l"] for r in mapped(records, *rules)] == [{"a": "1", "b": "2"}, {"a": "1"}, {"b": "2"}, [{"b": []}]]
    assert mapped(records[0], *rules)["m"] == [{"c": ""}]


def test_rule_tables():
    rows = [
        {"Entity Type": " Individual ", "Final Json Path": "names[].n", "Group": "n", "S TYPE": " PATH ", "S": " a.b "},
        {"Entity Type": "Individual", "Final Json Path": float("nan"), "S TYPE": "path"},
        {"Final Json Path": "x"},
        {"Entity Type": "Vessel", "Final Json Path": "y", "Final Json Path Type": "array"},
    ]
    assert load_rules(rows, "S") == [Rule("Individual", "names[].n", "", "n", "path", "a.b"), Rule("Vessel", "y", "array")]
