"""Text and date functions, pre- and post-normalisation."""

import json

import pytest
from pyspark.sql import functions as F

from sievewright.functions import dates, text
from sievewright.plans import postnorm, prenorm


@pytest.fixture
def each(spark):
    def run(function, *values):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
        return [r[0] for r in frame.select("i", function(F.col("x")).alias("y")).orderBy("i").select("y").collect()]

    return run


def test_cleaning(each):
    assert each(text.clean_text, None, " a \n\t b c ", "") == ["", "a b c", ""]
    assert each(text.is_token_empty, None, " n/a ", "-", "none", "x") == [True, True, True, True, False]
    assert each(text.remove_list_markers, "(a) one (B)two", None, "(ab) c") == ["one two", None, "(ab) c"]
    assert each(text.before_parenthesis, "Name: (alias) x", "plain", None) == ["Name", "plain", None]
    assert each(text.header, " No.\nof ", " . ", None) == ["No of", None, None]


def test_enums(each):
    spec = " A = 1 | B=x=y | bare | A=2 "
    assert each(lambda x: text.enum_map(x, spec), " A ", "B", "C", None) == ["2", "x=y", "C", None]
    assert each(lambda x: text.enum_map(x, ""), "A") == ["A"]


def test_urls(each):
    urls = ["https://h/a/b%20c/?q=/z", "https://h/a+b", "", None, "https://h/%zz", "/x/y/"]
    assert each(text.name_from_url, *urls) == ["b c", "a+b", "", "", "%zz", "y"]
    assert each(text.last_segment, "https://h/a/b?c=d", "https://h/a/") == ["b?c=d", "a"]


def test_identifiers(each):
    made = each(lambda x: text.resolution_id("ATC", x, F.lit(" Some Name ")), "x resolution NO. 12, Resolution No 13", None, "none")
    assert [m.rsplit("-", 1)[0] for m in made] == ["ATC-12", "ATC-UNKNOWN", "ATC-UNKNOWN"] and len({m.rsplit("-", 1)[1] for m in made}) == 1


def test_names(each):
    assert each(text.entity_type_of_name, "Ann Lee", "Vincent Smith", "Acme Trading", "Madonna", "Lee, Ann", "Dr. Lee", None) == [
        "Individual", "Organization", "Organization", "Organization", "Individual", "Organization", "Organization",
    ]


def test_dates_and_places(each):
    texts = ["1 Jan 1980, Town, Land", "N/A", "N/A, Town", "Town, Land", "", "1980", None]
    assert each(lambda x: F.struct(*text.date_and_place(x)), *texts) == [
        ("1 Jan 1980", "Town, Land"), ("", ""), ("", "Town"), ("", "Town, Land"), ("", ""), ("1980", ""), ("", ""),
    ]


DATES = {
    "1990-02-03": ["1990-02-03"], "1990-02-03 10:11:12": ["1990-02-03"], "3 May 1990": ["1990-05-03"], "3 MAY 1990": ["1990-05-03"], "May 3, 1990": ["1990-05-03"],
    "May 3,1990": [], "3 Sept 1990": [], "3/5/1990": ["1990-05-03"], "31/13/1990": ["1990-13-31"], "5/1990": ["1990-05-"], "Approximately 1990": ["1990--"],
    "1990 (1991)": ["1990--", "1991--"], "1990 (1991)x": ["1990--", "1991--"], "1990": ["1990--"], "2023-13-45": [], "12 foo 1990": [], "": [], None: [],
    "3 May 2001-02-03": ["2001-02-03"], "1990 or 3 May 1991 or 1990": ["1990--", "1991-05-03"], "31 Feb 1990": [], "no date": [],
}


def test_all_dates(each):
    found = each(dates.all_dates, *DATES)
    assert [["-".join(d[1:]) for d in f] for f in found] == list(DATES.values())
    assert dates.parse("3  May 1990")[0][0] == "3 May 1990"


def test_single_tokens_agree_with_all_dates(each):
    single = {t: d for t, d in DATES.items() if t and len(d) <= 1 and t not in ("3 May 2001-02-03", "no date")}
    found = each(dates.date_token, *single)
    assert [[] if f is None else ["-".join(f[1:])] for f in found] == list(single.values())


# pre-normalisation


@pytest.fixture
def normal(spark):
    def run(rules, fields, *records, source="s"):
        plan = prenorm.compile_rules([prenorm.Rule(*r) for r in rules], fields, source)
        frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, record string")
        return [json.loads(r.record) for r in prenorm.normalize_records(frame, plan).orderBy("i").collect()]

    return run


def test_rules_of_a_type_and_of_all(normal):
    rules = [("s", "*", "t", "enum", "E=Entity|P=Person"), ("s", "Entity", "n[].v", "before_parenthesis"), ("s", "*", "w", "remove_list_markers"), ("x", "*", "w", "enum", "a=b")]
    out = normal(rules, {"s": "t"}, {"t": "E", "n": [{"v": "a (b)"}, {"v": None}, 3], "w": "(a) q"}, {"t": "P", "n": [{"v": "a (b)"}]}, {"n": {"v": "a (b)"}, "w": "(b) z"})
    assert out[0] == {"t": "Entity", "n": [{"v": "a"}, {"v": None}, 3], "w": "q"}
    assert out[1] == {"t": "Person", "n": [{"v": "a (b)"}]}
    assert out[2] == {"n": {"v": "a (b)"}, "w": "z"}


def test_an_enum_of_the_type_field_acts_twice(normal):
    assert normal([("s", "*", "t", "enum", "A=B|B=C")], {"s": "t"}, {"t": "A"}) == [{"t": "C"}]


def test_the_first_match_decides_and_all_are_written(normal):
    assert normal([("s", "*", "t[].k", "enum", "A=X")], {"s": "t[].k"}, {"t": [{"k": "A"}, {"k": "Q"}]}) == [{"t": [{"k": "X"}, {"k": "X"}]}]


def test_paths_are_exact():
    record = {"a": [{"b": 1}, {"b": None}], "c": {"d": 2}, "e": [1, 2], " f": 3}
    assert [box[key] for path in ("a[].b", "c.d", "e[]", "a.b", "c[].d", "f", "") for box, key in prenorm.matches(record, path)] == [1, None, 2, 1, 2]


def test_unknown_handlers_are_skipped(normal):
    with pytest.warns(UserWarning, match="unknown normalisation"):
        assert normal([("s", "*", "a", "nonsense")], {}, {"a": 1}) == [{"a": 1}]


def test_detected_type_in_the_jvm(spark):
    plan = prenorm.compile_rules([prenorm.Rule("s", "*", "t", "enum", "A=B")], {"s": "t"}, "s")
    frame = spark.createDataFrame([('{"t":"A"}',), ('{"t":"Z"}',), ("{}",)], "r string")
    assert [r[0] for r in frame.select(prenorm.entity_type(F.col("r"), plan)).collect()] == ["B", "Z", None]


def test_tables_of_rules():
    rules, fields = prenorm.load(
        [{"source": "s ", "entity_type": "*", "field": "f", "normalization_type": "enum", "normalization_rule": float("nan")}],
        [{"source": "s", "entity_field": "a"}, {"source": "s", "entity_field": "b"}],
    )
    assert rules == [prenorm.Rule("s", "*", "f", "enum", "")] and fields == {"s": "b"}


# post-normalisation


@pytest.fixture
def post(spark):
    def run(rules, *records):
        made = [postnorm.Rule(*r) for r in rules]
        frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, r string")
        return [json.loads(r.o) for r in frame.select("i", postnorm.post_normalize(F.col("r"), made).alias("o")).orderBy("i").collect()]

    return run


def test_date_items(post):
    items = [{"date_full": "3 May 1990 or 1991", "x": 1}, {"year": "1980"}, {"date_full": "?", "year": "about"}, {"date_full": "?"}, "text"]
    out = post([(1, "DATE_NORMALIZATION", "d")], {"d": items}, {"d": "no list"})
    assert [(i.get("year"), i.get("month")) for i in out[0]["d"] if isinstance(i, dict)] == [("1990", "05"), ("1991", ""), ("1980", ""), ("about", None)]
    assert out[1] == {"d": "no list"}


def test_dependencies(post):
    rule = (1, "EMPTY_DEPENDENCY", "a[].t", "b[].u", "none")
    out = post([rule], {"a": [{"t": ""}, {"t": "x"}], "b": [{"u": "1"}, {"u": "2"}, {"u": "3"}]}, {"a": [{}]}, {"a": [{}, {}], "b": []})
    assert out[0] == {"a": [{"t": ""}, {"t": "x"}, {}], "b": [{"u": "none"}, {"u": "2"}, {"u": "none"}]}
    assert out[1] == {"a": [{}]} and out[2] == {"a": [{}, {}], "b": [{"u": "none"}, {"u": "none"}]}


def test_duplicates_at_every_depth(post):
    record = {"a": [{"x": [1, 1], "y": 2}, {"y": 2, "x": [1]}, 3, 3], "raw": {"b": ["p", "q", "p"]}}
    rules = [(1, "DEDUPLICATE_ALL_ARRAYS")]
    once = post(rules, record)[0]
    assert once == {"a": [{"x": [1], "y": 2}, 3], "raw": {"b": ["p", "q"]}} and post(rules, once) == [once]


def test_priorities_and_dropped_fields(post):
    rules = [(2, "DEDUPLICATE_ALL_ARRAYS"), (1, "DATE_NORMALIZATION", "d"), (0, "NONSENSE")]
    out = post(rules, {"d": [{"year": "1990"}, {"date_full": "1990"}], "comment": "", "Reference Number": [], "keep": ""}, {"comment": "x"})
    assert out == [{"d": [{"date_full": "1990", "year": "1990", "month": "", "day": ""}], "keep": ""}, {"comment": "x"}]


def test_typed_columns_agree(spark):
    frame = spark.createDataFrame([(["b", "a", "b"],)], "x array<string>")
    assert frame.select(postnorm.distinct_items(F.col("x"))).first()[0] == ["b", "a"]


def test_equal_values_of_other_types_are_one():
    assert postnorm.distinct([1, 1.0, True, "1", {"a": 1, "b": [2]}, {"b": [2.0], "a": True}, None, None]) == [1, "1", {"a": 1, "b": [2]}, None]
