"""The driver's queries for the list operators: each operator over a whole table, with DuckDB SQL for the same result."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions import dates, text
from sievewright.operators import enrich, explore, extract, staging
from sievewright.plans import mapping, postnorm, prenorm
from sievewright.sources import html, jsonl, pdf, scan, tabular, xml

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function: Callable[[Callable[[str], DataFrame]], DataFrame]):
        # wide: rows that are heavy each go to all cores
        QUERIES[name] = lambda spark, sf_dir: function(lambda table, wide=False: (scan.spread if wide else lambda rows: rows)(spark.read.parquet(f"{sf_dir}/{table}.parquet")))
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return add


# Exploration


@query("value_explorer", "SELECT DISTINCT trim(props->>'k') AS value FROM events WHERE props->>'k' IS NOT NULL")
def _(t):
    return explore.distinct_values(t("events", True).select(F.try_parse_json("props").alias("v")), "k")


@query(
    "schema_profile",
    """WITH n AS (SELECT count(*) AS c FROM events)
    SELECT field, type, false AS optional, c AS occurrences
    FROM n, (VALUES ('event_id', 'integer'), ('event_type', 'string'), ('list', 'array'), ('list[]', 'array'), ('list[].user', 'integer'),
                    ('list[].deep', 'array'), ('list[].deep[]', 'array'), ('props', 'object'), ('props.k', 'integer')) AS f(field, type)
    UNION ALL
    SELECT 'extra', 'integer | string', true, count(*) FROM events WHERE event_id % 3 < 2""",
)
def _(t):
    extra = F.when(F.col("event_id") % 3 == 0, F.lit(',"extra":1')).when(F.col("event_id") % 3 == 1, F.lit(',"extra":"one"')).otherwise(F.lit(""))
    parts = [F.lit('{"event_id":'), F.col("event_id"), F.lit(',"event_type":"'), F.col("event_type"), F.lit('","props":'), F.col("props")]
    line = F.concat(*parts, extra, F.lit(',"list":[{"user":'), F.col("user_id"), F.lit(',"deep":[1]}]}'))
    return explore.schema_profile(t("events", True).select(line.alias("value")))


@query("deep_values", "SELECT DISTINCT trim(value) AS value FROM (SELECT o_orderstatus AS value FROM orders UNION ALL SELECT o_orderpriority FROM orders) WHERE trim(value) <> ''")
def _(t):
    # one value below six lists, one below a single list, and an empty one
    line = F.concat(F.lit('{"a":[[[[[[{"k":" '), "o_orderstatus", F.lit('"}]],[]]]],{"k":"'), "o_orderpriority", F.lit('"},{"k":" "},{"k":[1]}]}'))
    return explore.distinct_values(t("orders", True).select(F.try_parse_json(line).alias("v")), "a.k", blanks=False)


@query("preview50", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey, o_totalprice LIMIT 50")
def _(t):
    return explore.preview(t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderkey", "o_totalprice")


# Scalars


@query("before_parenthesis", "SELECT p_partkey, trim(replace(split_part(p_name || ': (' || p_type || '):', '(', 1), ':', '')) AS plain FROM part")
def _(t):
    return t("part").select("p_partkey", text.before_parenthesis(F.concat("p_name", F.lit(": ("), "p_type", F.lit("):"))).alias("plain"))


@query("remove_list_markers", r"SELECT doc_id, md5(regexp_replace(regexp_replace('(a) ' || text || ' (b)  c', '\([A-Za-z]\)\s*', '', 'g'), '^\s+|\s+$', '', 'g')) AS digest FROM documents")
def _(t):
    return t("documents", True).select("doc_id", F.md5(text.remove_list_markers(F.concat(F.lit("(a) "), "text", F.lit(" (b)  c")))).alias("digest"))


@query("enum_map", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status FROM orders")
def _(t):
    return t("orders").select("o_orderkey", text.enum_map(F.col("o_orderstatus"), "F=Final|O=Open|F=Finished|odd").alias("status"))


@query(
    "unique_id",
    """SELECT c_custkey, 'ATC-' || CASE WHEN c_custkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) ELSE 'UNKNOWN' END || '-' ||
    substr(md5(lower(trim(c_name))), 1, 10) AS id FROM customer""",
)
def _(t):
    resolution = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("under RESOLUTION no. "), F.col("c_nationkey"), F.lit(", Resolution No 7"))).otherwise("none")
    return t("customer", True).select("c_custkey", text.resolution_id("ATC", resolution, F.concat(F.lit(" "), "c_name")).alias("id"))


@query(
    "url_slug",
    "SELECT page_id, trim(url_decode(split_part(trim(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), '/', -1))) AS slug FROM pages",
)
def _(t):
    return t("pages").select("page_id", text.name_from_url(F.col("url")).alias("slug"))


_NAMES = "s_name || CASE s_suppkey % 4 WHEN 0 THEN ' Trading' WHEN 1 THEN ' Vincent' WHEN 2 THEN ' Smith' ELSE ' & Co. ' END"


@query("org_keyword_type", "SELECT s_suppkey, " + " OR ".join(f"contains(upper({_NAMES}), '{w}')" for w in text.ORGANISATION_WORDS) + " AS organisation FROM supplier")
def _(t):
    return t("supplier").select("s_suppkey", text.has_organisation_word(F.expr(_NAMES)).alias("organisation"))


_KINDS = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ' Person' WHEN 'BUILDING' THEN 'Entity' WHEN 'MACHINERY' THEN 'organisation' WHEN 'HOUSEHOLD' THEN 'VESSEL' ELSE '' END"


@query(
    "entity_type_map",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Individual' WHEN 'BUILDING' THEN 'Organization' WHEN 'MACHINERY' THEN 'Organization'
    WHEN 'HOUSEHOLD' THEN 'Vessel' ELSE CASE WHEN c_custkey % 3 = 0 THEN 'Vessel' ELSE 'Individual' END END AS kind FROM customer""",
)
def _(t):
    return t("customer").select("c_custkey", text.canonical_type(F.expr(_KINDS), F.col("c_custkey") % 3 == 0).alias("kind"))


@query(
    "split_date_place",
    """WITH r AS (SELECT o_orderkey, o_orderkey % 5 AS s, strftime(o_orderdate, '%-d %b %Y') AS d FROM orders)
    SELECT o_orderkey, CASE s WHEN 0 THEN d WHEN 4 THEN d ELSE '' END AS born,
    CASE s WHEN 0 THEN 'Some Town, Province' WHEN 1 THEN 'Town' WHEN 2 THEN 'Town, Province' ELSE '' END AS place FROM r""",
)
def _(t):
    d = F.date_format("o_orderdate", "d MMM yyyy")
    shapes = [F.concat(d, F.lit(", Some Town, Province")), F.lit("N/A, Town"), F.lit("Town, Province"), F.lit(" unknown "), d]
    x = F.coalesce(*(F.when(F.col("o_orderkey") % 5 == k, s) for k, s in enumerate(shapes)))
    born, place = text.date_and_place(x)
    return t("orders", True).select("o_orderkey", born.alias("born"), place.alias("place"))


@query("clean_text", r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^ | $', '', 'g')) AS digest FROM documents")
def _(t):
    return t("documents", True).select("doc_id", F.md5(text.clean_text(F.col("text"))).alias("digest"))


# Dates

_RENDERED = ["yyyy-MM-dd", "d MMMM yyyy", "MMMM d, yyyy", "dd/MM/yyyy", "yyyy"]


@query(
    "date_token",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, CASE WHEN o_orderkey % 5 = 4 THEN '' ELSE strftime(o_orderdate, '%m') END AS month,
    CASE WHEN o_orderkey % 5 = 4 THEN '' ELSE strftime(o_orderdate, '%d') END AS day FROM orders""",
)
def _(t):
    x = F.coalesce(*(F.when(F.col("o_orderkey") % 5 == k, F.date_format("o_orderdate", f)) for k, f in enumerate(_RENDERED)))
    return t("orders", True).select("o_orderkey", dates.date_token(x).alias("d")).select("o_orderkey", "d.year", "d.month", "d.day")


@query(
    "date_multi",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ';' || strftime(o_orderdate, '%Y') || '--;' || strftime(o_orderdate, '%Y-%m') || '-' AS found FROM orders""",
)
def _(t):
    d = F.col("o_orderdate")
    x = F.concat(F.date_format(d, "d MMMM yyyy"), F.lit(" or "), F.date_format(d, "yyyy-MM-dd 10:11:12"), F.lit(", Approximately "), F.date_format(d, "yyyy; MM/yyyy"), F.lit("; 12 foo 1990"))
    each = F.transform("d", lambda i: F.concat_ws("-", i["year"], i["month"], i["day"]))
    return t("orders", True).select("o_orderkey", dates.all_dates(x).alias("d")).select("o_orderkey", F.array_join(each, ";").alias("found"))


# Pre- and post-normalisation


@query(
    "wildcard_rules",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE c_mktsegment END AS segment,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE c_name || ' :' END AS name FROM customer""",
)
def _(t):
    rules = [
        prenorm.Rule("s", "*", "segment", "enum", "BUILDING=B|MACHINERY=M"),
        prenorm.Rule("s", "B", "names[].n", "before_parenthesis"),
        prenorm.Rule("s", "*", "names[].n", "remove_list_markers"),
        prenorm.Rule("other", "*", "names[].n", "enum", "x=y"),
        prenorm.Rule("s", "*", "names[].n", "no_such_kind"),
    ]
    plan = prenorm.compile_rules(rules, {"s": "segment"}, "s")
    names = F.array(F.struct(F.concat("c_name", F.lit(" (k):")).alias("n")))
    record = F.to_json(F.struct(F.col("c_mktsegment").alias("segment"), names.alias("names")))
    made = t("customer", True).select("c_custkey", prenorm.pre_normalize(record, plan).alias("r"))
    return made.select("c_custkey", F.get_json_object("r", "$.segment").alias("segment"), F.get_json_object("r", "$.names[0].n").alias("name"))


@query(
    "postnorm_rules",
    """SELECT o_orderkey, '{"dates": [{"date_full": "' || strftime(o_orderdate, '%Y-%m-%d') || '", "year": "' || strftime(o_orderdate, '%Y') || '", "month": "' ||
    strftime(o_orderdate, '%m') || '", "day": "' || strftime(o_orderdate, '%d') || '"}], "a": [{"t": ""}, {"t": "x"}], "b": [{"u": "none"}, {}], "s": ["' ||
    o_orderstatus || '"]}' AS record FROM orders""",
)
def _(t):
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    record = F.format_string('{"dates":[{"date_full":"%s"},{"date_full":"%s","x":1}],"a":[{"t":""},{"t":"x"}],"b":[{"u":"1"}],"s":["%s","%s"],"comment":""}', d, d, "o_orderstatus", "o_orderstatus")
    rules = [
        postnorm.Rule(3, "DEDUPLICATE_ALL_ARRAYS"),
        postnorm.Rule(1, "DATE_NORMALIZATION", "dates"),
        postnorm.Rule(2, "EMPTY_DEPENDENCY", "a[].t", "b[].u", "none"),
        postnorm.Rule(0, "UNKNOWN"),
    ]
    return t("orders", True).select("o_orderkey", postnorm.post_normalize(record, rules).alias("record"))


@query(
    "empty_dependency",
    """SELECT o_orderkey, '[{"a":{"t":"' || o_orderstatus || '"},"b":{"u":"1"}},{"a":{"t":""},"b":{"u":"none"}},{"b":{"u":"none"}}]' AS pairs FROM orders""",
)
def _(t):
    a = F.array(F.struct(F.col("o_orderstatus").alias("t")), F.struct(F.lit("").alias("t")))
    b = F.array(*(F.struct(F.lit(x).alias("u")) for x in "123"))
    return t("orders", True).select("o_orderkey", F.to_json(postnorm.dependent_items(a, "t", b, "u", "none")).alias("pairs"))


_LINE = "lpad(CAST(l_linenumber AS STRING), 3, '0') || lpad(CAST(l_partkey AS STRING), 9, '0') || lpad(CAST(l_suppkey AS STRING), 9, '0') || l_returnflag"


@query(
    "dedup_arrays",
    f"""SELECT l_orderkey, string_agg(l_returnflag, ',' ORDER BY k) AS flags FROM
    (SELECT l_orderkey, l_returnflag, min({_LINE.replace("STRING", "VARCHAR")}) AS k FROM lineitem GROUP BY ALL) GROUP BY ALL""",
)
def _(t):
    lines = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(F.expr(_LINE).alias("k"), F.col("l_returnflag").alias("f")))).alias("ls"))
    return lines.select("l_orderkey", F.array_join(postnorm.distinct_items(F.transform("ls", lambda x: x["f"])), ",").alias("flags"))


# Mapping


def _orders(t) -> DataFrame:
    """v: a record per order, with its lines in a fixed order."""
    line = F.struct(F.expr(_LINE).alias("k"), F.struct(F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("flag")).alias("l"))
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["l"]).alias("lines"))
    orders = t("orders").groupBy("o_orderkey").agg(F.min("o_orderstatus").alias("status")).join(lines, "o_orderkey")
    record = F.struct(F.lit("entity").alias("Type"), F.col("o_orderkey").alias("key"), "status", "lines")
    return orders.select("o_orderkey", F.parse_json(F.to_json(record)).alias("v"))


def _customers(t) -> DataFrame:
    tags = F.array(F.struct(F.lit("P").alias("k"), F.col("c_name").alias("x")), F.struct(F.lit("S").alias("k"), F.lit(None).cast("string").alias("x")))
    record = F.struct(
        F.lit("entity").alias("Type"),
        F.col("c_name").alias("name"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("segment "),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey")).alias("nation"),
        F.concat_ws("|", F.col("c_mktsegment"), F.lit(" n/a"), F.lit(" .b. "), F.lit("")).alias("parts"),
        tags.alias("tags"),
    )
    return t("customer", True).select("c_custkey", F.parse_json(F.to_json(record)).alias("v"))


def _rule(target: str, kind: str | None, value: str | None, group: str | None = None, target_type: str = "") -> mapping.Rule:
    return mapping.Rule("Organization", target, target_type, group, kind, value)


def _mapped(records: DataFrame, *rules: mapping.Rule) -> DataFrame:
    return mapping.map_records(records, list(rules)).drop("v", "mapped_type")


def _per_order(json: str) -> str:
    return f"""WITH o AS (SELECT o_orderkey, min(o_orderstatus) AS status FROM orders GROUP BY ALL),
    l AS (SELECT l_orderkey AS o_orderkey, list({{'n': l_linenumber, 'flag': l_returnflag}} ORDER BY {_LINE.replace("STRING", "VARCHAR")}) AS lines FROM lineitem GROUP BY ALL)
    SELECT o_orderkey, {json} AS mapped FROM o JOIN l USING (o_orderkey)"""


@query(
    "map_path_expand",
    _per_order("CAST(to_json({'status': status, 'items': list_transform(lines, lambda x: {'no': x.n, 'flag': x.flag, 'all': 'true', 'key': o_orderkey, 'gen': ''})}) AS VARCHAR)"),
)
def _(t):
    g = "items"
    return _mapped(
        _orders(t),
        _rule("status", "path", "status"),
        _rule("items[].no", "path", "lines[].n", g),
        _rule("items[].flag", "path", "flag", g),
        _rule("items[].all", "constant", '"TRUE"', g),
        _rule("items[].key", "path", "key", g),
        _rule("items[].gen", "path_expand", "lines[]", g),
    )


@query(
    "map_conditional",
    _per_order("CAST(to_json({'first': coalesce(CAST(list_filter(lines, lambda x: x.flag = 'R')[1].n AS VARCHAR), '')}) AS VARCHAR)"),
)
def _(t):
    made = _mapped(_orders(t), _rule("first", "conditional_path", 'lines[].flag | "r" | lines[].n'))
    # the number as text, so that an order without such a line and one with it have a field of one type
    return made.withColumn("mapped", F.to_json(F.struct(F.get_json_object("mapped", "$.first").alias("first"))))


@query(
    "root_fallback",
    """SELECT c_custkey, CAST(to_json({'tags': [{'k': 'P', 'x': c_name, 'gen': ''}, {'k': 'S', 'x': c_name, 'gen': ''}]}) AS VARCHAR) AS mapped FROM customer""",
)
def _(t):
    return _mapped(_customers(t), _rule("tags[].k", "path", "k", "t"), _rule("tags[].x", "path", "tags[].x", "t"), _rule("tags[].gen", "path_expand", "tags[]", "t"))


@query(
    "map_star",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(to_json({'ids': [{'type': 'Name', 'value': c_name}]}) AS VARCHAR)[:-3] ||
    ',{"type":"Nation","value":' || c_nationkey || '}]}' ELSE CAST(to_json({'ids': [{'type': 'Name', 'value': c_name}]}) AS VARCHAR) END AS mapped FROM customer""",
)
def _(t):
    return _mapped(_customers(t), _rule("ids[].type", "constant * constant", '"Name" * "Nation"', "i"), _rule("ids[].value", "path * path", "name * nation", "i"))


@query(
    "map_explode",
    """SELECT c_custkey, CAST(to_json({'parts': [{'p': c_mktsegment, 'kind': 'x'}, {'p': 'b', 'kind': 'x'}], 'words': [c_mktsegment, 'b']}) AS VARCHAR) AS mapped FROM customer""",
)
def _(t):
    made = _mapped(_customers(t), _rule("parts[].p", "explode", "parts,|", "p"), _rule("parts[].kind", "constant", "x", "p"), _rule("words", "explode", "parts"))
    return made.withColumn("mapped", F.to_json(F.from_json("mapped", "parts array<struct<p:string,kind:string>>, words array<string>")))


@query("map_concat", "SELECT c_custkey, CAST(to_json({'full': c_name || ' ' || c_mktsegment, 'empty': ''}) AS VARCHAR) AS mapped FROM customer")
def _(t):
    return _mapped(_customers(t), _rule("full", "concat_path", "name | missing | segment"), _rule("empty", "concat_path", None))


@query(
    "map_expand_parallel",
    """SELECT c_custkey, CAST(to_json({'x': [{'t': 'Name', 'v': c_name, 'w': ''}, {'t': 'Missing', 'v': '', 'w': ''}, {'t': 'More', 'v': '', 'w': ''}]}) AS VARCHAR) AS mapped FROM customer""",
)
def _(t):
    return _mapped(_customers(t), _rule("x[].t", "expand", 'Name | "Missing" | More', "x"), _rule("x[].v", "parallel_path", "name | missing", "x"), _rule("x[].w", "path", "missing", "x"))


@query("map_raw", """SELECT c_custkey, '{"all":{"Type":"entity","key":' || c_custkey || '},"rest":null,"skipped":""}' AS mapped FROM customer""")
def _(t):
    records = t("customer", True).select("c_custkey", F.parse_json(F.to_json(F.struct(F.lit("entity").alias("Type"), F.col("c_custkey").alias("key")))).alias("v"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return _mapped(records, _rule("all", "raw", None, target_type="raw"), _rule("rest", None, None, target_type="json"), _rule("skipped", "no_such_kind", "key"))


@query(
    "group_suppression",
    """SELECT c_custkey, CAST(to_json({'nest': {'deep': {'d': ''}, 'list': CAST([] AS VARCHAR[])}, 'only': CAST([] AS VARCHAR[]), 'made': [{'t': 'a'}]}) AS VARCHAR) AS mapped FROM customer""",
)
def _(t):
    return _mapped(
        _customers(t),
        _rule("only[].t", "constant", "a", "o"),
        _rule("only[].v", "path", "missing", "o"),
        _rule("made[].t", "constant", "a", "m"),
        _rule("made[].t", "expand", "a", "m"),
        _rule("nest.deep.d", "path", "missing"),
        _rule("nest.list", None, None, target_type="array"),
    )


# Sources


@query(
    "html_listing",
    """SELECT 'Individual' AS entity_type, s_name AS name, 'c & d' AS category, 'Resolution No. ' || s_nationkey AS atc_resolution_no, '' AS date_issued,
    '/s/' || s_suppkey AS detail_url FROM supplier WHERE s_suppkey % 10 <> 0""",
)
def _(t):
    name = F.when(F.col("s_suppkey") % 10 == 0, "  ").otherwise(F.concat(F.lit("\n "), F.col("s_name")))
    page = F.concat(
        F.lit('<table id="other"><tr><td class="column-1">no</td></tr></table><table id="tablepress-33"><thead><tr><th class="column-1">Name</th></tr></thead><tbody><tr><td class="column-1"><a href="/s/'),
        F.col("s_suppkey"), F.lit('">'), name, F.lit('</a></td><td class="x column-2">c &amp;<br>d</td><td class="column-3">Resolution  No. '), F.col("s_nationkey"), F.lit("</td></tr></tbody></table>"),
    )
    return html.individuals(t("supplier").select(page.alias("content")))


@query("html_title", "SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\\s+', ' ', 'g')) AS title FROM pages")
def _(t):
    return t("pages").select("page_id", text.clean_text(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))


@query(
    "html_groups",
    "SELECT 'Organization' AS entity_type, s_name || ' and ' || s_suppkey AS name, '' AS category, CAST(s_nationkey AS VARCHAR) AS atc_resolution_no, '1 May 2020' AS date_issued FROM supplier",
)
def _(t):
    page = F.concat(
        F.lit('<table id="tablepress-31"><tbody><tr><td class="column-1">'), "s_name", F.lit('</td><td class="a column-11"> and\n'), "s_suppkey", F.lit('</td><td class="column-3">'), "s_nationkey",
        F.lit('</td><td class="column-4">1 May\t2020</td></tr><tr><td class="column-1"> </td></tr></tbody></table>'),
    )
    return html.groups(t("supplier").select(page.alias("content")))


@query(
    "xml_records",
    """SELECT n_nationkey, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region, '["' || n_name || '","x"]' AS alias, 'leaf' AS note FROM nation""",
)
def _(t):
    # each document holds a sound row, one that is broken and lost, and another sound one
    row = F.concat(F.lit('<a:R key="'), "n_nationkey", F.lit('"><name> '), "n_name", F.lit(" </name><alias>"), "n_name", F.lit("</alias><alias>x</alias><region/><in><r>"), "n_regionkey", F.lit("</r></in><note>leaf</note></a:R>"))
    page = F.concat(F.lit('<?xml version="1.0"?><l xmlns:a="urn:a"><R key="0"><name>x & y</name></R>'), row, F.lit("</l>")).cast("binary")
    made = xml.records_of(t("nation").select(page.alias("content")), "R")
    field = lambda name: F.get_json_object("record", f"$.{name}")
    return made.select(field("key").cast("int").alias("n_nationkey"), field("name").alias("name"), field("in.r").alias("region"), field("alias").alias("alias"), field("note").alias("note"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder where the session's executors share one, for queries that read what they wrote."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(where or tempfile.mkdtemp(prefix='sievewright-')).rstrip('/')}/sievewright-lists-{name}-{uuid.uuid4().hex}"


@query(
    "csv_records",
    """SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END AS name, '"' || p_brand || '", x' AS brand, '' AS "Unnamed: 3" FROM part""",
)
def _(t):
    parts = t("part").select(F.col("p_partkey").alias("key"), F.when(F.col("p_partkey") % 3 == 0, "N/A").otherwise(F.col("p_name")).alias("name"), F.concat(F.lit('"'), "p_brand", F.lit('", x')).alias("brand"), F.lit("null").alias(" "))
    where = _folder(parts.sparkSession, "csv")
    parts.withColumnRenamed(" ", "").write.option("header", "true").option("escape", '"').csv(where)
    return tabular.read_csv(parts.sparkSession, where)


@query("jsonl_round_trip", """SELECT c_custkey, c_name AS name, '{"c_custkey":' || c_custkey || ',"name":"' || c_name || '","none":null}' AS record FROM customer""")
def _(t):
    records = t("customer").select(jsonl.line(F.col("c_custkey"), F.col("c_name").alias("name"), F.lit(None).cast("string").alias("none")).alias("record"))
    where = _folder(records.sparkSession, "jsonl")
    jsonl.write(records, where)
    back = jsonl.read(records.sparkSession, where)
    return back.select(F.try_variant_get("v", "$.c_custkey", "long").alias("c_custkey"), F.try_variant_get("v", "$.name", "string").alias("name"), "record")


@query("pdf_stitch", "SELECT c_nationkey AS nation, c_custkey, c_name AS name, c_mktsegment AS segment FROM customer")
def _(t):
    customers = t("customer", True).select(
        F.concat(F.lit("n"), "c_nationkey").alias("file"), (F.col("c_custkey") % 3 + 1).cast("int").alias("page"), F.lit(1).alias("tbl"), (F.col("c_custkey") + 10).cast("int").alias("line"),
        F.array(F.col("c_custkey").cast("string"), F.concat(F.lit(" "), "c_name"), F.lit("lost"), "c_mktsegment").alias("cells"),
    )
    files = customers.select("file").distinct().select("file", F.explode(F.array(*map(F.lit, (0, 1, 2, 3)))).alias("page"))
    head = files.select("file", "page", F.lit(1).alias("tbl"), F.lit(1).alias("line"), F.array(*map(F.lit, ("No.", "Full\nName", " ", "Segment"))).alias("cells"))
    blank = files.select("file", "page", F.lit(1).alias("tbl"), F.lit(2).alias("line"), F.array(F.lit(" "), F.lit(None).cast("string")).alias("cells"))
    found = pdf.stitch(customers.union(head).union(blank))
    return found.select(F.substring("file", 2, 9).cast("int").alias("nation"), F.col("record")["No"].cast("long").alias("c_custkey"), F.col("record")["Full Name"].alias("name"), F.col("record")["Segment"].alias("segment"))


# Enrichment, lookups, staging


@query(
    "vessel_filter",
    """SELECT p_partkey AS "IMO number", p_name AS "Vessel name at designation time", CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END AS "Date of application",
    CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_type END AS "Link to relevant EU Official Journal " FROM part WHERE p_partkey % 3 <> 0""",
)
def _(t):
    key, blank = F.col("p_partkey"), lambda n, x, y: F.when(F.col("p_partkey") % n == 0, y).otherwise(x)
    rows = t("part").select(
        F.concat(F.lit(" "), key).alias("IMO number"), blank(3, F.concat("p_name", F.lit(" ")), " ").alias("Vessel name at designation time"),
        blank(5, F.col("p_brand"), "#REF!").alias("Date of application"), blank(7, F.col("p_type"), " #REF! ").alias("Link to relevant EU Official Journal "),
    )
    return enrich.fix_vessel_rows(rows).withColumn("IMO number", F.col("IMO number").cast("long"))


@query(
    "profile_join",
    """SELECT s_suppkey, 'supplier-' || s_suppkey AS slug, CASE WHEN s_suppkey % 4 <> 0 THEN 'p/SUPPLIER ' || s_suppkey || ' _ Anti-Terrorism Council.html' END AS page,
    CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS name, CASE WHEN s_suppkey % 4 <> 0 THEN '/i.png' END AS image, CASE WHEN s_suppkey % 4 = 0 THEN -1 WHEN s_suppkey % 2 = 1 THEN 1 ELSE 0 END
    AS own_images FROM supplier""",
)
def _(t):
    suppliers = t("supplier").select("s_suppkey", "s_name")
    rows = suppliers.select("s_suppkey", F.concat(F.lit("https://h/list/supplier-"), "s_suppkey", F.lit("/")).alias("detail_url"))
    head = F.concat(F.lit('<img src="/logo.png"><article><table><tr><td>Name:</td><td>'), "s_name", F.lit('</td></tr></table><img src="/i.png"></article>'))
    path = lambda folder: F.concat(F.lit(folder), F.lit("/SUPPLIER "), "s_suppkey", F.lit(" _ Anti-Terrorism Council.html"))
    # every page stands in two folders, of which the first counts
    pages = suppliers.where("s_suppkey % 4 <> 0").select(path("p").alias("path"), head.alias("content")).union(suppliers.select(path("q"), F.lit("")).where("s_suppkey % 4 <> 0"))
    images = suppliers.where("s_suppkey % 2 = 1").select(F.concat(F.lit("i/my supplier "), F.col("s_suppkey"), F.lit(". jpg")).alias("path"))
    made = enrich.attach_profiles(rows, pages, images)
    exact = F.filter(F.col("profile_data.local_images"), lambda p: p.endswith(F.concat(F.lit(" "), F.col("s_suppkey"), F.lit(". jpg"))))
    return made.select(
        "s_suppkey", F.col("profile_slug").alias("slug"), F.col("profile_data.profile_file").alias("page"), F.col("profile_data.profile_fields")["Name:"].alias("name"),
        F.get("profile_data.image_urls", F.lit(0)).alias("image"), F.coalesce(F.size(exact), F.lit(-1)).alias("own_images"),
    )


@query(
    "staging_join",
    """SELECT c_custkey, n_name, r_name, t.least FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN (SELECT n_regionkey AS k, min(n_nationkey) AS least FROM nation GROUP BY ALL) t ON t.k = n_regionkey""",
)
def _(t):
    types = staging.list_type_of_source(t("nation").select(F.col("n_regionkey").alias("source_id"), F.col("n_nationkey").alias("id")))
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").join(types, F.col("n_regionkey") == F.col("source_id"), "left")
    found = t("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    key = F.col("c_nationkey").cast("string")
    return found.select("c_custkey", staging.required(F.col("n_name"), key).alias("n_name"), staging.required(F.col("r_name"), key).alias("r_name"), F.col("list_type_id").alias("least"))


@query("record_hash", """SELECT n_nationkey, sha256('{"a":"' || n_name || '","b":' || n_nationkey || '}') AS hash FROM nation""")
def _(t):
    return t("nation").select("n_nationkey", staging.record_hash(F.to_json(F.struct(F.col("n_nationkey").alias("b"), F.col("n_name").alias("a")))).alias("hash"))


@query(
    "staged_rows",
    """SELECT CAST(c_custkey AS VARCHAR) AS external_id, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END AS entity_type_id, DATE '2050-01-01' AS valid_to, 'None' AS extracted_name
    FROM customer""",
)
def _(t):
    kind = F.when(F.col("c_custkey") % 2 == 0, "Individual").otherwise("Organization")
    records = t("customer").select(F.col("c_custkey").cast("string").alias("external_id"), F.to_json(F.struct(kind.alias("entity_type"), "c_name")).alias("record"))
    types = t("region").sparkSession.createDataFrame([(1, "INDIVIDUAL"), (2, "ORGANIZATION")], "id int, name string")
    return staging.staged(records, types).select("external_id", "entity_type_id", "valid_to", "extracted_name")


@query("llm_stub", """SELECT doc_id, '{"name": "", "sources": []}' AS answer FROM documents""")
def _(t):
    return t("documents", True).select("doc_id", extract.extract(F.col("text"), extract.Stub, {"name": "", "sources": []}).alias("answer"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines mapped to nested entities."""
    return QUERIES["map_path_expand"](spark, sf_dir)

