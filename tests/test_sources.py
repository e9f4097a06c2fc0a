"""Sources, enrichment, exploration, staging, extraction, the list pipeline and scheduled ingestion, on small invented files."""

import hashlib
import io
import json
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sievewright import analyst, files, pipeline
from sievewright.config import Source
from sievewright.operators import enrich, explore, extract, staging
from sievewright.plans import mapping, postnorm, prenorm
from sievewright.registry import find, register
from sievewright.sources import download, html, jsonl, pdf, tabular, xml
from sievewright.streaming import landing

# XML

XML = """<?xml version="1.0"?><list xmlns="urn:x" xmlns:p="urn:p"><Designation id="1.10"><Name p:lang="en"> A </Name><Empty/><Group><Item>x</Item><Item> y </Item></Group>
<Deep><Designation><Name>inner</Name></Designation></Deep><id>2</id></Designation><Other/><p:Designation><Name>B</Name>tail<Item>x</Item></p:Designation><Designation>bare</Designation>"""


def test_xml_records(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML + "</list>", encoding="utf-8")
    (tmp_path / "b.xml").write_text("<list><Designation><N>1</N></Designation><Designation><broken", encoding="utf-8")
    rows = [json.loads(r.record) for r in xml.read(spark, f"{tmp_path}/*.xml").collect()]
    assert {"N": "1"} in rows and len(rows) == 4
    first = next(r for r in rows if "Group" in r)
    assert first == {
        "id": ["1.10", "2"], "Name": {"{urn:p}lang": "en", "text": "A"}, "Empty": "", "Group": {"Item": ["x", "y"]}, "Deep": {"Designation": {"Name": "inner"}},
    }
    assert {"Name": "B", "Item": "x"} in rows and {"text": "bare"} in rows


def test_xml_by_schema_keeps_text(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<l xmlns="urn:x"><r id="1.10"><n>007</n></r></l>')
    assert xml.read_typed(spark, str(tmp_path), "id string, n string", "r").collect() == [("1.10", "007")]


# tables


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,,x,y \n1,NA, a ,"q ""r""\nnext"\n,null,007,\n')
    df = tabular.read_csv(spark, f"{tmp_path}/a.csv")
    assert df.columns == ["x", "Unnamed: 1", "x.1", "y "]
    assert [tuple(r) for r in df.collect()] == [("1", "", " a ", 'q "r"\nnext'), ("", "", "007", "")]


def xlsx(rows, shared=True):
    texts = [str(c) for r in rows for c in r if c is not None]
    cells = []
    for i, r in enumerate(rows, 1):
        own = []
        for k, c in enumerate(r):
            if c is None:
                continue
            at = f"{chr(65 + k)}{i}"
            own.append(f'<c r="{at}" t="s"><v>{texts.index(str(c))}</v></c>' if isinstance(c, str) else f'<c r="{at}"><v>{c}</v></c>')
        cells.append(f'<row r="{i}">{"".join(own)}</row>')
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="One" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>{''.join(f'<si><t>{t}</t></si>' for t in texts)}</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{''.join(cells)}</sheetData></worksheet>")
    return out.getvalue()


VESSELS = [
    [None, "Vessel name at designation time", "IMO number", "Date of application", "Link to relevant EU Official Journal "],
    ["1", " Sea ", 9000001, "#REF!", " http://x "],
    ["2", " ", 9000002, "d", "l"],
    ["3", "Ocean", None, "d", "l"],
    ["4", "Lake", 9000004, "NA", "#REF!"],
]


def test_xlsx_and_vessel_rows(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(xlsx(VESSELS))
    df = tabular.read_xlsx(spark, str(tmp_path / "a.xlsx"))
    assert df.columns[0] == "Unnamed: 0" and df.columns[4].endswith(" ") and df.count() == 4
    rows = enrich.fix_vessel_rows(df).collect()
    assert [tuple(r)[1:] for r in rows] == [("Sea", "9000001", "", "http://x"), ("Lake", "9000004", "", "")]
    assert tabular.read_xlsx(spark, str(tmp_path / "a.xlsx"), "One").count() == 4
    with pytest.raises(ValueError, match="no sheet"):
        tabular.read_xlsx(spark, str(tmp_path / "a.xlsx"), "Two")
    assert tabular.as_records(spark.createDataFrame([(1, None)], "a int, b string")).collect() == [("1", "")]


# HTML

LISTING = """<html><table id="tablepress-31"><thead><tr><th class="column-1">Name</th></tr></thead><tbody>
<tr class="row-2"><td class="column-1"> Invented<br>Group </td><td class="column-2">Cat</td><td class="column-3">Resolution No. 12 and Resolution No. 13</td><td class="column-4">3 May 2020</td></tr>
<tr><td class="column-1"> </td><td class="column-2">Cat</td></tr><tr><td class="column-1">Second &amp; Co</td><td class="column-2"></td><td class="column-10">no</td></tr></tbody></table></html>"""


def test_listings(spark, tmp_path):
    (tmp_path / "g.html").write_text(LISTING)
    rows = html.read(spark, str(tmp_path / "g.html"), "ATC-DESIGNATED-TERRORIST-GROUPS").collect()
    assert [tuple(r) for r in rows] == [
        ("Organization", "Invented Group", "Cat", "Resolution No. 12 and Resolution No. 13", "3 May 2020"), ("Organization", "Second & Co no", "", "", ""),
    ]
    with pytest.raises(ValueError, match="unknown html"):
        html.read(spark, str(tmp_path), "nobody")


def test_profiles(spark, tmp_path):
    page = '<img src="logo.png"><table><tr><td>menu</td><td>no</td></tr></table><article><table><tr><td>Name:</td><td>Ann <b>Lee</b></td><td>third</td></tr>'
    page += '<tr><td>Alias/es</td><td>N/A</td></tr><tr><td>x</td></tr></table><img src="a.jpg"><img src="a.jpg"></article>'
    (tmp_path / "ANN LEE _ Anti-Terrorism Council.html").write_text(page)
    (tmp_path / "ANN LEE.html").write_text("<article><table><tr><td>Name:</td><td>another page</td></tr></table></article>")
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "ANN LEE _ Anti-Terrorism Council.html").write_text("<article></article>")
    (tmp_path / "img").mkdir()
    for name in ("Ann Lee 1.jpg", "other.png"):
        (tmp_path / "img" / name).write_bytes(b"x")
    people = spark.createDataFrame([("Ann", "https://h/p/ann-lee/"), ("Bob", "https://h/p/bob"), ("None", "")], "name string, detail_url string")
    # two pages of one name, of which one counts
    pages = html.read_pages(spark, f"{tmp_path}/*.html").union(html.read_pages(spark, f"{tmp_path}/z/*.html"))
    images = spark.read.format("binaryFile").load(f"{tmp_path}/img").select("path")
    rows = {r.name: r for r in enrich.attach_profiles(people, pages, images).collect()}
    data = rows["Ann"].profile_data
    assert rows["Bob"].profile_data is None and rows["None"].profile_data is None and len(rows) == 3
    assert data.profile_file == f"file:{tmp_path}/ANN LEE _ Anti-Terrorism Council.html" and data.profile_fields == {"Name:": "Ann Lee", "Alias/es": "N/A", "x": ""}
    assert (data.profile_slug, data.image_urls, data.local_images) == ("ann-lee", ["a.jpg", "a.jpg"], [f"file:{tmp_path}/img/Ann Lee 1.jpg"])
    assert enrich.attach_profiles(people, profile_dir=str(tmp_path), images_dir=f"{tmp_path}/img").where("name = 'Ann'").first().profile_data == data
    assert [r.profile_data.profile_file for r in enrich.attach_profiles(people, pages, suffix="").collect() if r.profile_data] == [f"file:{tmp_path}/ANN LEE.html"]
    json_rows = people.select(F.to_json(F.struct("*")).alias("record"))
    rules = [{"handler": "attach_profiles", "options": {"profile_dir": str(tmp_path), "images_dir": f"{tmp_path}/img"}}]
    made = {json.loads(r.record)["name"]: json.loads(r.record) for r in enrich.enrich_json(json_rows, rules, "record").collect()}
    assert made["Ann"]["profile_data"]["local_images"] == data.local_images and "profile_data" not in made["Bob"] and len(made) == 3
    frame = enrich.attach_profiles(people, pages).select("name", enrich.clean_profile_names(F.col("profile_data.profile_fields"), ["Alias/es", "Variant/s"]).alias("f"))
    assert {r.name: r.f for r in frame.collect()} == {"Ann": {"Name:": "Ann Lee", "x": "", "Alias/es": "", "Variant/s": ""}, "Bob": None, "None": None}


def test_enrichment_rules(spark):
    register("enrich:record", "mark")(lambda rows, value="x": rows.withColumn("mark", F.lit(value)))
    frame = spark.range(1)
    rules = [{"handler": "mark", "options": {"value": "y"}}, {"handler": "unused", "level": "dataset"}]
    assert enrich.enrich(frame, rules, "record").first().mark == "y"
    with pytest.raises(ValueError, match="unknown enrich:dataset"):
        enrich.enrich(frame, rules, "dataset")
    with pytest.raises(ValueError):
        find("preprocess", "nothing")


# PDF


def test_stitched_tables(spark):
    head = ["No.", "Full\nName", None, "Town"]
    rows = [
        ("f", 1, 1, 1, head), ("f", 1, 1, 2, ["1", " Ann\nLee ", "lost", "X"]), ("f", 1, 1, 3, ["", None, "lost", " "]), ("f", 1, 1, 4, ["2", "Bob"]),
        ("f", 2, 1, 1, head), ("f", 2, 1, 2, ["3", "Cy", "", "Y"]), ("f", 3, 1, 1, ["4", "Town", "", "Z"]), ("g", 1, 1, 1, ["Only"]), ("g", 2, 1, 1, ["Only"]), ("g", 2, 1, 2, ["v"]),
    ]
    found = pdf.stitch(spark.createDataFrame(rows, pdf.CELLS)).orderBy("file", "page", "tbl", "line").collect()
    assert [(r.file, r.record) for r in found] == [
        ("f", {"No": "1", "Full Name": "Ann Lee", "Town": "X"}), ("f", {"No": "2", "Full Name": "Bob", "Town": None}), ("f", {"No": "3", "Full Name": "Cy", "Town": "Y"}),
        ("f", {"No": "4", "Full Name": "Town", "Town": "Z"}), ("g", {"Only": "Only"}), ("g", {"Only": "v"}),
    ]


def test_page_texts(spark):
    pages = spark.createDataFrame([("f", 2, " two "), ("f", 1, "one"), ("f", 3, " "), ("f", 4, None)], "file string, page int, text string")
    assert pdf.page_text(pages).first().text == "\n--- PAGE 1 ---\none\n\n--- PAGE 2 ---\ntwo"


# JSON lines, exploration


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n  \nbroken\n{"b": "ü"}\n')
    rows = jsonl.read(spark, str(tmp_path / "a.jsonl")).collect()
    assert len(rows) == 3 and sum(r.v is None for r in rows) == 1
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jsonl.read(spark, str(tmp_path / "a.jsonl"), strict=True).collect()
    jsonl.write(spark.createDataFrame([('{"b":"ü"}',)], "record string"), str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == '{"b":"ü"}'
    assert spark.createDataFrame([(1, None)], "a int, b string").select(jsonl.line("*")).first()[0] == '{"a":1,"b":null}'


LINES = [
    '{"a": 1, "b": [{"c": "x"}, {"c": null}, []], "d e.f": true}', '{"a": 1.0, "b": [], "n": 12345678901234567890123}', " ", "broken", '{"a": "s", "b": [[1]], "o": {"k": [1]}}', None,
]


def test_schema_profile(spark):
    rows = {r.field: (r.type, r.optional, r.occurrences) for r in explore.schema_profile(spark.createDataFrame([(x,) for x in LINES], "value string")).collect()}
    assert rows == {
        "a": ("float | integer | string", False, 3), "b": ("array", False, 3), "b[]": ("array", False, 3), "b[].c": ("null | string", True, 2), "b[][]": ("array", True, 2),
        "d e.f": ("boolean", True, 1), "n": ("integer", True, 1), "o": ("object", True, 1), "o.k": ("array", True, 1), "o.k[]": ("array", True, 1),
    }


def test_malformed_lines_have_numbers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join("{bad\n" if i in (3, 4000) else "\n" if i == 5 else f'{{"a": {i}}}\n' for i in range(1, 5001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        found = analyst.profile_errors(spark, str(tmp_path / "a.jsonl")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.line for r in found) == [3, 4000] and {r.record for r in found} == {"{bad"} and all("property name" in r.error for r in found)


def test_values_below_lists_of_any_depth(spark):
    lines = ['{"a": [[[[[[{"k": 1}], []]]], {"k": [[2]]}]]}', '{"a": [[[[[{"k": {"x": 1}}, [[{"k": "deep"}]]]]]]]}']
    frame = spark.createDataFrame([(x,) for x in lines], "j string").select(F.parse_json("j").alias("v"))
    assert [r.value for r in explore.distinct_values(frame, "a.k").collect()] == ["1", "deep"]


def test_a_local_model_server():
    asked = []

    class Answer(io.BytesIO):
        def __init__(self, request, timeout):
            asked.append((request.full_url, json.loads(request.data), timeout))
            super().__init__(b'{"message": {"content": "{}"}}')

    client = extract.LocalServer("small", "http://localhost:1/api/chat", 5, lambda request, timeout: Answer(request, timeout))
    assert client.generate("p", {"name": ""}) == "{}" and client.generate("p", "") == "{}"
    assert asked[0][1]["format"] == {"name": ""} and asked[1][1]["format"] == "json" and asked[0][1]["options"] == {"temperature": 0}


def test_distinct_values(spark, tmp_path):
    lines = ['{"a": [{"b": " x "}, [{"b": true}], {"b": [1]}, {"b": null}]}', '{"a": {"b": 1.5}}', '{"a": {"b": ""}}', '{"c": 1}', '{"a": {"b": "x"}}']
    frame = spark.createDataFrame([(x,) for x in lines], "j string").select(F.parse_json("j").alias("v"))
    values = explore.distinct_values(frame, "a.b")
    assert [r.value for r in values.collect()] == ["", "1.5", "True", "x"]
    assert [r.value for r in explore.distinct_values(frame, "a.b", blanks=False).collect()] == ["1.5", "True", "x"]
    explore.write_values(values, str(tmp_path / "v"))
    assert [r.value for r in spark.read.text(str(tmp_path / "v")).collect()] == ["", "1.5", "True", "x"]


def test_analyst(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n,NA\n")
    (tmp_path / "a.xlsx").write_bytes(xlsx(VESSELS))
    (tmp_path / "a.xml").write_text(XML + "</list>", encoding="utf-8")
    (tmp_path / "a.jsonl").write_text('{"a": "p"}\n{"a": ""}\n{"a": 2}\nbroken\n')
    path = lambda suffix: f"{tmp_path}/a.{suffix}"
    assert analyst.show(analyst.parse_file(spark, path("csv"))) == ['{"x":"1","y":"2"}', '{"x":"","y":""}']
    assert [len(analyst.show(analyst.parse_file(spark, path(s)), 2)) for s in ("xlsx", "xml", "jsonl")] == [2, 2, 2]
    with pytest.raises(ValueError, match="suffix"):
        analyst.parse_file(spark, path("doc"))
    found, broken = analyst.values(spark, path("jsonl"), "a")
    assert [r.value for r in found.collect()] == ["2", "p"] and [r.record for r in broken.collect()] == ["broken"]
    explore.write_profile(analyst.profile(spark, path("jsonl")), str(tmp_path / "p"))
    assert json.loads(spark.read.text(str(tmp_path / "p")).first().value) == {"field": "a", "type": "integer | string", "optional": False, "occurrences": 3}


# staging

LOOKUPS = {
    "sources": ([(7, "Here"), (8, "There")], "id long, authority string"),
    "list_types": ([(3, 7), (2, 7), (9, 8)], "id long, source_id long"),
    "entity_types": ([(1, "INDIVIDUAL"), (2, "ORGANIZATION"), (3, "VESSEL")], "id long, name string"),
}


@pytest.fixture
def lookups(spark):
    return {k: spark.createDataFrame(*v) for k, v in LOOKUPS.items()}


def test_manifest(spark, lookups, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x\n1\n")
    row = staging.manifest(spark, str(tmp_path / "a.csv"), "Here", lookups["sources"], lookups["list_types"]).first()
    assert (row.source_id, row.list_type_id, row.file_size, row.file_type) == (7, 2, 4, "csv")
    assert row.file_hash == hashlib.sha256(b"x\n1\n").hexdigest()
    with pytest.raises(Exception, match="no match for Nowhere"):
        staging.manifest(spark, str(tmp_path / "a.csv"), "Nowhere", lookups["sources"], lookups["list_types"]).collect()


def test_staged_rows_need_their_type(spark, lookups):
    frame = spark.createDataFrame([("1", '{"entity_type":"Vessel"}')], "external_id string, record string")
    assert staging.staged(frame, lookups["entity_types"]).first().entity_type_id == 3
    with pytest.raises(Exception, match="no match for Plane"):
        staging.staged(frame.withColumn("record", F.lit('{"entity_type":"Plane"}')), lookups["entity_types"]).collect()


def test_hashes_do_not_depend_on_the_order_of_keys(spark):
    frame = spark.createDataFrame([('{"a":1,"b":[2,{"d":1,"c":2}]}',), ('{ "b":[2,{"c":2,"d":1}],"a":1}',), ('{"a":1,"b":[{"c":2,"d":1},2]}',)], "j string")
    a, b, c = (r[0] for r in frame.select(staging.record_hash(F.col("j"))).collect())
    assert a == b != c


def test_jdbc_options_have_no_default_secrets():
    with pytest.raises(ValueError, match="DB_PASSWORD"):
        staging.jdbc_options({"DB_URL": "u", "DB_USER": "n"})
    assert staging.jdbc_options({"DB_URL": "u", "DB_USER": "n", "DB_PASSWORD": "p"})["numPartitions"] == "10"


# extraction


def test_extraction(spark):
    schema = {"Name": "", "Sources": []}
    frame = spark.createDataFrame([("text",), (None,)], "t string")
    assert [r[0] for r in frame.select(extract.extract(F.col("t"), extract.Stub, schema)).collect()] == [json.dumps(schema), None]
    assert extract.unfenced("```json\n{}\n```") == extract.unfenced(" {} ") == "{}"
    assert '"Name"' in extract.fill(extract.PROMPT, "BODY", schema) and "BODY" in extract.fill(extract.PROMPT, "BODY", schema)


# acquisition


def test_downloads(tmp_path):
    task = download.Task("L", "https://h/x/list.xml?q=1", str(tmp_path))
    now = datetime(2020, 1, 2, 3, 4, 5)
    assert download.target(task, now).name == "L_20200102_030405.xml"
    assert download.target(download.Task("", "https://h/", str(tmp_path)), now).name == hashlib.md5(b"https://h/").hexdigest() + "_20200102_030405"
    calls = []

    def opener(url, timeout):
        calls.append((url, timeout))
        if len(calls) < 3:
            raise OSError("down")
        return io.BytesIO(b"data" * 5000)

    assert download.download(task, opener, lambda: now).read_bytes() == b"data" * 5000 and len(calls) == 3
    calls.clear()
    with pytest.raises(OSError):
        download.download(download.Task("L", "u", str(tmp_path), attempts=2), opener, lambda: now)


# the pipeline


def _rule(target, kind, value, group=None, target_type=""):
    return mapping.Rule("Organization", target, target_type, group, kind, value)


RULES = pipeline.Rules(
    [
        _rule("entity_type", "path", "entity_type"),
        _rule("source_metadata.date_added", "path", "date_issued"),
        _rule("other", None, None, target_type="array"),
        _rule("raw_source", "raw", None),
        _rule("identifiers[].type", "constant * constant", '"ID" * "Resolution"', "i"),
        _rule("identifiers[].value", "path * path", "unique_id * atc_resolution_no", "i"),
        _rule("programs[].program", "path", "category", "p"),
        _rule("names[].name", "path", "name", "n"),
    ],
    prenorm.compile_rules([prenorm.Rule("g", "*", "category", "enum", "Cat=Category")], {"g": "entity_type"}, "g"),
    (postnorm.Rule(1, "DEDUPLICATE_ALL_ARRAYS"),),
)
GROUPS = Source(
    key="GROUPS", name="ATC-DESIGNATED-TERRORIST-GROUPS", file_type="html", authority="Here", external_id="unique_id",
    preprocess=({"handler": "generate_unique_id", "prefix": "ATC"},),
)


def test_list_pipeline(spark, lookups, tmp_path):
    (tmp_path / "g.html").write_text(LISTING)
    out = str(tmp_path / "out")
    assert pipeline.run(spark, str(tmp_path / "g.html"), GROUPS, RULES, lookups, out) == {"raw": 2, "staged": 2}
    final = [json.loads(r.value) for r in spark.read.text(f"{out}/{GROUPS.name}_final.jsonl").collect()]
    one = next(r for r in final if r["programs"])
    digest = hashlib.md5(b"invented group").hexdigest()[:10]
    assert one["identifiers"] == [{"type": "ID", "value": f"ATC-12-{digest}"}, {"type": "Resolution", "value": "Resolution No. 12 and Resolution No. 13"}]
    assert one["programs"] == [{"program": "Category"}] and one["raw_source"]["unique_id"] == f"ATC-12-{digest}" and one["other"] == []
    two = next(r for r in final if not r["programs"])
    assert [i["type"] for i in two["identifiers"]] == ["ID"]  # without a resolution its block has nothing but a constant
    staged = spark.read.parquet(f"{out}/staging").collect()
    assert {r.external_id[:8] for r in staged} == {"ATC-12-" + digest[0], "ATC-UNKN"} and all(r.entity_type_id == 2 and r.source_id == 7 for r in staged)
    assert "unique_id" not in spark.read.parquet(f"{out}/payload").first().raw_json


def test_readers_by_type(spark, tmp_path):
    (tmp_path / "v.xlsx").write_bytes(xlsx(VESSELS))
    vessels = Source("V", "V", "xlsx", enrich=({"handler": "fix_vessel_rows", "level": "dataset"},))
    assert pipeline.read(spark, str(tmp_path / "v.xlsx"), vessels).count() == 2
    (tmp_path / "x.xml").write_text(XML + "</list>", encoding="utf-8")
    assert pipeline.read(spark, str(tmp_path / "x.xml"), Source("X", "X", "xml")).count() == 3
    pages = lambda content: iter([(1, 1, 1, ["A", "B"]), (1, 1, 2, ["1", content.decode()])])
    (tmp_path / "p.pdf").write_bytes(b"body")
    found = pipeline.read(spark, str(tmp_path / "p.pdf"), Source("P", "P", "pdf"), pages).collect()
    assert [json.loads(r.record) for r in found] == [{"A": "1", "B": "body"}]
    for source, path in ((Source("Y", "Y", "doc"), "x"), (Source("C", "C", "csv"), "x.txt"), (Source("P", "P", "pdf"), "p.pdf")):
        with pytest.raises(ValueError):
            pipeline.read(spark, path, source)


def test_stages_from_file_to_file(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    (tmp_path / "in.csv").write_text("kind,name,born\nE,Acme (x),3 May 1990\nE,Acme (x),\n")
    (tmp_path / "pre.csv").write_text("source,entity_type,field,normalization_type,normalization_rule\nS,*,kind,enum,E=Organization\nS,Organization,name,before_parenthesis,\n")
    (tmp_path / "fields.csv").write_text("source,entity_field\nS,kind\n")
    (tmp_path / "map.xlsx").write_bytes(xlsx([
        ["Entity Type", "Final Json Path", "Final Json Path Type", "Group", "S TYPE", "S"],
        ["Organization", "names[].n", None, "n", "path", "name"],
        ["Organization", "born[].date_full", None, "b", "path", "born"],
        ["Organization", "type", None, None, "constant", "org"],
    ]))
    (tmp_path / "post.jsonl").write_text('{"priority": 1, "rule_type": "DATE_NORMALIZATION", "condition_path": "born"}\n')
    assert files.ingest_table(spark, at("in.csv"), at("raw")) == 2
    # the mapper chooses rules by its own type fields
    files.pre_normalize_file(spark, "S", at("raw"), at("pre"), at("pre.csv"), at("fields.csv"))
    typed = spark.read.text(at("pre")).select(F.replace("value", F.lit('"kind"'), F.lit('"entity_type"')).alias("record"))
    jsonl.write(typed, at("typed"))
    files.map_file(spark, at("typed"), at("map.xlsx"), at("mapped"), "S")
    files.post_normalize_file(spark, at("mapped"), at("post.jsonl"), at("final"))
    rows = sorted((json.loads(r.value) for r in spark.read.text(at("final")).collect()), key=lambda r: len(r["born"]))
    assert [r["names"] for r in rows] == [[{"n": "Acme"}]] * 2 and all(r["type"] == "org" for r in rows)
    assert rows[0]["born"] == [] and rows[1]["born"] == [{"date_full": "3 May 1990", "year": "1990", "month": "05", "day": "03"}]
    (tmp_path / "a.xml").write_text(XML + "</list>", encoding="utf-8")
    assert files.ingest_xml(spark, at("a.xml")) == 3 and (tmp_path / "a_raw.jsonl").exists()
    for call in (lambda: files.ingest_table(spark, at("a.xml")), lambda: files.rule_table(spark, at("a.xml"))):
        with pytest.raises(ValueError, match="suffix"):
            call()


def test_preprocessing_steps(spark):
    record = {"u": "https://h/a%20b", "n": "Ann Lee", "p": {"born": "3 May 1980, Town"}, "profile_data": {"profile_fields": {"Alias/es": "N/A", "Name": "x"}}, "keep": [1]}
    steps = [
        {"handler": "extract_name_from_url", "input_field": "u", "output_field": "slug"},
        {"handler": "detect_entity_type", "input_field": "n", "output_field": "entity_type"},
        {"handler": "split_date_and_place", "input_field": "p.born", "date_field": "d", "place_field": "pl"},
        {"handler": "clean_profile_names", "fields": ["Alias/es"]},
    ]
    made = json.loads(pipeline.preprocess(spark.createDataFrame([(json.dumps(record),)], "record string"), steps).first().record)
    assert (made["slug"], made["entity_type"], made["d"], made["pl"], made["keep"]) == ("a b", "Individual", "3 May 1980", "Town", [1])
    assert json.loads(made["profile_fields"]) == {"Name": "x", "Alias/es": ""}


def test_scheduled_ingestion_takes_a_content_once(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    (folder / "a.xml").write_text("one")
    (folder / "b.xml").write_text("one")
    assert landing.ingest(spark, str(folder), out, state) == 1
    (folder / "c.xml").write_text("two")
    (folder / "d.xml").write_text("one")
    assert landing.ingest(spark, str(folder), out, state) == 2
    assert landing.ingest(spark, str(folder), out, state) == 2
