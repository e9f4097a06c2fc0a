"""CSV and XLSX sources: a header row, all cells text, missing values empty."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that count as missing (fixed values).
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def present(x: Column) -> Column:
    """The cell as text; a missing one is empty."""
    text = x.cast("string")
    return F.when(text.isin(MISSING) | text.isNull(), "").otherwise(text)


def as_records(df: DataFrame) -> DataFrame:
    """All columns as text, nulls empty."""
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns))


def header_names(cells: list[str | None]) -> list[str]:
    """Blank headers become `Unnamed: n`, repeated ones get .1, .2 behind."""
    out, seen = [], {}
    for n, cell in enumerate(cells):
        name = f"Unnamed: {n}" if cell is None or cell == "" else cell
        times = seen[name] = seen.get(name, -1) + 1
        out.append(f"{name}.{times}" if times else name)
    return out


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Columns by the first line's names."""
    options = {"multiLine": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    plain = spark.read.options(**options).csv(path)
    first = plain.limit(1).collect()
    if not first:
        return spark.createDataFrame([], "value string").select()
    names = header_names(list(first[0]))
    body = spark.read.options(**options, header="true", enforceSchema="true").schema(", ".join(f"`c{n}` string" for n in range(len(names)))).csv(path)
    return body.select(*(present(F.col(f"c{n}")).alias(name) for n, name in enumerate(names)))


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def sheet_rows(content: bytes, sheet: int | str = 0) -> list[list[str | None]]:
    """The cells of a sheet of an .xlsx file, by index or name, as texts; gaps are None."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        sheets = list(ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"))
        chosen = sheets[sheet] if isinstance(sheet, int) else next((s for s in sheets if s.get("name") == sheet), None)
        if chosen is None:
            raise ValueError(f"no sheet {sheet!r}")
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = targets[chosen.get(f"{_REL}id")]
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")]
        root = ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    rows = []
    for row in root.iter(f"{_MAIN}row"):
        cells: dict[int, str] = {}
        for n, c in enumerate(row.iter(f"{_MAIN}c")):
            letters = re.match(r"[A-Z]*", c.get("r") or "")[0]
            at = 0
            for x in letters:
                at = at * 26 + ord(x) - 64
            at = at - 1 if letters else n
            value = c.find(f"{_MAIN}v")
            if c.get("t") == "s" and value is not None:
                cells[at] = shared[int(value.text)]
            elif c.get("t") == "inlineStr":
                cells[at] = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
            elif c.get("t") == "b" and value is not None:
                cells[at] = "True" if value.text == "1" else "False"
            elif value is not None and value.text is not None:
                cells[at] = value.text
        rows.append([cells.get(k) for k in range(max(cells, default=-1) + 1)])
    return rows


def _names(content: bytes, sheet: int | str) -> list[str] | None:
    """A sheet's header; null where there is no such sheet."""
    try:
        rows = sheet_rows(content, sheet)
    except (ValueError, IndexError):
        return None
    return header_names(rows[0]) if rows else []


def read_xlsx(spark: SparkSession, path: str, sheet: int | str = 0) -> DataFrame:
    """Columns by the first rows' names of all files, those of the first path first; a file that lacks one has it empty.

    Only .xlsx is read; workbooks are small, each is held by one task, and the driver gets their names.
    """
    files = spark.read.format("binaryFile").load(path)

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "names": [_names(bytes(c), sheet) for c in batch["content"]]})

    found = sorted(files.select("path", "content").mapInPandas(heads, "path string, names array<string>").collect())
    if not found:
        raise ValueError(f"no file: {path}")
    if lacking := [path for path, own in found if own is None]:
        raise ValueError(f"no sheet {sheet!r}: {lacking[0]}")
    names = list(dict.fromkeys(n for _, own in found for n in own))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                own = sheet_rows(bytes(content), sheet)
                head = header_names(own[0]) if own else []
                made = [json.dumps(dict(zip(head, r, strict=False)), ensure_ascii=False) for r in own[1:] if any(x is not None for x in r)]
                yield pd.DataFrame({"j": pd.Series(made, dtype="str")})

    cells = files.select("content").mapInPandas(run, "j string").select(F.from_json("j", "map<string,string>").alias("m"))
    return cells.select(*(present(F.try_element_at("m", F.lit(n))).alias(n) for n in names))
