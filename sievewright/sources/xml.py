"""XML sources: one record per row element, all leaves text.

Elements become JSON as follows: attributes are keys; a leaf without attributes is its trimmed text; one with attributes keeps its text under
`text` if it has any; children stand under their local names, and what repeats, attributes included, becomes a list. The row tag
is compared with local names exactly.
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def to_json(element) -> dict | str:
    out: dict = dict(element.attrib)
    text = (element.text or "").strip()
    if not len(element):
        if not out:
            return text
        return {**out, "text": text} if text else out
    repeated = set()
    for sub in element:
        if not isinstance(sub.tag, str):
            continue
        name, value = local(sub.tag), to_json(sub)
        if name not in out:
            out[name] = value
        elif name in repeated:
            out[name].append(value)
        else:
            out[name] = [out[name], value]
            repeated.add(name)
    return out


_START = re.compile(rb"""<[^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*>""")


class _Joined(io.RawIOBase):
    """A prefix and then the content from a place on, as one file; the content is not copied whole."""

    def __init__(self, prefix: bytes, content: bytes, at: int):
        self.parts = [io.BytesIO(prefix), io.BytesIO(content)]
        self.parts[1].seek(at)

    def read(self, size: int = -1) -> bytes:
        return self.parts[0].read(size) or self.parts[1].read(size)


def _broken(source: _Joined, row_tag: str) -> tuple[int, int | None, list[int], int | None]:
    """Where a document breaks, where its outermost open row starts (None: in no row), where that row's ancestors start, and where the root starts."""
    parser, starts, rows, root = expat.ParserCreate(namespace_separator="}"), [], [], []

    def start(tag, attributes):
        at = parser.CurrentByteIndex
        if not root:
            root.append(at)
        if local(tag) == row_tag:
            rows.append(len(starts))
        starts.append(at)

    def end(tag):
        starts.pop()
        if rows and rows[-1] == len(starts):
            rows.pop()

    parser.StartElementHandler, parser.EndElementHandler = start, end
    try:
        parser.ParseFile(source)
    except expat.ExpatError:
        pass
    depth = rows[0] if rows else len(starts)
    return parser.ErrorByteIndex, starts[depth] if rows else None, starts[:depth], root[0] if root else None


def records(content: bytes, row_tag: str) -> Iterator[dict]:
    """Row elements of a document; read elements are freed. After an error, reading goes on at the next row tag after the start of the row that is
    broken (in no row: after the error), within the elements that were open there: only broken rows are lost."""
    prefix, at, top, root_tag = b"", 0, None, b"<_>"
    row = re.compile(rb"<(?:[\w.-]+:)?" + re.escape(row_tag.encode()) + rb"(?=[\s/>])")
    while True:
        try:
            yield from _rows(_Joined(prefix, content, at), row_tag)
            return
        except ElementTree.ParseError:
            error, open_row, above, root = _broken(_Joined(prefix, content, at), row_tag)
        whole = prefix + content[at : at + max(0, error - len(prefix))]
        tags = [m.group() for i in above if (m := _START.match(whole, i))]
        if top is None:
            top = whole[:root] if root is not None else b""
            if root is not None and (m := _START.match(whole, root)) and not row.match(m.group()) and not m.group().endswith(b"/>"):
                root_tag = m.group()
        place = open_row if open_row is not None else error
        found = row.search(content, max(at, at + place - len(prefix)) + 1)
        if found is None:
            return
        prefix, at = top + b"".join(tags or [root_tag]), found.start()


def _rows(source, row_tag: str) -> Iterator[dict]:
    stack = []
    for event, element in ElementTree.iterparse(source, events=("start", "end")):
        if event == "start":
            stack.append(element)
            continue
        stack.pop()
        if local(element.tag) == row_tag and not any(local(e.tag) == row_tag for e in stack):
            made = to_json(element)
            yield made if isinstance(made, dict) else {"text": made}
            element.clear()
            if stack:
                stack[-1].remove(element)


def records_of(documents: DataFrame, row_tag: str = "Designation") -> DataFrame:
    """record (JSON text) of every row element of documents (content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                part = []
                for r in records(bytes(content), row_tag):
                    part.append(json.dumps(r, ensure_ascii=False))
                    if len(part) == 1000:
                        yield pd.DataFrame({"record": part})
                        part = []
                yield pd.DataFrame({"record": pd.Series(part, dtype="str")})

    return documents.select("content").mapInPandas(run, "record string")


def read(spark: SparkSession, path: str, row_tag: str = "Designation") -> DataFrame:
    """record (JSON text) of every row element; files are read in parallel, each by one task."""
    return records_of(spark.read.format("binaryFile").load(path), row_tag)


def read_typed(spark: SparkSession, path: str, schema, row_tag: str = "Designation") -> DataFrame:
    """The same rows by Spark's own reader, where their schema is known: all leaves are read as text, and large files are not held by one task's Python."""
    options = {"rowTag": row_tag, "attributePrefix": "", "valueTag": "text", "ignoreNamespace": "true", "inferSchema": "false"}
    return spark.read.format("xml").options(**options).schema(schema).load(path)
