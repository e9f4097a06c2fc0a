"""HTML sources: listing tables and profile pages, parsed with the standard library in Arrow-batched UDFs."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.functions.text import clean_text
from sievewright.registry import find, register

#: Table ids of the listing pages, and the entity type of their rows (fixed values).
INDIVIDUALS, GROUPS = "tablepress-33", "tablepress-31"

_ROWS = "array<struct<cells:array<string>,classes:array<string>,links:array<string>>>"


class _Tables(HTMLParser):
    """Rows of one table (or of all, id None; `within`: only those inside such an element): texts, classes and first links of their cells."""

    def __init__(self, table_id: str | None, head: bool = False, within: str | None = None):
        super().__init__(convert_charrefs=True)
        self.wanted, self.head, self.within, self.inside, self.images = table_id, head, within, 0, []
        self.depth, self.in_head, self.rows, self.row, self.cell = 0, False, [], None, None

    def handle_starttag(self, tag, attrs):
        at = dict(attrs)
        if tag == self.within:
            self.inside += 1
        if self.within and not self.inside:
            return
        if tag == "img" and at.get("src"):
            self.images.append(at["src"])
        if tag == "table":
            if self.depth or self.wanted is None or at.get("id") == self.wanted:
                self.depth += 1
        elif not self.depth:
            return
        elif tag == "thead":
            self.in_head = True
        elif tag == "tr":
            self._close()
            self.row = {"cells": [], "classes": [], "links": []}
        elif tag in ("td", "th") and self.row is not None:
            self._end_cell()
            if tag == "td":
                self.cell = []
                self.row["classes"].append(at.get("class") or "")
                self.row["links"].append("")
        elif tag == "a" and self.cell is not None and not self.row["links"][-1]:
            self.row["links"][-1] = (at.get("href") or "").strip()
        elif tag == "br" and self.cell is not None:
            self.cell.append(" ")

    def _end_cell(self):
        if self.cell is not None:
            self.row["cells"].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def _close(self):
        if self.row is not None:
            self._end_cell()
            if self.row["cells"] and (self.head or not self.in_head):
                self.rows.append(self.row)
            self.row = None

    def handle_endtag(self, tag):
        if tag == self.within and self.inside:
            self.inside -= 1
        if not self.depth:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._close()
        elif tag == "thead":
            self._close()
            self.in_head = False
        elif tag == "table":
            self._close()
            self.depth -= 1

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_rows(html: str | None, table_id: str | None, head: bool = False) -> list[dict]:
    parser = _Tables(table_id, head)
    parser.feed(html or "")
    parser.close()
    return parser.rows


def rows_of(html: Column, table_id: str | None) -> Column:
    """The body rows of a table: array of {cells, classes, links}."""

    @F.pandas_udf(_ROWS)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: table_rows(t, table_id))

    return run(html)


def _of_column(row: Column, number: int) -> Column:
    """cell, link of all cells whose class contains the column's name."""
    zipped = F.arrays_zip(row["cells"].alias("cell"), row["classes"].alias("kind"), row["links"].alias("link"))
    return F.filter(zipped, lambda c: c["kind"].contains(f"column-{number}"))


def _by_class(row: Column, number: int) -> Column:
    """The texts of all cells whose class contains the column's name, joined; empty if none does."""
    return clean_text(F.array_join(F.transform(_of_column(row, number), lambda c: c["cell"]), " "))


def listing(pages: DataFrame, table_id: str, kind: str, links: bool) -> DataFrame:
    """entity_type, name, category, atc_resolution_no, date_issued (and detail_url) of a listing's rows with a name; pages: content."""
    rows = pages.select(F.explode(rows_of(F.col("content"), table_id)).alias("r"))
    r = F.col("r")
    fields = [F.lit(kind).alias("entity_type"), *(_by_class(r, n).alias(c) for n, c in enumerate(("name", "category", "atc_resolution_no", "date_issued"), 1))]
    first_link = F.get(F.filter(F.transform(_of_column(r, 1), lambda c: c["link"]), lambda x: x != ""), F.lit(0))
    fields += [F.coalesce(first_link, F.lit("")).alias("detail_url")] if links else []
    return rows.select(*fields).where("name <> ''")


@register("html", "ATC-DESIGNATED-TERRORIST-INDIVIDUALS")
def individuals(pages: DataFrame) -> DataFrame:
    return listing(pages, INDIVIDUALS, "Individual", True)


@register("html", "ATC-DESIGNATED-TERRORIST-GROUPS")
def groups(pages: DataFrame) -> DataFrame:
    return listing(pages, GROUPS, "Organization", False)


def read(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The records of an HTML source by its name; an unknown name is a ValueError."""
    parse = find("html", source)
    return parse(read_pages(spark, path))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """path, content (text) of files."""
    return spark.read.format("binaryFile").load(path).select("path", F.decode("content", "UTF-8").alias("content"))


def _profiles(texts: pd.Series) -> pd.DataFrame:
    fields, images = [], []
    for t in texts:
        parser = _Tables(None, True, "article")
        parser.feed(t or "")
        parser.close()
        cells = [r["cells"] for r in parser.rows]
        fields.append({own[0]: own[1] if len(own) > 1 else "" for own in cells if own[0]})
        images.append(parser.images)
    return pd.DataFrame({"fields": fields, "images": images})


def profile(html: Column) -> Column:
    """{fields: first and second cells of the rows of all tables, images: addresses in order} of a profile page; only what stands inside an article counts."""
    made = F.pandas_udf(_profiles, "struct<fields:map<string,string>,images:array<string>>")
    return made(html)
