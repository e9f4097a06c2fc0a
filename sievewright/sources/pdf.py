"""PDF sources: stitching of the tables that an extractor found on the pages. The extractor is injected; the rest stays in the JVM.

Input rows: file, page, tbl (table on the page), line (row of the table), cells. The header is the first row of a file's first table; a later table's first row
is left out if it looks like it (two of its cells, at least, are headers), and its rows are read under the same header.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.functions.text import cell, header, strip

CELLS = "file string, page int, tbl int, line int, cells array<string>"


def headers(cells: Column) -> Column:
    return F.transform(cells, header)


def is_same_header(cells: Column, head: Column) -> Column:
    """At least two cleaned, non-empty cells stand in the header; a cell counts as often as it stands."""
    known = F.filter(head, lambda h: h.isNotNull())
    return F.size(F.filter(headers(cells), lambda c: c.isNotNull() & F.array_contains(known, c))) >= 2


def stitch(rows: DataFrame) -> DataFrame:
    """file, page, tbl, line, record (map of header to cell) of all body rows that hold anything."""
    first = rows.groupBy("file").agg(F.min(F.struct("page", "tbl", "line", "cells")).alias("f"))
    first = first.select(F.col("file"), F.struct("f.page", "f.tbl", "f.line").alias("at"), headers(F.col("f.cells")).alias("head"))
    top = F.row_number().over(Window.partitionBy("file", "page", "tbl").orderBy("line")) == 1
    body = rows.withColumn("top", top).join(first, "file")
    body = body.where(F.struct("page", "tbl", "line") != F.col("at")).where(~(F.col("top") & is_same_header(F.col("cells"), F.col("head"))))
    pairs = F.filter(F.arrays_zip(F.col("head").alias("k"), F.transform("cells", cell).alias("v")), lambda p: p["k"].isNotNull())
    unique = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.create_map(p["k"], p["v"])))
    made = body.withColumn("record", unique)
    return made.where(F.exists(F.map_values("record"), lambda v: v.isNotNull() & (v != ""))).select("file", "page", "tbl", "line", "record")


def read(spark: SparkSession, path: str, extractor: Callable[[bytes], Iterator[tuple[int, int, int, list[str | None]]]]) -> DataFrame:
    """The records of PDF files; extractor: file bytes -> (page, table, row, cells)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows = [(file, *r) for r in extractor(bytes(content))]
                yield pd.DataFrame(rows, columns=["file", "page", "tbl", "line", "cells"])

    return stitch(spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, CELLS))


def page_text(pages: DataFrame) -> DataFrame:
    """file, text: the texts of a file's pages (file, page, text) in order, each after a line break and a marker's line, blank ones left out."""
    body = strip(F.coalesce("text", F.lit("")))
    marked = pages.where(body != "").select("file", F.struct("page", F.concat(F.lit("\n--- PAGE "), F.col("page"), F.lit(" ---\n"), body).alias("t")).alias("p"))
    return marked.groupBy("file").agg(F.array_sort(F.collect_list("p")).alias("ps")).select("file", F.array_join(F.transform("ps", lambda p: p["t"]), "\n").alias("text"))
