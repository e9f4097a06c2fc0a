"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is a grouped minimum and a join, written as a table; nothing is collected but whether another round is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace


def _open(edges: DataFrame) -> bool:
    """Whether some node has two smaller ones, or a smaller and a larger one: else all edges (u, v) lead to the smallest node of their component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up > 0 and down > 0").isEmpty()


def components(work: Workspace, edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of edges (a, b): comp is the smallest node that it reaches. An empty table gives none."""
    edges = work.table(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges-0"
    )
    turn = 0
    while _open(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # large-star leaves edges that point to smaller nodes only; small-star hangs each node's targets on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        turn += 1
        edges = work.table(hung.union(least.select("u", F.col("m").alias("v"))).distinct(), f"edges-{turn}")
        work.drop(f"edges-{turn - 1}")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )
