"""Vector bin packing of documents into shards: bytes, tokens and rows are balanced jointly.

Documents with equal texts are a group, and every group is placed by the dot product of its load (its shares of all bytes, tokens and rows) with the shards' residual capacity: it goes where that is
highest, among the shards whose bytes still fit, and else where most bytes are left. Larger groups go first. Groups that hold at least one part in `units` of a total, at
most `3 * units`, are placed by the driver. The others are dealt by hash into blocks of about `block_groups`; each block has its part of the capacity that the large groups left, in proportion to its load, and places
its own groups one by one, so that blocks are independent and their sums are as even as each of them. A group that takes more than a whole shard's part of a total can stand in
no single shard: it alone is cut, by a hash of its rows, into parts of one in `units`.

Tokens are those of a public tokenizer's vocabulary file.

Defined results: a null text has the size 1, no tokens, and forms one group with the empty text, which has the same size
and bytes; repeated rows are placed each; of equally large groups the smaller digest goes first, of equally good shards the smaller number is taken; an empty table gives
no rows; extra columns are ignored; texts are used whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace
from sievewright.llm.packing import encoder

LOADS = ("bytes", "tokens", "rows")


def place(shares: np.ndarray, free: np.ndarray) -> np.ndarray:
    """The shard of each unit, given its shares (units x dimensions); free (shards x dimensions) is what is left, and is changed."""
    chosen = np.empty(len(shares), int)
    # the first dimension has the law: what is left of it decides where the product would overfill a shard
    for unit in np.lexsort((np.arange(len(shares)), -shares.sum(axis=1), -shares[:, 0])):
        own = shares[unit]
        fit = free[:, 0] >= own[0]
        best = int(np.argmax(np.where(fit, free @ own, -np.inf))) if fit.any() else int(np.argmax(free[:, 0]))
        chosen[unit] = best
        free[best] -= own
    return chosen


def measured(docs: DataFrame, vocabulary: str, ranks: str | None = None) -> DataFrame:
    """doc_id, size, tokens, text_crc32, and the group of equal texts, of every document."""
    import pyarrow as pa

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("grp"),
        text.alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks)
        for batch in batches:
            tokens = pa.array([len(encode(t)) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], tokens], names=[*batch.schema.names[:-1], "tokens"])

    return rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, grp binary, tokens long")


def shard(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    shards: int = 8,
    units: int = 4096,
    block_groups: int = 16384,
    block_rows: int = 50_000,
) -> DataFrame:
    """doc_id, size, tokens, text_crc32, shard, slot of every document (doc_id, text); slots are gapless in each shard."""
    work = Workspace(spark, "sharding")
    rows = work.table(measured(docs, vocabulary, ranks).withColumn("uid", F.monotonically_increasing_id()), "rows")
    groups = work.table(
        rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "groups"
    )
    found = groups.agg(F.count("*").alias("groups"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in LOADS)).first()
    totals = np.array([max(1, found[c]) for c in LOADS], float)
    share = F.greatest(*(F.col(c) / F.lit(float(t)) for c, t in zip(LOADS, totals, strict=True)))
    # at most len(LOADS) * units rows; one that fits no shard is cut
    large = groups.where(share >= 1.0 / units).select("grp", *LOADS, F.when(share > 1.0 / shards, F.ceil(share * units)).otherwise(1).cast("int").alias("parts"))
    first = pd.DataFrame([(r["grp"], part, *(r[c] / r["parts"] for c in LOADS)) for r in sorted(large.collect()) for part in range(r["parts"])], columns=["grp", "part", *LOADS])
    free = np.full((shards, len(LOADS)), 1.0 / shards)
    at = place(first[[*LOADS]].to_numpy(float) / totals, free)
    placed = spark.createDataFrame([(bytes(g), int(p), int(s)) for g, p, s in zip(first["grp"], first["part"], at, strict=True)], "grp binary, part int, shard int")
    rest = free.sum(axis=0)

    def own(these: pd.DataFrame) -> pd.DataFrame:
        these = these.sort_values("grp", kind="stable")
        shares = these[[*LOADS]].to_numpy(float) / totals
        part = shares.sum(axis=0) / np.where(rest > 0, rest, 1.0)
        return these[["grp"]].assign(shard=place(shares, free * part[None, :]))

    blocks = max(1, -(-found["groups"] // block_groups))
    small = groups.where(share < 1.0 / units).withColumn("block", F.pmod(F.xxhash64("grp"), F.lit(blocks)))
    spread = small.groupBy("block").applyInPandas(own, "grp binary, shard int")
    # the large groups' rows stay where they are; no small group has many
    parts = large.select("grp", "parts")
    apart = rows.join(F.broadcast(parts), "grp", "left").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    names = ["doc_id", "size", "tokens", "text_crc32", "uid", "shard"]
    of_large = apart.where(F.col("parts").isNotNull()).join(F.broadcast(placed), ["grp", "part"]).select(names)
    of_small = apart.where(F.col("parts").isNull()).join(spread, "grp").select(names)
    # slots: blocks of a shard's rows by hash, numbered inside by a window, offset by the blocks before
    slots = max(1, math.ceil(found["rows"] / shards / block_rows), min(64, found["rows"] // 512))
    dealt = of_large.unionAll(of_small).withColumn("block", F.pmod(F.xxhash64(F.lit(1), F.col("uid")), F.lit(slots)))
    dealt = work.table(dealt, "dealt")
    work.drop("groups", "rows")
    counts = dealt.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "block").orderBy("uid")
    return (
        dealt.withColumn("nth", F.row_number().over(inside))
        .join(offsets, ["shard", "block"])
        .select("doc_id", "size", "tokens", "text_crc32", "shard", (F.col("base") + F.col("nth") - 1).cast("long").alias("slot"))
    )
