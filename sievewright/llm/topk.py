"""Exact top-k search by distributed histogram selection.

Queries and candidates are packed into blocks of a bounded number of vectors each, and every block of queries meets every block of candidates. A task takes one block of queries after another through its
blocks of candidates, scores all, and only histograms leave it: of each query's current score range, split evenly into bins. Summed over all tasks they
tell which bin holds the k-th highest score; that bin is the next range. When it is one score wide a last pass keeps the candidates above the k-th score and, of those equal to it, each task's smallest
ids; the final order is by score, then id. A task may leave out bins below its own k-th score: the global one
is never lower, so the sums above stay exact.

The state of all queries is a table, and one round serves all of them: the rounds follow from the width of the score range alone (a few), and the driver learns only
how many queries are still open.

Defined results: a vector that is null or holds null or non-finite components takes no part, neither as a query nor as a
candidate; vectors of another length than the query's are no candidates; rows are told apart by their place in the table, so a repeated vec_id is a query for each of its rows that is one,
and only the query's own row is no candidate; fewer candidates than k are all returned; an empty table gives no rows; extra
columns are ignored. Components are exact while |floor(scale * x)|^2 * dimensions stays below 2^62.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace

#: Bytes of a packed block of vectors, and vectors in it at most.
_BLOCK_BYTES, _BLOCK = 1 << 18, 2048
_CHUNK = "c_width int, c_uid binary, c_data binary, c_low binary, c_span binary, c_step binary, c_lacks binary"
_PACKED = "b_width int, b_uid binary, b_id binary, b_data binary"


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, v (array of long) of the rows that take part."""
    x = F.col("embedding")
    sound = x.isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    return vectors.where(sound & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")
    )


def scores(candidates: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point where that is exact, else by integers."""
    most = float(np.abs(candidates).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**24:
        return (candidates.astype(np.float32) @ queries.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (candidates.astype(np.float64) @ queries.astype(np.float64).T).astype(np.int64)
    return candidates.astype(np.int64) @ queries.astype(np.int64).T


def _small(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as hold them; the first byte says how many."""
    most = int(np.abs(values).max(initial=0))
    size = 2 if most < 2**15 else 4 if most < 2**31 else 8
    return bytes([size]) + values.astype(f"<i{size}").tobytes()


def _large(data: bytes, width: int) -> np.ndarray:
    flat = np.frombuffer(data, f"<i{data[0]}", offset=1)
    return flat.reshape(-1, width) if width else flat.reshape(0, 0)


def _long(values) -> bytes:
    return np.asarray(values, "<i8").tobytes()


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of candidates (uid, vec_id, v)."""
    for batch in batches:
        for width, own in batch.groupby(batch["v"].map(len)):
            most = max(1, min(_BLOCK, _BLOCK_BYTES // max(2, 2 * int(width))))
            for at in range(0, len(own), most):
                part = own.iloc[at : at + most]
                data = _small(np.stack(part["v"].to_numpy())) if width else _small(np.zeros(0, np.int64))
                yield pd.DataFrame([(int(width), _long(part["uid"]), _long(part["vec_id"]), data)], columns=["b_width", "b_uid", "b_id", "b_data"])


def _chunk(own: pd.DataFrame) -> pd.DataFrame:
    """One block of queries with their ranges; all of one width."""
    width = int(own["width"].iloc[0])
    data = _small(np.stack(own["v"].to_numpy())) if width else _small(np.zeros(0, np.int64))
    row = (width, _long(own["uid"]), data, *(_long(own[c]) for c in ("low", "span", "step", "lacks")))
    return pd.DataFrame([row], columns=["c_width", "c_uid", "c_data", "c_low", "c_span", "c_step", "c_lacks"])


class _Queries:
    """A block of queries, unpacked."""

    def __init__(self, row):
        self.key, self.width = row.c_uid, row.c_width
        self.uid, self.vectors = _longs(row.c_uid), _large(row.c_data, row.c_width)
        self.low, self.span, self.step, self.lacks = (_longs(x) for x in (row.c_low, row.c_span, row.c_step, row.c_lacks))
        if not self.width:
            self.vectors = np.zeros((len(self.uid), 0), np.int64)


def _pairs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[_Queries, pd.Series]]:
    """The queries, unpacked once for each run of equal ones, and a block of candidates of their width."""
    last = None
    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.c_width != row.b_width:
                continue
            if last is None or last.key != row.c_uid:
                last = _Queries(row)
            yield last, row


def _scored(q: _Queries, row) -> tuple[np.ndarray, np.ndarray]:
    """Scores (candidates x queries), and which of them count: all but those of a query's own row."""
    uid = _longs(row.b_uid)
    vectors = _large(row.b_data, row.b_width) if row.b_width else np.zeros((len(uid), 0), np.int64)
    return scores(vectors, q.vectors), uid[:, None] != q.uid[None, :]


def _histograms(bins: int, k: int):
    """A task's counts of scores by query and bin: of the span scores from low on, step to a bin."""

    def frame(q: _Queries, counts: np.ndarray) -> pd.DataFrame:
        # from the top: bins that begin below this task's own k-th score are not needed
        upper = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        at, b = np.nonzero((counts > 0) & (upper < k))
        return pd.DataFrame({"uid": q.uid[at], "bin": b.astype(np.int32), "n": counts[at, b]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, counts = None, None
        for q, row in _pairs(batches):
            if q is not last:
                if last is not None:
                    yield frame(last, counts)
                last, counts = q, np.zeros((len(q.uid), bins), np.int64)
            found, counted = _scored(q, row)
            past = found - q.low[None, :]
            inside = counted & (past >= 0) & (past < q.span[None, :])
            flat = (past // q.step[None, :] + np.arange(len(q.uid))[None, :] * bins)[inside]
            counts += np.bincount(flat, minlength=counts.size).reshape(counts.shape)
        if last is not None:
            yield frame(last, counts)

    return run


def _keepers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's candidates above the k-th score (low), and the smallest ids, as many as the query lacks, at it."""
    last, equal = None, {}

    def ties() -> pd.DataFrame:
        rows = [(int(last.uid[c]), v, int(last.low[c])) for c, own in equal.items() for v in own]
        return pd.DataFrame(rows, columns=["uid", "vec_id", "score"]).astype("int64")

    for q, row in _pairs(batches):
        if q is not last:
            if last is not None:
                yield ties()
            last, equal = q, {}
        found, counted = _scored(q, row)
        ids = _longs(row.b_id)
        at, col = np.nonzero(counted & (found > q.low[None, :]))
        yield pd.DataFrame({"uid": q.uid[col], "vec_id": ids[at], "score": found[at, col]})
        at, col = np.nonzero(counted & (found == q.low[None, :]))
        order = np.lexsort((ids[at], col))
        at, col = at[order], col[order]
        for c, first, n in zip(*np.unique(col, return_index=True, return_counts=True), strict=True):
            least = ids[at[first : first + n]][: q.lacks[c]].tolist()
            equal[c] = sorted([*equal.get(c, ()), *least])[: q.lacks[c]]
    if last is not None:
        yield ties()


def top_k(spark: SparkSession, vectors: DataFrame, is_query, k: int = 5, scale: int = 256, bins: int = 256, chunk: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of highest integer inner product of every query.

    vectors: vec_id, embedding. is_query: the condition that makes a row a query. A task holds the histograms of about `chunk` queries at a time.
    """
    work = Workspace(spark, "topk")
    base = work.table(quantised(vectors, scale).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    blocks = work.table(base.select("uid", "vec_id", "v").mapInPandas(_pack, _PACKED), "blocks")
    # no score is larger than the dimensions times the largest components
    bound = F.col("width") * F.col("top") * F.col("top") + 1
    top = base.agg(F.coalesce(F.max(F.array_max(F.transform("v", lambda c: F.abs(c)))), F.lit(0)).alias("top"))
    asked = base.where(is_query).select("uid", "vec_id", "v", F.size("v").alias("width")).crossJoin(F.broadcast(top))  # one row
    # a query that has found its k-th score is done; one whose range runs out has fewer candidates than k and keeps them all
    state = asked.select("uid", "vec_id", "v", "width", (-bound).alias("low"), (2 * bound + 1).alias("span"), F.lit(k).cast("long").alias("lacks"))
    state = work.table(state.withColumn("step", F.ceil(F.col("span") / bins).cast("long")).withColumn("done", F.lit(False)), "state")

    def met(some: DataFrame, n: int) -> DataFrame:
        """Every block of the queries of some with every block of candidates."""
        parts = max(1, -(-n // chunk))
        packed = some.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts))).groupBy("width", "part").applyInPandas(_chunk, _CHUNK)
        return work.table(packed, "chunks").hint("shuffle_replicate_nl").crossJoin(blocks)

    while n := state.where("not done").count():
        sums = met(state.where("not done"), n).mapInPandas(_histograms(bins, k), "uid long, bin int, n long").groupBy("uid", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("uid").orderBy(F.desc("bin"))
        upto = sums.withColumn("upto", F.sum("n").over(down))
        need = state.where("not done").select("uid", "lacks")
        # the bin that holds the k-th score: one row a query at most
        found = upto.join(need, "uid").where("upto >= lacks and upto - n < lacks").select("uid", "bin", (F.col("upto") - F.col("n")).alias("above"))
        begin = F.col("bin") * F.col("step")
        # the last bin may be partial: what lies past the old range's end is in lacks already
        span = F.least(F.col("step"), F.col("span") - begin)
        moved = state.join(found, "uid", "left").select(
            "uid", "vec_id", "v", "width",
            # without such a bin: below every score
            F.when(F.col("done"), F.col("low")).when(F.col("bin").isNull(), F.col("low") - 1).otherwise(F.col("low") + begin).alias("low"),
            F.when(F.col("done") | F.col("bin").isNull(), F.col("span")).otherwise(span).alias("span"),
            F.when(F.col("done") | F.col("bin").isNull(), F.col("lacks")).otherwise(F.col("lacks") - F.col("above")).alias("lacks"),
            F.when(F.col("done") | F.col("bin").isNull(), F.col("step")).otherwise(F.ceil(F.col("step") / bins)).cast("long").alias("step"),
            (F.col("done") | F.col("bin").isNull() | (F.col("step") == 1)).alias("done"),
        )
        state = work.table(moved, "state")
    kept = met(state, state.count()).mapInPandas(_keepers, "uid long, vec_id long, score long")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    best = work.table(kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "found")
    return best.join(state.select("uid", F.col("vec_id").alias("query_id")), "uid").select("query_id", "rank", "vec_id", "score")
