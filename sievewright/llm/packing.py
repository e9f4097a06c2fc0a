"""Bounded-space online best-fit packing of tokenised documents into fixed-length sequences.

A first pass tokenises every document and writes one small row per piece (no token ids travel further).
Pieces are then dealt by a hash of their row number into packing groups of about `group_pieces` pieces; each
group is packed by one online best-fit packer: pieces come in the order of their row numbers, each is placed before the next is seen, and at most `open_bins` bins
are open. A piece goes into the open bin with the least free space that holds it, else into a new one; where a bin too many would be open, the fullest closes. Groups are independent, so
the packing scales with their number and memory is bounded by one group.

Defined results: a null or empty text is the end token alone; repeated rows are packed once each; of open bins with equal space the last one filled is taken, and of equally full ones it
closes; an empty table gives no rows; extra columns are ignored; a text of any length is cut into pieces, never truncated.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace

CAPACITY = 2048
PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
#: Texts of these characters alone get the same ids from both libraries; others go to the reference one.
_COMMON = re.compile(r"[\t\n\r\x20-\x7e¡-¬®-ſ‐-‧]*")


class Bins:
    """Open bins in a bitset keyed by free space: bit f is set while some open bin has f tokens free."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.open, self.made, self.closed = 0, 0, 0, 0
        self.by_free: dict[int, list[int]] = {}

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        found = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def put(self, length: int) -> tuple[int, int]:
        """The bin and the offset that a piece gets: the open bin with the least sufficient free space, or a new one."""
        if fits := self.bits >> length:
            free = length + (fits & -fits).bit_length() - 1
            found = self._take(free)
        else:
            found, free = self.made, self.capacity
            self.made += 1
        if left := free - length:
            if self.open >= self.most:  # the fullest closes first, which may be this one
                self.closed += 1
                least = (self.bits & -self.bits).bit_length() - 1
                if left <= least:
                    return found, self.capacity - free
                self._take(least)
            self.by_free.setdefault(left, []).append(found)
            self.bits |= 1 << left
            self.open += 1
        return found, self.capacity - free


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after a first one that may be shorter."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))]


def encoder(vocabulary: str, ranks: str | None = None):
    """text -> ids of the tokenizers file `vocabulary`; `ranks`, the same vocabulary as ranks, serves plain texts faster."""
    import os

    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"

    @cache
    def exact():  # loaded when a text needs it
        from tokenizers import Tokenizer

        return Tokenizer.from_file(vocabulary)

    if not ranks:
        return lambda text: exact().encode(text, add_special_tokens=False).ids
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def encode(text: str) -> list[int]:
        if "<|" not in text and _COMMON.fullmatch(text):
            return quick.encode_ordinary(text)
        return exact().encode(text, add_special_tokens=False).ids

    return encode


def pieces(docs: DataFrame, vocabulary: str, ranks: str | None, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """One row per piece of every document, with a row number that is unique among them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encode, uid = encoder(vocabulary, ranks), TaskContext.get().partitionId() << 36
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"].array, strict=True):
                ids = np.array([*(encode(text) if isinstance(text, str) and text else ()), end], dtype="<u4")
                for n, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((uid, doc_id, n, start, length, zlib.crc32(ids[start : start + length].tobytes())))
                    uid += 1
            out = pd.DataFrame(rows, columns=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(run, PIECES)


def pack(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: str,
    ranks: str | None = None,
    capacity: int = CAPACITY,
    open_bins: int = 256,
    group_pieces: int = 32768,
) -> DataFrame:
    """Packs documents (doc_id, text) into sequences of at most `capacity` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.
    """
    work = Workspace(spark, "packing")
    cuts = work.table(pieces(docs, vocabulary, ranks, capacity), "pieces")
    groups = max(1, -(-cuts.count() // group_pieces))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("uid", kind="stable")
        bins, base = Bins(capacity, open_bins), int(part["grp"].iloc[0]) << 32
        placed = [bins.put(int(length)) for length in part["length"]]
        part["sequence_id"] = [base + b for b, _ in placed]
        part["offset"] = [o for _, o in placed]
        return part[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]].astype({"doc_id": "Int64"})

    return cuts.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups))).groupBy("grp").applyInPandas(run, PACKED)
