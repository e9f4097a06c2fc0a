"""Benchmark decontamination by greedy string tiling.

Texts become words: lower-cased runs of letters and digits of any script, so that punctuation, plain or typographic, parts words and counts for nothing. A running Karp-Rabin hash over
every `least` consecutive words of a document is looked up among those of the benchmark items; shared ones are seeds. Where an item and a document
agree, the longest match whose words are not marked yet is marked, again and again, until none has `least` words; of equally long ones the first in the
item goes first, then the first in the document. The marked share of the item's words is its coverage: passages are found in any order. A document is contaminated if
an item's coverage reaches the threshold. An item of fewer than `least` words is found where it stands whole.

Repeated words make a seed of almost every pair of places, so places are never paired one by one: a match begins only where the words before differ, its length comes from
hashes of whole prefixes by bisection, and what is left of a match is cut at the ends of marked intervals. Before any tiling, an item is refused if the places of
its words under all its seeds in the document stay below the threshold, which no tiling can exceed; equal items are tiled once. So a seed that all items share costs one count each.

The benchmark goes to the executors in blocks of about `block_words` words, `at_once` of them at a time: one stage holds these, and beyond them the rows are written and read
again for the next ones, so an executor's memory does not grow with the benchmark. Nothing of the documents moves.

Defined results: null, empty and wordless documents have coverage 0; items that are null or without words match nothing; coverage, item_id and tiles are those of the item of
the highest coverage at the threshold (of equal ones the smallest item_id), 0 and null where there is none; repeated rows and items count each; columns of docs with the
names of the results are replaced; an empty table gives no rows, an empty benchmark coverage 0 everywhere; texts are used whole.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"[^\W_]+")
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Seeds of a block that share their first bits are told apart only after this many bits.
_SIEVE = 22
#: So many word hashes are kept for the next texts.
_KNOWN = 300_000
#: Pairs of places that are looked at in one step.
_PAIRS = 1 << 20
RESULTS = ("coverage", "item_id", "tiles", "items")


class Numbers:
    """64-bit hashes of a text's words, runs of letters and digits, lower-cased; known ones are kept.

    Words are first parted at ASCII characters alone. A text all of whose parts are runs is done; another one, with typographic marks, say, is parted anew.
    """

    def __init__(self):
        self.known: dict[bytes, int | None] = {}

    def __call__(self, text) -> np.ndarray:
        if not isinstance(text, str):
            return np.empty(0, np.uint64)
        low = text if text.isascii() else text.lower()
        if (out := self._of(low.encode().translate(_PLAIN).split())) is None:
            out = self._of([w.encode() for w in _WORD.findall(low)])
        return out

    def _of(self, own: list[bytes]) -> np.ndarray | None:
        """None if some part is no run."""
        known = self.known
        if len(known) > _KNOWN:
            known.clear()
        for w in set(own).difference(known):
            known[w] = xxhash.xxh64_intdigest(w) if w.isascii() or _WORD.fullmatch(w.decode()) else None
        found = list(map(known.__getitem__, own))
        return None if None in found else np.array(found, np.uint64)


def running(ids: np.ndarray, least: int) -> np.ndarray:
    """Karp-Rabin hashes of every `least` consecutive numbers, modulo 2^64."""
    n = len(ids) - least + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(least if n > 0 else 0):
        out = out * _BASE + ids[k : k + n]
    return out


def _prefixes(ids: np.ndarray) -> list[np.ndarray]:
    """Hashes of the 1, 2, 4, ... numbers from each place on, as far as they reach."""
    level, out, power = ids, [ids], int(_BASE)
    while len(level) > (1 << (len(out) - 1)):
        step = 1 << (len(out) - 1)
        level = level[:-step] * np.uint64(power) + level[step:]
        out.append(level)
        power = power * power % (1 << 64)
    return out


def matches(item: np.ndarray, doc: np.ndarray, of_item: np.ndarray, of_doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts in item and document, and lengths, of all matches of `least` words or more that cannot be longer at either end.

    of_item, of_doc: their running hashes. Pairs of equal seeds are taken where the words before differ, in steps of about `_PAIRS` pairs.
    """
    before = [np.concatenate([[edge], ids[: max(0, len(h) - 1)]]).astype(np.uint64)[: len(h)] for ids, h, edge in ((item, of_item, 1), (doc, of_doc, 2))]
    keys, at_doc = np.unique(of_doc, return_inverse=True)
    place = np.searchsorted(keys, of_item)
    place[place == len(keys)] = 0
    held = np.nonzero(keys[place] == of_item)[0]
    order = np.argsort(at_doc, kind="stable")
    first = np.searchsorted(at_doc[order], np.arange(len(keys) + 1))
    # of one seed and word before, all places in the document: those are skipped for an item's place with the same word before
    found_p, found_q = [], []
    doc_before = before[1][order]
    todo: list[tuple[int, int, int]] = []

    def flush():
        if not todo:
            return
        p = np.concatenate([np.full(b - a, p) for p, a, b in todo])
        at = np.concatenate([np.arange(a, b) for _, a, b in todo])
        q = order[at]
        new = (doc_before[at] != before[0][p]) | (p == 0) | (q == 0)
        found_p.append(p[new])
        found_q.append(q[new])
        todo.clear()

    size, uniform = 0, {}
    for p in held.tolist():
        k = int(place[p])
        a, b = int(first[k]), int(first[k + 1])
        if b - a > 64 and p > 0:
            # long runs of one word: only the places with another word before, found once for each seed and word
            word = before[0][p]
            if (k, word) not in uniform:
                uniform[k, word] = a + np.nonzero((doc_before[a:b] != word) | (order[a:b] == 0))[0]
            at = uniform[k, word]
            found_p.append(np.full(len(at), p))
            found_q.append(order[at])
            continue
        todo.append((p, a, b))
        size += b - a
        if size >= _PAIRS:
            flush()
            size = 0
    flush()
    p = np.concatenate(found_p) if found_p else np.empty(0, np.int64)
    q = np.concatenate(found_q) if found_q else np.empty(0, np.int64)
    # the common length from each start on, by steps of falling powers of two
    one, two = _prefixes(item), _prefixes(doc)
    length = np.zeros(len(p), np.int64)
    for k in range(min(len(one), len(two)) - 1, -1, -1):
        a, b = p + length, q + length
        fits = np.nonzero((a < len(one[k])) & (b < len(two[k])))[0]
        same = fits[one[k][a[fits]] == two[k][b[fits]]]
        length[same] += 1 << k
    keep = length >= least
    return p[keep], q[keep], length[keep]


class _Marked:
    """Marked intervals of a text, disjoint and sorted."""

    def __init__(self):
        self.spans: list[tuple[int, int]] = []

    def add(self, a: int, b: int) -> None:
        insort(self.spans, (a, b))

    def within(self, a: int, b: int) -> list[tuple[int, int]]:
        """What is marked of [a, b)."""
        k = bisect_left(self.spans, (a, a))
        if k and self.spans[k - 1][1] > a:
            k -= 1
        out = []
        while k < len(self.spans) and self.spans[k][0] < b:
            out.append((max(a, self.spans[k][0]), min(b, self.spans[k][1])))
            k += 1
        return out


def tile(found: tuple[np.ndarray, np.ndarray, np.ndarray], least: int, n_item: int) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in document, length) from the matches; the longest goes first, then the first in the item, then in the document."""
    runs = [(-n, p, q) for p, q, n in zip(*(x.tolist() for x in found), strict=True)]
    heapq.heapify(runs)
    of_item, of_doc, tiles, left = _Marked(), _Marked(), [], n_item
    while runs and left >= least:
        size, p, q = heapq.heappop(runs)
        taken = [(a - p, b - p) for a, b in of_item.within(p, p - size)] + [(a - q, b - q) for a, b in of_doc.within(q, q - size)]
        if not taken:
            tiles.append((p, q, -size))
            of_item.add(p, p - size)
            of_doc.add(q, q - size)
            left += size
            continue
        start = 0
        for a, b in sorted([*taken, (-size, -size)]):
            if a - start >= least:
                heapq.heappush(runs, (start - a, p + start, q + start))
            start = max(start, b)
    return tiles


class Block:
    """Some benchmark items: the hashes of their words, and where each running hash stands. Equal items are held once."""

    def __init__(self, items: list[tuple[int, str]], least: int, threshold: float):
        self.least, self.threshold = least, threshold
        ids: dict[bytes, list[int]] = {}
        number = Numbers()
        for item_id, text in sorted(items):
            if len(own := number(text)):
                ids.setdefault(own.tobytes(), []).append(item_id)
        self.items = [(own, np.frombuffer(key, np.uint64)) for key, own in ids.items()]
        self.sizes = np.array([len(t) for _, t in self.items], np.int64)
        #: seed length -> (sorted hashes, their items, their starts): an item shorter than `least` is one seed of its own length
        self.seeds = {}
        for width in sorted({min(least, int(n)) for n in self.sizes}):
            chosen = [k for k, n in enumerate(self.sizes) if min(least, n) == width]
            made = [running(self.items[k][1], width) for k in chosen]
            flat, owners = np.concatenate(made), np.repeat(chosen, [len(m) for m in made])
            starts = np.concatenate([np.arange(len(m)) for m in made])
            order = np.argsort(flat, kind="stable")
            sieve = np.zeros(1 << _SIEVE, bool)
            sieve[flat >> np.uint64(64 - _SIEVE)] = True
            self.seeds[width] = sieve, flat[order], owners[order], starts[order]

    def covered(self, ids: np.ndarray) -> list[tuple[float, list[int], int]]:
        """(coverage, item ids, tiles) of every distinct item whose coverage by the document's words reaches the threshold."""
        out = []
        for width, (sieve, hashes, owners, starts) in self.seeds.items():
            of_doc = running(ids, width)
            kinds = np.unique(of_doc[sieve[of_doc >> np.uint64(64 - _SIEVE)]])
            if not len(kinds):
                continue
            low = np.searchsorted(hashes, kinds)
            kinds, low = kinds[low < len(hashes)], low[low < len(hashes)]
            hit = hashes[low] == kinds
            if not hit.any():
                continue
            low, high = low[hit], np.searchsorted(hashes, kinds[hit], side="right")
            at = np.repeat(low - np.concatenate([[0], (high - low).cumsum()[:-1]]), high - low) + np.arange((high - low).sum())
            of, start = owners[at], starts[at]
            # words under a seed: no tiling covers more
            order = np.lexsort((start, of))
            of, start = of[order], start[order]
            same = np.concatenate([of[1:] == of[:-1], [False]])
            under = np.where(same, np.minimum(width, np.concatenate([start[1:], [0]]) - start), width)
            most = np.bincount(of, weights=under, minlength=len(self.items))
            for k in np.nonzero((most > 0) & (most >= self.threshold * self.sizes))[0].tolist():
                own, tokens = self.items[k]
                tiles = tile(matches(tokens, ids, running(tokens, width), of_doc, width), width, len(tokens))
                share = sum(t[2] for t in tiles) / len(tokens)
                if share >= self.threshold:
                    out.append((share, own, len(tiles)))
        return out


def blocks(benchmark: DataFrame, least: int, threshold: float, block_words: int) -> Iterator[Block]:
    """Benchmark items (item_id, text) in blocks of about `block_words` words by a hash of their id; an item is never cut."""
    items = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-size // (6 * block_words)))
    for part in range(parts):
        yield Block([tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect()], least, threshold)


def flag(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, least: int = 5, block_words: int = 2_000_000, at_once: int = 4) -> DataFrame:
    """All columns of docs (text), with the highest coverage of an item at the threshold, its item_id and tiles, and the number of such items."""
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

    base = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULTS))
    schema = StructType([*base.schema.fields]).add("coverage", DoubleType()).add("item_id", LongType()).add("tiles", IntegerType()).add("items", IntegerType())
    out = base.withColumns({"coverage": F.lit(0.0), "item_id": F.lit(None).cast("long"), "tiles": F.lit(0), "items": F.lit(0)})

    def stage(some: list[Block]):
        held = [docs.sparkSession.sparkContext.broadcast(b) for b in some]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = Numbers()
            for batch in batches:
                before = [batch.column(name).to_pylist() for name in RESULTS]
                made = []
                for text, coverage, item, tiles, items in zip(batch.column("text").to_pylist(), *before, strict=True):
                    ids = number(text)
                    for share, own, n in (x for b in held for x in b.value.covered(ids)):
                        items += len(own)
                        if (-share, own[0]) < (-coverage, own[0] if item is None else item):
                            coverage, item, tiles = share, own[0], n
                    made.append((coverage, item, tiles, items))
                columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.float64(), pa.int64(), pa.int32(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[: -len(RESULTS)], *columns], names=batch.schema.names)

        return run

    every, work, first = (b for b in blocks(benchmark, least, threshold, block_words) if b.items), None, True
    while some := list(islice(every, at_once)):
        if not first:
            work = work or Workspace(docs.sparkSession, "decontam")
            out = work.table(out, "rows")
        out, first = out.mapInArrow(stage(some), schema), False
    return out
