"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of byte strings up to `order` long, counted on its training texts, each counted alone, and then frozen: the statistics do not depend on
how the table lies in files and partitions. `train` takes a bounded sample of them, chosen by hash; `counted` and `grown` take all that they are given. A byte's code length in a language is -log2 of its probability in the longest known context that has seen
it, plus the escapes (method C, without exclusion) from the longer known contexts that have not; the last resort is uniform over 256 bytes. A text's code
length is the exact sum over its bytes; the language with the shortest wins, ties to the smaller name, and the score is its
share of 2^-length among all languages.

Texts are lower-cased, and runs of ASCII characters other than letters become one blank, for training and prediction alike.

Defined results: null, empty and letterless texts are `und` with score 0; so is everything where nothing could be learned; repeated rows get
equal results; texts are used whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import sample_by_hash

UNDETERMINED = "und"
_LETTERS_ONLY = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_CHUNK = 1 << 19


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def plain(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_LETTERS_ONLY).split())


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """The `length` bytes that end at each position, as one number; positions before that have wrapped ones."""
    codes = data.astype(np.uint64)
    for k in range(1, length):
        codes |= np.roll(data, k).astype(np.uint64) << np.uint64(8 * k)
    return codes


def pieces(text: bytes, order: int) -> Iterator[bytes]:
    """A text in parts of at most _CHUNK bytes, each after the `order` bytes before it; blanks stand before the first."""
    for at in range(0, len(text), _CHUNK):
        yield text[max(0, at - order) : at].rjust(order, b" ") + text[at : at + _CHUNK]


def own_bytes(sizes: np.ndarray, order: int) -> np.ndarray:
    """Which bytes of joined pieces of these sizes are their own, not the ones before."""
    own, starts = np.ones(sizes.sum(), bool), sizes.cumsum() - sizes
    for k in range(order):
        own[starts + k] = False
    return own


class Index:
    """Row numbers of distinct integers, by open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray):
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - size.bit_length() + 1), np.uint64(size - 1)
        self.rows = np.full(size, -1, np.int32)
        self.keys = np.zeros(size, np.uint64)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], self.probes)
            free = self.rows[slot] < 0
            self.rows[slot[free]] = left[free]
            left = left[self.rows[slot] != left]
            self.probes += 1
        held = self.rows >= 0
        self.keys[held] = keys[self.rows[held]]

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return (((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift) + np.uint64(probe)) & self.mask

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it is not held."""
        slot = self._slot(keys, 0)
        found = np.where(self.keys[slot] == keys, self.rows[slot], -1)
        open_ = np.nonzero((found < 0) & (self.rows[slot] >= 0))[0]
        for probe in range(1, self.probes):
            if not len(open_):
                break
            slot = self._slot(keys[open_], probe)
            hit = self.keys[slot] == keys[open_]
            found[open_[hit]] = self.rows[slot[hit]]
            open_ = open_[~hit & (self.rows[slot] >= 0)]
        return found


class Trees:
    """Frozen context trees of all languages: code lengths of every counted byte string, and escapes of every context."""

    def __init__(self, languages: list[str], order: int, counts: pd.DataFrame):
        """counts: lang, size (bytes of the string), gram, n."""
        self.languages, self.order = languages, order
        number = {lang: i for i, lang in enumerate(languages)}
        n_langs = len(languages)
        self.strings: list[Index] = []
        self.lengths: list[np.ndarray] = []
        self.contexts: list[Index] = []
        self.escapes: list[np.ndarray] = []
        for k in range(order + 1):
            own = counts[counts["size"] == k + 1]
            gram = own["gram"].to_numpy().astype(np.uint64)
            lang = own["lang"].map(number).to_numpy().astype(int)
            n = own["n"].to_numpy().astype(float)
            strings, at = np.unique(gram, return_inverse=True)
            contexts, ctx_of = np.unique(strings >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((len(contexts), n_langs)), np.zeros((len(contexts), n_langs))
            np.add.at(total, (ctx_of[at], lang), n)
            np.add.at(kinds, (ctx_of[at], lang), 1)
            seen = np.zeros((len(strings), n_langs))
            seen[at, lang] = n
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                direct = -np.log2(seen / (total + kinds)[ctx_of])
            escape_of = escape[ctx_of]
            if k == 0:
                lower = np.full((len(strings), n_langs), 8.0)
            else:
                lower = self._code(strings, k - 1)
            self.strings.append(Index(strings))
            self.lengths.append(np.where(seen > 0, direct, escape_of + lower))
            self.contexts.append(Index(contexts))
            self.escapes.append(escape)

    def _code(self, strings: np.ndarray, k: int) -> np.ndarray:
        """Code lengths of the last byte of each string after its last k bytes before it."""
        if k < 0:
            return np.full((len(strings), len(self.languages)), 8.0)
        own = strings & np.uint64((1 << (8 * (k + 1))) - 1)
        row = self.strings[k](own)
        out = self.lengths[k][row] if len(self.lengths[k]) else np.zeros((len(row), len(self.languages)))
        miss = np.nonzero(row < 0)[0]
        if len(miss):
            ctx = self.contexts[k](own[miss] >> np.uint64(8))
            escape = np.where((ctx >= 0)[:, None], self.escapes[k][ctx], 0.0) if len(self.escapes[k]) else 0.0
            out[miss] = escape + self._code(strings[miss], k - 1)
        return out

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each plain text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        part: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            for piece in pieces(text, self.order):
                part.append((i, piece))
                size += len(piece)
                if size >= _CHUNK:
                    self._add(part, out)
                    part, size = [], 0
        if part:
            self._add(part, out)
        return out

    def _add(self, part: list[tuple[int, bytes]], out: np.ndarray) -> None:
        data = np.frombuffer(b"".join(t for _, t in part), np.uint8)
        sizes = np.array([len(t) for _, t in part])
        lengths = self._code(grams(data, self.order + 1)[own_bytes(sizes, self.order)], self.order)
        inner = sizes - self.order
        sums = np.add.reduceat(lengths, np.concatenate([[0], inner.cumsum()[:-1]]), axis=0)
        np.add.at(out, [i for i, _ in part], sums)


def counted(texts: DataFrame, order: int = 3) -> pd.DataFrame:
    """lang, part, gram, n: the strings of order + 1 bytes in all texts (text, lang, part: int) of each language and part, on the driver.

    Only distinct strings leave a task, and their number is bounded by the languages' strings, not by the rows.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[tuple[str, int], list[bytes]] = defaultdict(list)

        def add() -> None:
            for key, parts in waiting.items():
                # each text alone, between blanks: the blanks before it are context and not counted, so counts do not depend on which texts meet
                strings = grams(np.frombuffer(b"".join(parts), np.uint8), order + 1)[own_bytes(np.array([len(p) for p in parts]), order)]
                gram, n = np.unique(strings.astype(np.uint32 if order < 4 else np.uint64), return_counts=True)
                if key in found:
                    gram, at = np.unique(np.concatenate([found[key][0], gram]), return_inverse=True)
                    n, each = np.zeros(len(gram), np.int64), np.concatenate([found[key][1], n])
                    np.add.at(n, at, each)
                found[key] = gram, n
            waiting.clear()

        size = 0
        for batch in batches:
            for text, lang, part in zip(batch["text"], batch["lang"], batch["part"], strict=True):
                for piece in pieces(plain(text) + b" ", order):
                    waiting[lang, part].append(piece)
                    size += len(piece)
                    if size >= 8 * _CHUNK:
                        add()
                        size = 0
        add()
        for (lang, part), (gram, n) in found.items():
            yield pd.DataFrame({"lang": lang, "part": part, "gram": gram.astype(np.uint64).view(np.int64), "n": n})

    counts = texts.select("text", "lang", "part").mapInPandas(count, "lang string, part int, gram long, n long")
    return counts.groupBy("lang", "part", "gram").agg(F.sum("n").alias("n")).toArrow().to_pandas()


def grown(counts: pd.DataFrame, order: int = 3) -> Trees:
    """Trees of the strings that `counted` gives, or of some parts of them. How often a shorter string occurs is the sum over the strings that end in it."""
    sizes = []
    for size in range(1, order + 2):
        ends = counts["gram"].to_numpy().astype(np.uint64) & np.uint64((1 << (8 * size)) - 1)
        own = pd.DataFrame({"lang": counts["lang"], "gram": ends.view(np.int64), "n": counts["n"]}).groupby(["lang", "gram"], as_index=False)["n"].sum()
        sizes.append(own.assign(size=size))
    return Trees(sorted(counts["lang"].unique()), order, pd.concat(sizes))


def train(docs: DataFrame, order: int = 3, rows_per_language: int = 1500) -> Trees:
    """Trees of every language in docs (text, lang), each from about `rows_per_language` distinct whole texts, chosen by hash."""
    few = sample_by_hash(docs, "lang", rows_per_language)
    return grown(counted(few.withColumn("part", F.lit(0)), order), order)


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """All columns of docs, with lang_pred and score, bits_per_byte (the winner's code length; null for und)."""
    from pyspark.sql.types import DoubleType, StringType, StructType

    held = docs.sparkSession.sparkContext.broadcast(trees)
    clash = {"lang_pred", "score", "bits_per_byte"}
    base = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in clash))
    schema = StructType([*base.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType()).add("bits_per_byte", DoubleType())

    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for batch in batches:
            texts = [t if has_letter(t) else None for t in batch.column("text").to_pylist()]
            there = [i for i, t in enumerate(texts) if t is not None and own.languages]
            lang, score, rate = [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts)
            if there:
                made = [plain(texts[i]) for i in there]
                bits = own.bits(made)
                best = bits.argmin(axis=1)
                low = bits.min(axis=1)
                share = 1.0 / np.exp2(np.clip(low[:, None] - bits, -1000, 0)).sum(axis=1)
                for i, b, s, x, t in zip(there, best, share, low, made, strict=True):
                    lang[i], score[i], rate[i] = own.languages[b], float(s), float(x) / max(1, len(t))
            columns = [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score", "bits_per_byte"])

    return base.mapInArrow(run, schema)
