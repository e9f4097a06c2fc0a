"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight vector is shared by all ordered thresholds. x counts in how many distinct words of a
text each chosen feature stands: words, and character strings of 5 and 6 of its words with their ends marked, hashed. Features are screened first: the
executors count in how many training texts of each grade a feature stands, and those that tell the higher grades from the lowest beyond chance stay, however many they
are; near copies (half of their runs of 3 words in common) count once there. The driver then fits weights and thresholds to the sample's chosen features. The expected severity is the
sum of P(grade > k). A training text is read once: its features are written, and screening and fitting take them from there.

Grades come from the caller. `severity_grades` makes them from two labels of a document: 0 is clean, 1 toxic in a text of low quality, which other filters drop as well, 2 toxic in
any other text, which nothing else stops.

Bounds: about `rows` distinct training texts of each grade, chosen by hash; 2^`bits` hash values.

Defined results: null, empty and wordless texts have no features and get the severity of such a text; without training rows, or with one grade
only, every severity is that grade (0 if none); repeated rows get equal results, and of equally likely grades the lowest is named; a word counts once however often it stands; texts are used whole; columns of docs with the names of the results are
replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace, labelled_sample, letter_words, sample_by_hash

_KNOWN = 300_000
#: The samples are small but their texts take long: they are dealt evenly.
_TASKS = 24
#: Min-hashes of a training text, and the odd factors that make them from one hash.
_HASHES = 64
_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, _HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _number(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def strings(word: str) -> set[str]:
    """A word's features: itself, and the character strings of 5 and 6 of it with its ends marked."""
    marked = f"<{word}>"
    return {word, *(marked[i : i + n] for n in (5, 6) for i in range(len(marked) - n + 1))}


def numbers(word: str, bits: int) -> list[int]:
    """A word's distinct feature numbers."""
    return sorted({xxhash.xxh32_intdigest(p) & ((1 << bits) - 1) for p in strings(word)})


class Featuriser:
    """Feature numbers of a text, each as often as distinct words have it; known words' are kept."""

    def __init__(self, bits: int):
        self.bits = bits
        self.known: dict[str, list[int]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        own, known = set(letter_words(text)), self.known
        if len(known) > _KNOWN:
            known.clear()
        for w in own.difference(known):
            known[w] = numbers(w, self.bits)
        return np.fromiter(chain.from_iterable(map(known.__getitem__, own)), np.uint32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Chosen feature numbers (sorted), their weights, and ordered thresholds between the grades."""

    def __init__(self, bits: int, chosen: np.ndarray, weights: np.ndarray, thresholds: np.ndarray, lowest: int):
        self.bits, self.chosen, self.weights, self.thresholds, self.lowest = bits, chosen, weights, thresholds, lowest

    def above(self, totals: np.ndarray) -> np.ndarray:
        """P(grade > k) of each text for each threshold."""
        return _sigmoid(totals[:, None] - self.thresholds[None, :])


class Scorer:
    """w . x of a text: the sum of its distinct words' own sums, which are kept."""

    def __init__(self, model: Model):
        self.bits, self.known = model.bits, {}
        self.weight = dict(zip(model.chosen.tolist(), model.weights.tolist(), strict=True))

    def __call__(self, text: str | None) -> float:
        own, known, weight = set(letter_words(text)), self.known, self.weight
        if len(known) > _KNOWN:
            known.clear()
        for w in own.difference(known):
            known[w] = sum(weight.get(f, 0.0) for f in numbers(w, self.bits))
        return sum(sorted(x for x in map(known.__getitem__, own) if x))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_features: int, n_grades: int, steps: int = 600, rate: float = 0.05, decay: float = 3e-4):
    """Weights and thresholds of grades 0..n_grades-1 by Adam on the negative log likelihood; grades weigh alike at half strength."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    which = np.concatenate(rows) if rows else np.empty(0, np.int64)
    share = np.bincount(grades, minlength=n_grades) / len(grades)
    weight = (1 / np.sqrt(share[grades] + 1e-9)) / len(grades)
    cuts = np.cumsum(share)[:-1]
    base = np.log((cuts + 1e-3) / (1 - cuts + 1e-3))
    # thresholds are a first one and positive gaps, so their order cannot be lost
    w, first, gaps = np.zeros(n_features), base[:1].copy(), np.log(np.maximum(np.diff(base), 0.1))
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (w, first, gaps)]
    for step in range(1, steps + 1):
        theta = np.concatenate([first, first + np.cumsum(np.exp(gaps))])
        total = np.bincount(at, weights=w[which], minlength=len(rows))
        upper = np.where(grades < n_grades - 1, _sigmoid(theta[np.minimum(grades, n_grades - 2)] - total), 1.0)
        lower = np.where(grades > 0, _sigmoid(theta[np.maximum(grades - 1, 0)] - total), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        d_up = np.where(grades < n_grades - 1, upper * (1 - upper), 0.0) / p * weight
        d_low = np.where(grades > 0, lower * (1 - lower), 0.0) / p * weight
        of_total = d_up - d_low  # slope of the loss by the total
        g_w = np.bincount(which, weights=of_total[at], minlength=n_features) + decay * w
        g_theta = np.bincount(np.maximum(grades - 1, 0), weights=d_low, minlength=n_grades - 1)[: n_grades - 1]
        g_theta = g_theta - np.bincount(np.minimum(grades, n_grades - 2), weights=d_up, minlength=n_grades - 1)[: n_grades - 1]
        g_first = np.array([g_theta.sum()])
        g_gaps = np.cumsum(g_theta[::-1])[::-1][1:] * np.exp(gaps)
        for x, g, (m, v) in zip((w, first, gaps), (g_w, g_first, g_gaps), state, strict=True):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    return w, np.concatenate([first, first + np.cumsum(np.exp(gaps))])


def _signature(text: str) -> np.ndarray:
    """Min-hashes of a text's runs of 3 words; of equal places in two texts as many agree as their sets overlap."""
    words = letter_words(text)
    runs = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    h = np.array([xxhash.xxh64_intdigest(r) for r in runs], np.uint64)
    out = np.full(_HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(h), 4096):
        mixed = h[at : at + 4096, None] * _FACTORS[None, :]
        out = np.minimum(out, (mixed ^ (mixed >> np.uint64(29))).min(axis=0))
    return out


def later_copies(signatures: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Which rows have a near copy among the rows before them on their side: linked by half of the places, straight or through others."""
    root = list(range(len(signatures)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for at in range(0, _HASHES, 2):
        band = np.column_stack([signatures[:, at : at + 2], sides.astype(np.uint64)])
        _, first, group = np.unique(band, axis=0, return_index=True, return_inverse=True)
        pivot = first[group.reshape(-1)]
        for i in np.nonzero((signatures == signatures[pivot]).mean(axis=1) >= 0.5)[0]:
            a, b = sorted((top(int(i)), top(int(pivot[i]))))
            root[b] = a
    return np.array([top(i) != i for i in range(len(root))], bool)


def featurised(sample: DataFrame, bits: int) -> DataFrame:
    """grade, h (a number of the text), signature and features of a sample's texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        featurise = Featuriser(bits)
        for batch in batches:
            made = {"grade": batch["grade"], "h": [_number(t) for t in batch["text"]], "signature": [_signature(t).tobytes() for t in batch["text"]]}
            yield pd.DataFrame({**made, "x": [featurise(t).tobytes() for t in batch["text"]]})

    return sample.mapInPandas(run, "grade int, h long, signature binary, x binary")


def screen(rows: DataFrame, bits: int, least: float = 24.0, lift: float = 5.0) -> np.ndarray:
    """The features that tell higher grades from the lowest: a G-squared of `least` or more (chance alone gives that to
    about one in a million), and at least `lift` times as common in the higher grades; sorted by number. Near copies count once in the
    lowest grade and once in the higher ones. rows: as featurised."""
    lowest = rows.agg(F.min("grade")).first()[0]
    signed = rows.select("h", (F.col("grade") > lowest).cast("int").alias("side"), "signature").toPandas().sort_values(["h", "side"])
    sides = signed["side"].to_numpy()
    copies = later_copies(np.frombuffer(b"".join(signed["signature"]), np.uint64).reshape(-1, _HASHES), sides)
    left_out = frozenset(zip(signed["h"][copies].tolist(), sides[copies].tolist(), strict=True))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, 1 << bits), np.int32)
        for batch in batches:
            for h, grade, x in zip(batch["h"], batch["grade"], batch["x"], strict=True):
                if (int(h), int(grade > lowest)) not in left_out:
                    sums[int(grade > lowest), np.unique(np.frombuffer(x, np.uint32))] += 1
        there = np.nonzero(sums.any(axis=0))[0]
        yield pd.DataFrame({"f": there, "low": sums[0, there], "high": sums[1, there]})

    sums = rows.select("h", "grade", "x").mapInPandas(count, "f long, low long, high long").groupBy("f").agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    n = {"low": int((~copies & (sides == 0)).sum()), "high": int((~copies & (sides == 1)).sum())}
    total = float(n["low"] + n["high"])

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    both = F.col("low") + F.col("high")
    parts = [
        term(s, held * size / total)
        for held, cells in ((both, (F.col("low"), F.col("high"))), (F.lit(total) - both, (n["low"] - F.col("low"), n["high"] - F.col("high"))))
        for s, size in zip(cells, (float(n["low"]), float(n["high"])), strict=True)
    ]
    more = (F.col("high") + 0.5) / (n["high"] + 1) >= lift * (F.col("low") + 0.5) / (n["low"] + 1)
    # at most 2^bits numbers
    found = sums.where(both > 1).where((2 * sum(parts) >= least) & more)
    return np.array(sorted(r["f"] for r in found.select("f").collect()), np.int64)


def train(spark: SparkSession, docs: DataFrame, rows: int = 4000, bits: int = 20) -> Model:
    """A model of docs (text, grade): whole numbers, the lowest the mildest; grades between them that no row has are kept as levels."""
    graded = docs.withColumn("grade", F.col("grade").cast("int"))
    work = Workspace(spark, "toxicity")
    sample = work.table(featurised(sample_by_hash(graded, "grade", rows).repartition(_TASKS), bits), "sample")
    ends = sample.agg(F.min("grade"), F.max("grade")).first()
    if ends[0] is None or ends[0] == ends[1]:
        return Model(bits, np.empty(0, np.int64), np.empty(0), np.empty(0), ends[0] or 0)
    chosen = screen(sample, bits)

    def picked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = np.full(1 << bits, -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        for batch in batches:
            found = [place[np.frombuffer(x, np.uint32)] for x in batch["x"]]
            yield pd.DataFrame({"grade": batch["grade"], "h": batch["h"], "x": [np.sort(f[f >= 0]) for f in found]})

    found = sample.select("grade", "h", "x").mapInPandas(picked, "grade int, h long, x array<long>").toPandas().sort_values(["h", "grade"])
    work.close()
    weights, thresholds = fit([np.asarray(x, np.int64) for x in found["x"]], found["grade"].to_numpy() - ends[0], len(chosen), ends[1] - ends[0] + 1)
    return Model(bits, chosen, weights, thresholds, ends[0])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs, with severity (expected grade), grade (the likeliest) and score (P(grade > lowest))."""
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, IntegerType, StructType

    held = docs.sparkSession.sparkContext.broadcast(model)
    made = {"severity", "grade", "score"}
    base = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in made))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        total = Scorer(own)
        for batch in batches:
            totals = np.array([total(t) for t in batch.column("text").to_pylist()], float)
            above = own.above(totals)
            edges = np.hstack([np.ones((len(totals), 1)), above, np.zeros((len(totals), 1))])
            grade = (edges[:, :-1] - edges[:, 1:]).argmax(axis=1) + own.lowest
            first = above[:, 0] if above.shape[1] else np.zeros(len(totals))
            out = [pa.array(above.sum(axis=1) + own.lowest, pa.float64()), pa.array(grade, pa.int32()), pa.array(first, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*batch.schema.names, "severity", "grade", "score"])

    return base.mapInArrow(run, StructType([*base.schema.fields]).add("severity", DoubleType()).add("grade", IntegerType()).add("score", DoubleType()))


def severity_grades(toxic: Column, quality: Column) -> Column:
    """0 where toxic is 0, 1 where it is 1 and quality 0, 2 where quality is another one or unknown; null where toxic is null."""
    return F.when(toxic == 0, 0).when(toxic == 1, F.when(quality == 0, 1).otherwise(2))


def labelled(spark: SparkSession, docs: DataFrame, labels: DataFrame, most: int = 4000) -> DataFrame:
    """text, grade of about `most` distinct texts of each grade; docs: doc_id, text; labels: doc_id, grade (of several the severest counts)."""
    some = labelled_sample(docs.select("doc_id", "text"), labels.select("doc_id", F.col("grade").cast("int").alias("label")), most)
    return Workspace(spark, "toxicity").table(some.select("text", F.col("label").alias("grade")), "labelled")
