"""Quality classifier by positive-unlabelled learning.

The model is linear in standardised shape features of the whole text. It minimises the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss: trusted positives are documents labelled 1, the unlabelled ones are all documents; negative labels are never used. For this loss and a linear model the sum without the max is
convex, and the positives enter it by their mean alone, so Newton's method needs one pass a step over the written features, which adds up a gradient and a matrix of the features' size in each
task. Nothing is sampled. A pass tries several step lengths; one that makes the inner term negative, where the max cuts in, is not taken, which keeps the model from fitting the
unlabelled documents as all negative.

The class prior is estimated first, from positives and unlabelled documents alone: a first model tells positives from unlabelled, and the share of unlabelled scores above a threshold over that of
positives is at least the prior for every threshold, and equal to it where only positives score that high. The smallest upper bound over all thresholds, with an allowance for
their numbers, is the estimate.

Bounds: the driver holds sums over `N_FEATURES` features and histograms of `_BINS` bins, never rows.

Defined results: null, empty and wordless texts have all-zero features and get the score of such a text; without any positives, or without documents, the score is the
prior 0.5 everywhere; repeated rows count and score alike; of several labels of a document the highest counts; texts are used whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace

_PUNCT = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
N_FEATURES = len(_PUNCT) + 19
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 1  # white space
_KIND[[ord(c) for c in ".,;:!?\"'()"]] = 2  # what is cut off a word's ends
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_BINS = 1024


def features(text: str | None) -> np.ndarray:
    """Shape of a whole text: shares of kinds of characters and words, repetition, lengths."""
    out = np.zeros(N_FEATURES)
    if not isinstance(text, str) or not text:
        return out
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    counts = np.bincount(data, minlength=256)
    n, kind = len(raw), _KIND[data]
    blank = np.concatenate([[True], kind == 1, [True]])
    edges = np.nonzero(blank[1:] != blank[:-1])[0]
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    m = max(1, len(starts))
    letters = max(1, counts[65:91].sum() + counts[97:123].sum())
    ids = np.fromiter(map(hash, raw.split()), np.int64, len(starts))
    lines = raw.split(b"\n")
    kinds = len(np.unique(ids))
    same = int((ids[1:] == ids[:-1]).sum())
    lone = int(((lengths == 1) & ~_ALNUM[data[starts]]).sum())
    two = len(np.unique(ids[1:] * np.int64(0x5851F42D4C957F2D) ^ ids[:-1])) if len(ids) > 1 else 0
    # the last byte of each word that is not cut off its end
    last = np.maximum.accumulate(np.where(kind == 0, np.arange(n), -1))[ends - 1]
    own = data[np.maximum(last, 0)]
    odd = int(((last >= starts) & (own >= 33) & (own < 127) & ~_ALNUM[own]).sum())
    size = lengths if len(lengths) else np.zeros(1)
    out[: len(_PUNCT)] = np.sqrt(counts[_PUNCT] / m)
    out[len(_PUNCT) :] = (
        counts[65:91].sum() / letters,
        counts[48:58].sum() / n,
        counts[128:].sum() / n,
        counts[32] / n,
        counts[10] / m,
        kinds / m,
        kinds / np.sqrt(m),
        same / m,
        np.sqrt(same / m),
        lone / m,
        two / m,
        odd / m,
        size.mean() / 10,
        size.std() / 10,
        size.max() ** 0.5 / 10,
        np.log1p(m) / 10,
        len({x for x in lines if x}) / max(1, len(lines)),
        np.log1p(max(map(len, lines))) / 10,
        1.0 if len(starts) else 0.0,
    )
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


#: (rows, whether they are positives) in parts -> the sum over all parts of a function's arrays.
Sums = Callable[[Callable[[np.ndarray, np.ndarray], list[np.ndarray]]], list[np.ndarray]]


def minimise(sums: Sums, width: int, prior: float, n_p: float, n_u: float, steps: int = 40, decay: float = 1e-4, clamp: bool = True) -> np.ndarray:
    """Weights and, last, the bias: the (non-negative) risk, by Newton steps; n_p and n_u rows. sums: rows have a last column of ones.

    decay keeps the weights, not the bias, finite; it also makes the matrix invertible.
    """
    ridge = np.append(np.full(width - 1, decay), 1e-9)
    lengths = np.array([1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001])

    def looked(candidates: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each row of weights the risk without the max, with the penalty, and its inner term; of the first row slope and matrix besides: it is the likeliest to be taken."""

        def part(x, is_p):
            u, first = x[~is_p], candidates[0]
            s = _sigmoid(u @ first)
            return [np.logaddexp(0, u @ candidates.T).sum(axis=0), np.logaddexp(0, x[is_p] @ candidates.T).sum(axis=0), x[is_p].sum(axis=0), u.T @ s, (u * (s * (1 - s))[:, None]).T @ u]

        u, p, sum_p, g, h = sums(part)
        # l(f) - l(-f) = -f for the logistic loss
        risk = u / n_u - prior * candidates @ sum_p / n_p + 0.5 * (candidates**2 * ridge).sum(axis=1)
        return risk, u / n_u - prior * p / n_p, g / n_u - prior * sum_p / n_p + ridge * candidates[0], h / n_u + np.diag(ridge)

    w = np.zeros(width)
    risk, _, g, h = looked(w[None, :])
    loss = risk[0]
    for _ in range(steps):
        tried = w[None, :] + lengths[:, None] * np.linalg.solve(h, -g)[None, :]
        risk, inner, g, h = looked(tried)
        risk = np.where((inner >= 0) | (not clamp), risk, np.inf)
        best = int(np.argmin(risk))
        if not risk[best] < loss - 1e-9:
            break
        gain, loss, w = loss - risk[best], risk[best], tried[best]
        if gain < 1e-6:
            break
        if best:
            _, _, g, h = looked(w[None, :])
    return w


def apart(sums: Sums, width: int, n_p: float, n_u: float, steps: int = 12, decay: float = 1e-3) -> np.ndarray:
    """Weights and bias of logistic regression of positives against unlabelled, both kinds weighing alike, by Newton steps."""
    ridge, w = np.append(np.full(width - 1, decay), 1e-9), np.zeros(width)
    for _ in range(steps):

        def slopes(x, p, w=w):
            weight = np.where(p, 0.5 / n_p, 0.5 / n_u)
            s = _sigmoid(x @ w)
            return [x.T @ (weight * (s - p)), (x * (weight * s * (1 - s))[:, None]).T @ x]

        g, h = sums(slopes)
        step = np.linalg.solve(h + np.diag(ridge), -(g + ridge * w))
        w = w + step * min(1.0, 10 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-2:
            break
    return w


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from histograms of both kinds' scores (higher: likelier positive)."""
    if not positive.sum() or not unlabelled.sum():
        return 0.5
    n = np.array([positive.sum(), unlabelled.sum()], float)
    above = np.stack([positive[::-1].cumsum() / n[0], unlabelled[::-1].cumsum() / n[1]])
    # both shares are known to within about sqrt(log(n) / n): the bound is only meant where many positives score that high
    slack = np.sqrt(np.log(4 / 0.1) / 2) * (1 / np.sqrt(n)).sum()
    held = above[0] > 0
    bound = (above[1][held] + slack) / above[0][held]
    at = int(np.argmin(bound))
    return float(np.clip(above[1][held][at] / above[0][held][at], 0.02, 0.98))


class Model:
    """Standardising and weights; scores are sigmoids."""

    def __init__(self, centre: np.ndarray, width: np.ndarray, weights: np.ndarray, prior: float):
        self.centre, self.width, self.weights, self.prior = centre, width, weights, prior

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Standardised features with a last column of ones."""
        return np.hstack([np.clip((x - self.centre) / self.width, -8, 8), np.ones((len(x), 1))])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.rows(x) @ self.weights)


def _matrix(cells) -> np.ndarray:
    return np.frombuffer(b"".join(cells), "<f4").reshape(-1, N_FEATURES).astype(float)


def vectors(docs: DataFrame) -> DataFrame:
    """All columns of docs (text) with its features, packed; a column named features is replaced."""
    import pyarrow as pa
    from pyspark.sql.types import BinaryType, StructType

    base = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != "features"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t).astype("<f4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "features"])

    return base.mapInArrow(run, StructType([*base.schema.fields]).add("features", BinaryType()))


def _summed(rows: DataFrame) -> Callable:
    """For a model, the sums over all rows (features, positive) of functions of its standardised rows: each task adds up its own part."""

    def of_model(model: Model) -> Sums:
        def sums(function):
            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                total = None
                for batch in batches:
                    for at in range(0, len(batch), 4096):
                        part = batch.iloc[at : at + 4096]
                        made = function(model.rows(_matrix(part["features"])), part["positive"].to_numpy(bool))
                        total = made if total is None else [a + b for a, b in zip(total, made, strict=True)]
                if total is not None:
                    yield pd.DataFrame({"k": range(len(total)), "s": [np.asarray(t, float).tobytes() for t in total], "shape": [list(np.shape(t)) for t in total]})

            out: dict[int, np.ndarray] = {}
            for k, s, shape in rows.mapInPandas(run, "k int, s binary, shape array<int>").collect():
                one = np.frombuffer(s).reshape(shape)
                out[k] = out[k] + one if k in out else one
            return [out[k] for k in sorted(out)]

        return sums

    return of_model


def train(spark: SparkSession, featured: DataFrame, labels: DataFrame, prior: float | None = None) -> Model:
    """featured: doc_id and features, as vectors gives them, best a written table. labels: doc_id, label; only those of 1 are used. prior: None to estimate it."""
    work = Workspace(spark, "quality")
    trusted = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label")).where("label = 1").select("doc_id")
    every = featured.select("features", F.lit(False).alias("positive"))
    rows = work.table(every.unionAll(featured.join(trusted, "doc_id", "left_semi").select("features", F.lit(True).alias("positive"))), "rows")
    of_model = _summed(rows)
    plain = Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1), 0.5)

    found = of_model(_Plain())(lambda x, p: [np.array([p.sum(), (~p).sum()], float), x[~p].sum(axis=0), (x[~p] ** 2).sum(axis=0)])
    if not found or not found[0].all():
        work.close()
        return plain
    n_p, n = found[0]
    centre = found[1] / n
    width = np.sqrt(np.maximum(found[2] / n - centre**2, 0)) + 1e-3
    model = Model(centre, width, np.zeros(N_FEATURES + 1), 0.5)
    sums = of_model(model)
    if prior is None:
        tell, edges = apart(sums, N_FEATURES + 1, n_p, n), np.linspace(0, 1, _BINS + 1)[1:-1]

        def histogram(x, p):
            at = np.digitize(_sigmoid(x @ tell), edges)
            return [np.bincount(at[p], minlength=_BINS), np.bincount(at[~p], minlength=_BINS)]

        prior = prior_of(*sums(histogram))
    model.prior = float(np.clip(prior, 0.02, 0.98))
    model.weights = minimise(sums, N_FEATURES + 1, model.prior, n_p, n)
    work.close()
    return model


class _Plain(Model):
    """Features as they are."""

    def __init__(self):
        super().__init__(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1), 0.5)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return x


def score(featured: DataFrame, model: Model) -> DataFrame:
    """All columns of featured but features, with score; a column of that name is replaced."""
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, StructType

    held = featured.sparkSession.sparkContext.broadcast(model)
    base = featured.select(*(F.col(f"`{c}`") for c in featured.columns if c.lower() not in ("score", "features")), "features")
    out = StructType([*base.schema.fields[:-1]]).add("score", DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = held.value(_matrix(batch.column("features").to_pylist())) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return base.mapInArrow(run, out)
