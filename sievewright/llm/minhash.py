"""Near-duplicate groups by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so half as many hash
evaluations fill a signature. Bands of `rows` values each are hashed to buckets. The number of bands follows from the
threshold: a pair just at it misses every band with a probability of at most `miss`.

From buckets to links without all pairs of a bucket:
1. Equal shingle sets become one node first, so exact copies cost one row each.
2. In every bucket each node is paired with one pivot, another one in each bucket, so that a group of which not all pairs are linked still holds together. Pairs within the bounds
   below are confirmed on the full sets; confirmed links make components. A pivot of many pairs is sent to as many parts as its largest bucket asks for.
3. Buckets whose nodes then lie in different components remain. Their nodes outside the bucket's largest component are
   paired with all nodes of other components there, filtered and confirmed alike. Pairs inside a component need no test:
   one more link there changes nothing.
So every pair of a bucket is confirmed, refused by a bound, or already connected. The bounds are exact, they refuse no linked
pair: sizes must be within the threshold of each other, and the odd sketches of two sets (bit h mod m is flipped by each
shingle h) differ in at most as many bits as the sets differ in shingles, which the threshold limits.

Texts move only for nodes that share a bucket: a bitmap of bounded size tells most others before the shuffle.

Defined results: null, empty and wordless texts have an empty set, link with nothing and keep themselves; a text with fewer
words than a shingle is one shingle; repeated rows are in the group of their set, and each row is returned; a row without
doc_id takes the smallest doc_id that it reaches (null if none) and is kept only if it reaches no row with one; texts are used whole; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm.common import Workspace, among, plain_words
from sievewright.llm.components import components

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_KNOWN_WORDS = 200_000
#: A pivot's pairs are dealt to parts of about so many.
_FAN = 64


@dataclass(frozen=True)
class Plan:
    """Shingle width, threshold as a fraction of whole numbers, and the banding that follows from them."""

    words: int = 5
    numerator: int = 80
    denominator: int = 100
    rows: int = 5
    miss: float = 1e-6
    seed: int = 17
    sketch_bits: int = 2048
    head: int = 8

    @property
    def bands(self) -> int:
        hit = (self.numerator / self.denominator) ** self.rows
        return math.ceil(math.log(self.miss) / math.log(1 - hit))

    @property
    def permutations(self) -> int:
        return -(-self.bands * self.rows // 2)


class Shingler:
    """Distinct shingle hashes of texts, sorted; word hashes are kept for the next texts."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = plain_words(text)
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > _KNOWN_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        ids = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(ids))
        mixed = np.full(len(ids) - width + 1, width, np.uint64)
        for k in range(width):
            mixed = (mixed ^ ids[k : len(ids) - width + 1 + k]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX2
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


class Signer:
    """Signatures of shingle sets: all minima, then all maxima, under the same permutations."""

    def __init__(self, plan: Plan):
        self.plan = plan
        made = np.random.Generator(np.random.PCG64(plan.seed))
        self.mul = (made.integers(0, 1 << 63, plan.permutations, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.add = made.integers(0, 1 << 63, plan.permutations, dtype=np.uint64)
        # which values stand together in a band: a fixed shuffle, so that a minimum and its maximum seldom do
        self.order = made.permutation(2 * plan.permutations)[: plan.bands * plan.rows]

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.mul), np.uint64)
        for at in range(0, len(shingles), 2048):
            hashed = self.mul[:, None] * shingles[None, at : at + 2048] + self.add[:, None]
            np.minimum(low, hashed.min(axis=1), out=low)
            np.maximum(high, hashed.max(axis=1), out=high)
        return np.concatenate([low, high])

    def bands(self, signature: np.ndarray) -> np.ndarray:
        values = signature[self.order].reshape(self.plan.bands, self.plan.rows)
        key = np.arange(1, self.plan.bands + 1, dtype=np.uint64) * _MIX2
        for k in range(self.plan.rows):
            key = (key ^ values[:, k]) * _MIX
            key ^= key >> np.uint64(31)
        return key.view(np.int64)


def odd_sketch(shingles: np.ndarray, bits: int) -> np.ndarray:
    """The parity of the shingles of each residue, packed into longs."""
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, tkey, n_shingles, set_id, bands of every document."""
    schema = "doc_id long, tkey long, n_shingles long, set_id binary, bands array<long>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, sign = Shingler(plan.words), Signer(plan)
        for batch in batches:
            rows = []
            for doc_id, text, tkey in zip(batch["doc_id"].array, batch["text"].array, batch["tkey"].array, strict=True):
                if len(own := shingle(text if isinstance(text, str) else None)):
                    rows.append((doc_id, tkey, len(own), xxhash.xxh3_128_digest(own.tobytes()), sign.bands(sign(own))))
                else:
                    rows.append((doc_id, tkey, 0, None, None))
            yield pd.DataFrame(rows, columns=["doc_id", "tkey", "n_shingles", "set_id", "bands"]).astype({"doc_id": "Int64"})

    return _slim(docs).mapInPandas(run, schema)


def _slim(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("tkey"))


def _sets(texts: DataFrame, plan: Plan) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(plan.words)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                made = [shingle(t) for t in part["text"]]
                yield pd.DataFrame({"nid": part["nid"], "n": [len(x) for x in made], "sketch": [odd_sketch(x, plan.sketch_bits) for x in made], "shingles": [x.view(np.int64) for x in made]})

    return texts.select("nid", "text").mapInPandas(run, "nid long, n long, sketch array<long>, shingles array<long>")


def _facts(sets: DataFrame, plan: Plan, side: str) -> DataFrame:
    """nid and what the bounds need of it, named by a side; the sketch's first longs are columns of their own, which compare faster."""
    head = [F.col("sketch")[k].alias(f"head{k}_{side}") for k in range(plan.head)]
    return sets.select(F.col("nid").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"), *head)


def _near(plan: Plan):
    """The bounds that every linked pair meets, on its sizes and sketches."""
    size = plan.denominator * F.least("n_a", "n_b") >= plan.numerator * F.greatest("n_a", "n_b")
    # a linked pair differs in at most (1 - t) / (1 + t) of its n_a + n_b shingles
    most = (F.col("n_a") + F.col("n_b")) * (plan.denominator - plan.numerator)
    whole = plan.denominator + plan.numerator
    begun = sum(F.bit_count(F.col(f"head{k}_a").bitwiseXOR(F.col(f"head{k}_b"))) for k in range(plan.head)) * whole
    # the whole sketch by a lambda: spelt out, it makes the join's code too long for the JVM to compile
    apart = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)
    return size & (begun <= most) & (apart * whole <= most)


def _tested(work: Workspace, pairs: DataFrame, sets: DataFrame, plan: Plan, parts: DataFrame | None, label: str) -> DataFrame:
    """The pairs (a, b, and part where parts are given) whose full sets reach the threshold. parts: b, part: where a set is needed as the second of a pair."""
    keys = ["b", "part"] if parts is not None else ["b"]
    second = lambda facts: facts.join(parts, "b") if parts is not None else facts
    near = pairs.join(_facts(sets, plan, "a"), "a").join(second(_facts(sets, plan, "b")), keys).where(_near(plan)).select("a", *keys)
    near = work.table(near, f"{label}-near")
    full = lambda side: sets.select(F.col("nid").alias(side), F.col("shingles").alias(f"of_{side}"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    both = near.join(full("a"), "a").join(second(full("b").join(near.select("b").distinct(), "b")), keys)
    linked = both.where(plan.denominator * common.cast("long") >= plan.numerator * union.cast("long")).select("a", "b")
    return work.table(linked, label)


def near_duplicates(spark: SparkSession, docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text).

    Also text_key (xxhash64 of the text), and representative: true for the rows of the group's smallest doc_id and text_key, nulls first,
    which is one document of each group even where ids are missing.
    """
    work = Workspace(spark, "minhash")
    signed = work.table(signatures(docs, plan), "signed")
    nodes = (
        signed.where("set_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("least_id"), F.min(F.struct("doc_id", "tkey")).alias("own"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
        .withColumn("nid", F.monotonically_increasing_id())
    )
    nodes = work.table(nodes, "nodes")
    buckets = nodes.select(F.explode("bands").alias("bucket"), "nid")
    # XOR with the bucket's own number orders nodes otherwise in each bucket: its smallest is that bucket's pivot
    least = F.min(F.col("nid").bitwiseXOR(F.col("bucket")))
    shared = buckets.groupBy("bucket").agg(least.bitwiseXOR(F.col("bucket")).alias("pivot"), F.count("*").alias("size")).where("size > 1")
    shared = work.table(shared, "shared")
    members = work.table(among(buckets, "bucket", shared).join(shared, "bucket"), "members")
    needed = nodes.join(members.select("nid").distinct(), "nid").select(F.col("own.tkey").alias("own_key"), F.col("own.doc_id").alias("own_id"), "nid")
    needed = work.table(needed, "needed")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.own_id")) & (F.col("d.tkey") == F.col("f.own_key"))
    texts = among(_slim(docs), "tkey", needed).alias("d").join(needed.alias("f"), same)
    sets = work.table(_sets(texts.dropDuplicates(["nid"]), plan), "sets")

    pairs = members.where("nid <> pivot").groupBy(F.col("nid").alias("a"), F.col("pivot").alias("b")).agg(F.max("size").alias("size"))
    fan = F.ceil(F.col("size") / _FAN)
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("a"), fan).alias("part"))
    # a pivot's largest bucket has at least as many parts as any other of its buckets
    parts = shared.groupBy(F.col("pivot").alias("b")).agg(F.max("size").alias("size")).select("b", F.explode(F.sequence(F.lit(0).cast("long"), fan - 1)).alias("part"))
    links = _tested(work, pairs, sets, plan, parts, "star-links")
    found = work.table(components(work, links), "star-components")

    placed = members.select("bucket", "nid").join(found.withColumnRenamed("node", "nid"), "nid", "left").select("bucket", "nid", F.coalesce("comp", "nid").alias("comp"))
    of_bucket = placed.groupBy("bucket", "comp").agg(F.count("*").alias("size")).groupBy("bucket").agg(F.count("*").alias("comps"), F.max_by("comp", "size").alias("largest"))
    mixed = work.table(placed.join(of_bucket.where("comps > 1").drop("comps"), "bucket"), "mixed")
    minor = mixed.where("comp <> largest").select("bucket", F.col("nid").alias("a"), F.col("comp").alias("comp_a")).join(_facts(sets, plan, "a"), "a")
    other = mixed.select("bucket", F.col("nid").alias("b"), F.col("comp").alias("comp_b"), F.col("largest").alias("largest_b")).join(_facts(sets, plan, "b"), "b")
    # both minor: one direction is enough
    once = (F.col("comp_b") == F.col("largest_b")) | (F.col("a") < F.col("b"))
    across = minor.join(other, "bucket").where((F.col("comp_a") != F.col("comp_b")) & once & _near(plan)).select("a", "b").distinct()
    more = _tested(work, work.table(across, "across"), sets, plan, None, "cross-links")
    work.drop("shared", "members", "needed", "sets", "mixed", "across", "star-links-near", "cross-links-near")
    if not more.isEmpty():
        found = work.table(components(work, links.union(more)), "components")

    of_node = nodes.join(found.withColumnRenamed("node", "nid"), "nid", "left").select("set_id", "least_id", "own", F.coalesce("comp", "nid").alias("comp"))
    least = of_node.groupBy("comp").agg(F.min("least_id").alias("component_id"), F.min("own").alias("first"))
    of_set = of_node.join(least, "comp").select("set_id", "component_id", "first")
    alone = F.col("set_id").isNull()
    return signed.select("doc_id", "tkey", "n_shingles", "set_id").join(of_set, "set_id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, True).otherwise(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"),
        F.col("tkey").alias("text_key"),
        F.when(alone, True).otherwise(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tkey") == F.col("first.tkey"))).alias("representative"),
    )
