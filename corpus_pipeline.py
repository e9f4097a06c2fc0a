"""The corpus pipeline: language, quality, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs. All
but the last return the columns of docs. A stage learns only from its own input and from the labels and benchmark tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import decontam, langid, minhash, packing, quality
from sievewright.llm.common import Workspace, read
from sievewright.llm.queries import vocabulary


def _kept(docs: DataFrame, decide) -> DataFrame:
    """The rows that a decision keeps, with all columns of docs. Columns that an operator names its results by are put aside meanwhile."""
    used = {"doc_id", "text", "lang"}
    aside = {c: c if c in used else f"_{n}_{c}" for n, c in enumerate(docs.columns)}
    return decide(docs.select(*(F.col(f"`{c}`").alias(a) for c, a in aside.items()))).select(*(F.col(f"`{a}`").alias(c) for c, a in aside.items()))


def medians(spark: SparkSession, values: DataFrame, bins: int = 1024) -> dict[str, tuple[int, float]]:
    """The number of values (lang, bits; a written table) of each language, and their exact median.

    The ranges of the one or two middle values are narrowed by histograms until each is a single value, so no task and no driver holds more than the bins.
    """
    ends = F.count("*").alias("n"), F.min("bits").alias("lo"), F.max("bits").alias("hi")
    whole = values.groupBy("lang").agg(*ends).collect()
    sizes = {r["lang"]: r["n"] for r in whole}
    # (language, rank): the values below the range, and the range's ends, which are values
    spans = {(r["lang"], rank): (0, r["lo"], r["hi"]) for r in whole for rank in {(r["n"] - 1) // 2, r["n"] // 2}}
    while wide := [(*key, lo, hi) for key, (_, lo, hi) in spans.items() if lo < hi]:
        asked = F.broadcast(spark.createDataFrame(wide, "lang string, rank long, first double, last double"))
        place = F.floor((F.col("bits") - F.col("first")) / (F.col("last") - F.col("first")) * bins)
        rows = values.join(asked, "lang").where("bits between first and last").groupBy("lang", "rank", place.alias("bin")).agg(*ends).collect()
        below = {key: spans[key][0] for key in spans}
        for r in sorted(rows, key=lambda r: r["bin"]):
            key = r["lang"], r["rank"]
            if below[key] <= r["rank"] < below[key] + r["n"]:
                spans[key] = below[key], r["lo"], r["hi"]
            below[key] += r["n"]
    return {lang: (n, (spans[lang, (n - 1) // 2][1] + spans[lang, n // 2][1]) / 2) for lang, n in sizes.items()}


def longest_codes(spark: SparkSession, docs: DataFrame, halves: list[langid.Trees], times: float = 3.5, least: int = 20) -> dict[str, float]:
    """Bits a byte that a text of each language (docs: text, lang, part) may take: `times` the median of all its distinct texts.

    halves: the trees of parts 0 and 1; each text is coded by those of the other part. A language with fewer than `least` texts rightly told so has no limit.
    """
    coded = [langid.predict(docs.where(F.col("part") == part), halves[1 - part]) for part in (0, 1)]
    own = coded[0].unionAll(coded[1]).where("lang_pred = lang and bits_per_byte is not null")
    # equal texts have equal codes, so no text moves
    each = own.select("lang", F.xxhash64("text").alias("h"), F.col("bits_per_byte").alias("bits")).distinct().select("lang", "bits")
    work = Workspace(spark, "language")
    found = medians(spark, work.table(each, "bits"))
    work.close()
    return {lang: times * bits for lang, (n, bits) in found.items() if n >= least}


def learned(spark: SparkSession, docs: DataFrame) -> tuple[langid.Trees, dict[str, float]]:
    """Trees of all distinct texts of each language (docs: text, lang), and the limits of longest_codes."""
    rows = docs.where("text is not null and lang is not null").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2)).cast("int"))
    counts = langid.counted(rows.distinct())
    return langid.grown(counts), longest_codes(spark, rows, [langid.grown(counts[counts["part"] == part]) for part in (0, 1)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, those that no learned language clearly leads on, and those whose code is too long for the one that leads. Learns from all texts."""
    trees, limits = learned(spark, docs.select("text", "lang"))
    limit = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for r in limits.items() for x in r)), F.col("lang_pred")), F.lit(float("inf"))) if limits else F.lit(float("inf"))
    keep = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= 0.3) & (F.col("bits_per_byte") <= limit)
    return _kept(docs, lambda own: langid.predict(own, trees).where(keep))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score below 0.3 for quality."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))

    def decide(own: DataFrame) -> DataFrame:
        featured = Workspace(spark, "good").table(quality.vectors(own), "features")
        return quality.score(featured, quality.train(spark, featured, labels)).where("score >= 0.3")

    return _kept(docs, decide)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: five words, a similarity of 0.8 or more."""
    found = minhash.near_duplicates(spark, docs, minhash.Plan(words=5, numerator=80)).where("representative")
    first = found.select(F.col("doc_id").alias("first_id"), F.col("text_key").alias("first_key")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))

    def decide(own: DataFrame) -> DataFrame:
        keyed = own.withColumn("text_key", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
        return keyed.join(first, same, "left_semi").dropDuplicates(["doc_id", "text_key"])

    return _kept(docs, decide)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold most of a benchmark item."""
    return _kept(docs, lambda own: decontam.flag(own, read(spark, sf_dir, "benchmark")).where("items = 0"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack(spark, docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language", language),
    ("quality", good),
    ("near_duplicates", unique),
    ("decontamination", clean),
    ("packing", packed),
]

#: Trained classifiers and hashed signatures have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    work, docs = Workspace(spark, "pipeline"), read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
