"""The registered queries of the corpus operators, and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import decontam, langid, licenses, minhash, packing, quality, sharding, topk, toxicity, urlfilter
from sievewright.llm.common import Workspace, bucket_of_id, read


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the packing evens out bytes first, so the law is `bytes`
    placed = sharding.shard(spark, read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens"
    )


def op2_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", bucket_of_id("doc_id", 5) == 0)
    labels = read(spark, sf_dir, "labels").select("doc_id", toxicity.severity_grades(F.col("toxic"), F.col("quality")).alias("grade"))
    model = toxicity.train(spark, toxicity.labelled(spark, docs.where(~F.col("held_out")), labels))
    scored = toxicity.predict(docs.select("doc_id", "held_out", "text"), model)
    # 0.4: by cross-validation within the training rows
    return scored.select("doc_id", "held_out", "severity", "grade", "score", (F.col("severity") >= 0.4).cast("int").alias("predicted"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(spark, read(spark, sf_dir, "documents"), minhash.Plan(words=3, numerator=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = bucket_of_id("doc_id", 3) == 1
    trees = langid.train(docs.where(~held_out).select("text", "lang"))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), trees).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


def op6_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", bucket_of_id("doc_id", 5) == 0)
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(bucket_of_id("doc_id", 5) != 0)
    featured = Workspace(spark, "op6").table(quality.vectors(docs.select("doc_id", "held_out", "text")).drop("text"), "features")
    model = quality.train(spark, featured.where(~F.col("held_out")), labels)
    scored = quality.score(featured, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict", "score", "words")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark, read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = decontam.flag(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return flagged.select("doc_id", (F.col("items") > 0).alias("contaminated"), "item_id", "coverage", "tiles", "items")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vector_sharding": op1_vector_sharding,
    "op2_toxicity_ordinal": op2_toxicity_ordinal,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language_id": op4_language_id,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_pu": op6_quality_pu,
    "op7_url_filter": op7_url_filter,
    "op8_exact_topk": op8_exact_topk,
    "op9_license_scan": op9_license_scan,
    "op10_decontamination": op10_decontamination,
}

#: Components by brute force over all pairs that share a shingle.
_NEAR_SQL = """
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
                               lambda x: x <> '') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM split),
each AS (SELECT doc_id, len(g) AS n, unnest(g) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least ON doc_id = x
"""

_TOP_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.row_no, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.row_no <> q.row_no AND len(c.e) = len(q.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""

ORACLE_SQL: dict[str, str] = {"op3_near_duplicates": _NEAR_SQL, "op8_exact_topk": _TOP_SQL}
