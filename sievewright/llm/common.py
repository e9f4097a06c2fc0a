"""Shared helpers: written intermediate tables and text tokenisers."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.sources import scan

#: Bytes that end a word of the license contract: all ASCII but 0-9 and a-z, after lower-casing A-Z.
_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)) + b" " * 128
_LETTER_RUN = re.compile(r"[^\W\d_]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, local mode gets a new local folder and a cluster an error."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (where or _own_dir()).rstrip("/")


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="sievewright-")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a written table through Spark's file systems."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Workspace:
    """Intermediate tables of one query, written as Parquet in the shared folder.

    A written table cuts lineage and survives lost executors. drop() deletes a table that is no longer
    read, and close() all of them; what a returned lazy DataFrame still reads stays until the Python process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/sievewright-{name}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        self.made = 0
        atexit.register(self.close)

    def table(self, df: DataFrame, label: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{label}-{self.made}"
        df.write.parquet(path)
        self.paths[label] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            if path := self.paths.pop(label, None):
                remove(self.spark, path)

    def close(self) -> None:
        atexit.unregister(self.close)
        try:
            remove(self.spark, self.root)
        except Exception:  # noqa: BLE001  the session may have ended before the process does
            pass


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return scan.parquet(spark, f"{sf_dir}/{table}.parquet")


def among(rows: DataFrame, key: str, keys: DataFrame, bits: int = 25) -> DataFrame:
    """The rows whose key (long) may be one of keys' first column: all that are, and some others. Saves a shuffle of the rows that are surely not.

    The keys' hashes set bits of a map of 2^bits bits, which is broadcast as at most 2^(bits - 6) rows of 16 bytes, however many keys there are.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    word = lambda c: F.shiftright(slot(c), 6)
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot(c), F.lit(64)).cast("int"))
    own = keys.columns[0]
    held = keys.select(word(own).alias("word_"), bit(own).alias("bit_")).groupBy("word_").agg(F.bit_or("bit_").alias("bits_"))
    found = rows.withColumn("word_", word(key)).join(F.broadcast(held), "word_")
    return found.where(F.col("bits_").bitwiseAND(bit(key)) != 0).select(*(F.col(f"`{c}`") for c in rows.columns))


def sample_by_hash(docs: DataFrame, kind: str, most: int, literal: int = 1000) -> DataFrame:
    """text and kind of about `most` distinct texts of each value of `kind` (all, where there are fewer), chosen by their hashes; nulls take no part.

    Their number is estimated to within a few percent, so no kind's texts need to meet in one task. Each kind's share of hashes is a literal
    where there are at most `literal` kinds, so that no text moves before it is chosen; else it is joined.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col(kind).isNotNull()).select(F.col("text").cast("string").alias("text"), kind, F.xxhash64("text").alias("h"))
    share = rows.groupBy(kind).agg((F.lit(1.05 * most) / F.approx_count_distinct("h")).alias("share"))
    few = share.limit(literal + 1).collect()
    if not few:
        return rows.select("text", kind).limit(0)
    if len(few) <= literal:
        of_kind = F.create_map(*(F.lit(x) for r in few for x in r))
        rows = rows.withColumn("share", F.try_element_at(of_kind, F.col(kind)))
    else:
        rows = rows.join(share, kind)
    chosen = rows.where(F.pmod("h", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    return chosen.groupBy(kind, "h").agg(F.min("text").alias("text")).select("text", kind)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """text and label of about `most` distinct texts of each label; docs: doc_id, text; labels: doc_id, label (the highest counts).

    Labels are chosen by a hash of their id first, about 2 * most of each, and sent to the documents: no other text moves.
    """
    of_id = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("doc_id"))
    counts = {r["label"]: r["count"] for r in of_id.groupBy("label").count().collect()}
    if not counts:
        return docs.select(F.col("text").cast("string").alias("text"), F.lit(None).cast("int").alias("label")).limit(0)
    share = F.try_element_at(F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, 2.0 * most / n))), F.col("label"))
    ids = of_id.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).select("doc_id", "label")
    return sample_by_hash(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "label", most)


def bucket_of_id(column: str, modulus: int):
    """crc32 of the id's decimal text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def plain_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a text with A-Z lower-cased, as UTF-8."""
    return (text or "").encode().translate(_LOWER).split()


def alnum_words(text: str | None) -> list[bytes]:
    """Words of 0-9, a-z and all non-ASCII characters, with A-Z lower-cased, as UTF-8."""
    return (text or "").encode().translate(_ALNUM).split()


def letter_words(text: str | None) -> list[str]:
    """Runs of letters of any script, lower-cased."""
    if not isinstance(text, str):
        return []
    return text.encode().translate(_LETTERS).decode().split() if text.isascii() else _LETTER_RUN.findall(text.lower())
