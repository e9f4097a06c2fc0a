"""Scheduled ingestion of a landing folder: each run takes the files that came since the last one, and a file's content once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FILE = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, folder: str) -> DataFrame:
    """file_hash, path, length, content of files, as a stream without repeated contents."""
    files = spark.readStream.format("binaryFile").schema(_FILE).load(folder)
    return files.select(F.sha2("content", 256).alias("file_hash"), "path", "length", "content").dropDuplicates(["file_hash"])


def ingest(spark: SparkSession, folder: str, out: str, state: str) -> int:
    """Appends the new files' rows as Parquet and ends; returns how many rows the table has."""
    query = new_files(spark, folder).writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(out).count()
