"""Raw and staging tables: file manifest, payloads, lookups, hashes, validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VALID_TO = "2050-01-01"
VERSION, STATUS = "1.0.0", "Downloaded"


def record_hash(json: Column) -> Column:
    """SHA-256 of a record's JSON text with sorted keys (VARIANT keeps them sorted), the same whatever the order of its keys was."""
    return F.sha2(F.to_json(F.parse_json(json)), 256)


def required(value: Column, what: Column) -> Column:
    """The value; a missing one fails the query with a message."""
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit("no match for "), F.coalesce(what, F.lit("null")))))


def list_type_of_source(list_types: DataFrame) -> DataFrame:
    """source_id, list_type_id: the smallest id of each source."""
    return list_types.groupBy("source_id").agg(F.min("id").alias("list_type_id"))


def manifest(spark: SparkSession, path: str, authority: str, sources: DataFrame, list_types: DataFrame, url: str | None = None) -> DataFrame:
    """One row per file: hash, size, source and list type ids; an unknown authority fails."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("storage_path"),
        F.element_at(F.split("path", r"\."), -1).alias("file_type"),
        F.col("length").alias("file_size"),
        F.sha2("content", 256).alias("file_hash"),
        F.lit(authority).alias("authority"),
    )
    own = sources.select(F.col("id").alias("source_id"), "authority")
    joined = files.join(own, "authority", "left").join(list_type_of_source(list_types), "source_id", "left")
    return joined.select(
        F.xxhash64("file_hash", "storage_path").alias("id"),
        required(F.col("source_id"), F.col("authority")).alias("source_id"),
        required(F.col("list_type_id"), F.col("authority")).alias("list_type_id"),
        F.lit(url).alias("source_url"),
        "storage_path",
        "file_type",
        "file_size",
        "file_hash",
        F.lit(VERSION).alias("version"),
        F.current_timestamp().alias("downloaded_at"),
        F.lit(STATUS).alias("status"),
    )


def payloads(records: DataFrame, file_id: Column, column: str = "record") -> DataFrame:
    return records.select(file_id.alias("file_id"), F.col(column).alias("raw_json"))


def staged(records: DataFrame, entity_types: DataFrame, file: dict | None = None, column: str = "record") -> DataFrame:
    """Staging rows of final records (JSON text, external_id); the entity type is looked up by its upper-cased name and must exist."""
    named = records.withColumn("entity_type", F.get_json_object(column, "$.entity_type"))
    own = entity_types.select(F.col("id").alias("entity_type_id"), F.col("name").alias("type_name"))
    ids = file or {}
    return named.join(own, F.upper("entity_type") == F.col("type_name"), "left").select(
        F.lit(ids.get("id")).cast("long").alias("raw_file_id"),
        F.lit(ids.get("source_id")).cast("long").alias("source_id"),
        F.lit(ids.get("list_type_id")).cast("long").alias("list_type_id"),
        F.col("external_id"),
        required(F.col("entity_type_id"), F.col("entity_type")).alias("entity_type_id"),
        record_hash(F.col(column)).alias("record_hash"),
        F.current_timestamp().alias("valid_from"),
        F.lit(VALID_TO).cast("date").alias("valid_to"),
        F.lit("None").alias("extracted_name"),
        F.col(column).alias("full_payload"),
        F.current_timestamp().alias("created_at"),
    )


def jdbc_options(env: dict[str, str]) -> dict[str, str]:
    """Options of Spark's JDBC writer from DB_URL, DB_USER, DB_PASSWORD and, for the number of writers, DB_POOL_MAX (10)."""
    missing = [k for k in ("DB_URL", "DB_USER", "DB_PASSWORD") if not env.get(k)]
    if missing:
        raise ValueError(f"unset: {', '.join(missing)}")
    return {"url": env["DB_URL"], "user": env["DB_USER"], "password": env["DB_PASSWORD"], "numPartitions": env.get("DB_POOL_MAX", "10")}
