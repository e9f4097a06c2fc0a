"""The list pipeline: read, enrich, preprocess, pre-normalise, map, post-normalise, stage; a chain of DataFrame transforms."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.config import Source
from sievewright.functions import text
from sievewright.operators import enrich, staging
from sievewright.plans import mapping, postnorm, prenorm
from sievewright.registry import find, register
from sievewright.sources import html, jsonl, pdf, tabular, xml


def read(spark: SparkSession, path: str, source: Source, extractor=None, **inputs) -> DataFrame:
    """record (JSON text) of a source's file by its type, enriched; another type, or suffix of a table, is a ValueError.

    inputs: further arguments of enrichment steps, by their names.
    """
    if source.file_type == "xml":
        records = xml.read(spark, path, source.root_tag)
    elif source.file_type == "jsonl":
        records = jsonl.read(spark, path).select("record")
    elif source.file_type == "pdf":
        if extractor is None:
            raise ValueError("a PDF source needs an extractor")
        records = pdf.read(spark, path, extractor).select(F.to_json("record", {"ignoreNullFields": "false"}).alias("record"))
    else:
        return enriched(table(spark, path, source), source, **inputs).select(jsonl.line("*").alias("record"))
    rules = list(source.enrich)
    return enrich.enrich_json(enrich.enrich_json(records, rules, "dataset", **inputs), rules, "record", **inputs)


def table(spark: SparkSession, path: str, source: Source) -> DataFrame:
    """A tabular or HTML source's columns."""
    if source.file_type == "html":
        return html.read(spark, path, source.name)
    if source.file_type in ("csv", "xlsx"):
        suffix = PurePosixPath(path).suffix.lower()
        if suffix not in (".csv", ".xlsx"):
            raise ValueError(f"unsupported suffix {suffix!r}")
        return tabular.read_csv(spark, path) if suffix == ".csv" else tabular.read_xlsx(spark, path, source.sheet)
    raise ValueError(f"unsupported file type {source.file_type!r}")


def enriched(rows: DataFrame, source: Source, **inputs) -> DataFrame:
    return enrich.enrich(enrich.enrich(rows, list(source.enrich), "dataset", **inputs), list(source.enrich), "record", **inputs)


# Preprocessing: each step adds or rewrites top-level columns of a VARIANT record's fields


def _field(path: str) -> Column:
    return F.get_json_object("record", "$" + "".join(f"['{p}']" for p in path.split(".")))


@register("preprocess", "detect_entity_type")
def _entity_type(options: dict) -> dict[str, Column]:
    return {options["output_field"]: text.entity_type_of_name(_field(options["input_field"]))}


@register("preprocess", "generate_unique_id")
def _unique_id(options: dict) -> dict[str, Column]:
    made = text.resolution_id(options.get("prefix", "ID"), _field(options.get("resolution_field", "atc_resolution_no")), _field(options.get("name_field", "name")))
    return {options.get("output_field", "unique_id"): made}


@register("preprocess", "extract_name_from_url")
def _name_from_url(options: dict) -> dict[str, Column]:
    return {options["output_field"]: text.name_from_url(_field(options["input_field"]))}


@register("preprocess", "split_date_and_place")
def _date_and_place(options: dict) -> dict[str, Column]:
    date, place = text.date_and_place(_field(options["input_field"]))
    return {options["date_field"]: date, options["place_field"]: place}


@register("preprocess", "clean_profile_names")
def _profile_names(options: dict) -> dict[str, Column]:
    fields = F.from_json(F.get_json_object("record", "$.profile_data.profile_fields"), "map<string,string>")
    return {options.get("output_field", "profile_fields"): F.to_json(enrich.clean_profile_names(fields, options["fields"]))}


def preprocess(records: DataFrame, steps) -> DataFrame:
    """Adds each step's fields to the records (JSON text), in order; an unknown step is a ValueError."""
    for step in steps:
        fields = find("preprocess", step["handler"])(step)
        added = F.struct(*(c.alias(name) for name, c in fields.items()))
        # objects are joined as maps of variants: fields of the record stay as they are, whatever their shape
        own = F.try_variant_get(F.parse_json("record"), "$", "map<string,variant>")
        new = F.try_variant_get(F.parse_json(F.to_json(added, {"ignoreNullFields": "false"})), "$", "map<string,variant>")
        kept = _without(own, tuple(fields))
        records = records.withColumn("record", F.to_json(F.map_concat(kept, new)))
    return records


def _without(own: Column, names: tuple[str, ...]) -> Column:
    return F.map_filter(own, lambda k, _: ~k.isin(*names))


@dataclass(frozen=True)
class Rules:
    mapping: list[mapping.Rule]
    prenorm: prenorm.Plan | None = None
    postnorm: tuple[postnorm.Rule, ...] = ()


def standardise(records: DataFrame, source: Source, rules: Rules) -> DataFrame:
    """record (as preprocessed), external_id, mapped_type, final (JSON text) of every record; the id is taken after preprocessing."""
    made = preprocess(records, source.preprocess)
    identifier = _field(source.external_id) if source.external_id else F.lit(None).cast("string")
    made = made.withColumn("external_id", identifier)
    normal = prenorm.pre_normalize(F.col("record"), rules.prenorm) if rules.prenorm else F.col("record")
    mapped = mapping.map_records(made.withColumn("v", F.parse_json(normal)), rules.mapping)
    final = postnorm.post_normalize(F.col("mapped"), list(rules.postnorm)) if rules.postnorm else F.col("mapped")
    return mapped.withColumn("final", final).select("record", "external_id", "mapped_type", "final")


def run(spark: SparkSession, path: str, source: Source, rules: Rules, lookups: dict[str, DataFrame], out: str, extractor=None, **inputs) -> dict[str, int]:
    """Writes manifest, payloads, staging rows and final records under a folder; returns the numbers of records read and staged."""
    manifest = staging.manifest(spark, path, source.authority, lookups["sources"], lookups["list_types"], source.url)
    manifest.write.mode("overwrite").parquet(f"{out}/watchlist_file")
    file = spark.read.parquet(f"{out}/watchlist_file").select("id", "source_id", "list_type_id").orderBy("id").first().asDict()
    staging.payloads(read(spark, path, source, extractor, **inputs), F.lit(file["id"])).write.mode("overwrite").parquet(f"{out}/payload")
    records = spark.read.parquet(f"{out}/payload").select(F.col("raw_json").alias("record"))
    done = standardise(records, source, rules).select("external_id", F.col("final").alias("record"))
    staging.staged(done, lookups["entity_types"], file).write.mode("overwrite").parquet(f"{out}/staging")
    staged = spark.read.parquet(f"{out}/staging")
    jsonl.write(staged.select(F.col("full_payload").alias("record")), f"{out}/{source.name}_final.jsonl")
    return {"raw": records.count(), "staged": staged.count()}
