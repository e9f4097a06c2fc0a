"""Dataset and record enrichment, as DataFrame transforms chosen by rules."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions.text import clean_text, is_token_empty, last_segment, strip
from sievewright.registry import find, register
from sievewright.sources.html import profile, read_pages

BROKEN = "#REF!"


@register("enrich:dataset", "fix_vessel_rows")
def fix_vessel_rows(
    rows: DataFrame,
    name: str = "Vessel name at designation time",
    imo: str = "IMO number",
    date: str = "Date of application",
    link: str = "Link to relevant EU Official Journal ",
) -> DataFrame:
    """Trims four columns, drops rows without a name or IMO number, and empties broken references in date and link."""
    trimmed = rows.withColumns({c: strip(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in (name, imo, date, link)})
    held = trimmed.where((F.col(f"`{name}`") != "") & (F.col(f"`{imo}`") != ""))
    return held.withColumns({c: F.when(F.col(f"`{c}`") == BROKEN, "").otherwise(F.col(f"`{c}`")) for c in (date, link)})


@register("enrich:record", "attach_profiles")
def attach_profiles(
    rows: DataFrame,
    pages: DataFrame | None = None,
    images: DataFrame | None = None,
    url: str = "detail_url",
    profile_dir: str | None = None,
    images_dir: str | None = None,
    suffix: str = " _ Anti-Terrorism Council",
) -> DataFrame:
    """Left join of records to profile pages: the URL's last segment, with blanks for dashes and in upper case, then the suffix, is the page's file name.

    pages: path, content (HTML text), or a folder of .html files. images: path, or a folder; an image belongs to a name that its file name holds in any case. Of several pages of one name
    the one with the smallest path counts, so each record stays one. The result has profile_slug and profile_data (null without a page).
    """
    pages = read_pages(rows.sparkSession, f"{profile_dir}/*.html") if pages is None else pages
    if images is None and images_dir:
        images = rows.sparkSession.read.format("binaryFile").load(images_dir).select("path")
    slug = last_segment(F.col(url))
    named = rows.withColumn("profile_slug", slug).withColumn("profile_key_", F.upper(F.replace(slug, F.lit("-"), F.lit(" "))))
    name = _file_name("path")
    own = pages.where(name.endswith(suffix + ".html")).select(F.expr("*"), F.substring(name, F.lit(1), F.length(name) - len(suffix + ".html")).alias("profile_key_"))
    own = own.groupBy("profile_key_").agg(F.min(_plain("path")).alias("profile_file"), profile(F.min_by("content", "path")).alias("page"))
    joined = named.join(own, "profile_key_", "left")
    if images is None:
        joined = joined.withColumn("local_images", F.array().cast("array<string>"))
    else:
        joined = joined.join(_images_of(own.select("profile_key_"), images), "profile_key_", "left")
    local = F.coalesce("local_images", F.array().cast("array<string>"))
    data = F.struct("profile_file", "profile_slug", F.col("page.fields").alias("profile_fields"), F.col("page.images").alias("image_urls"), local.alias("local_images"))
    return joined.withColumn("profile_data", F.when(F.col("page").isNotNull(), data)).drop("profile_key_", "page", "profile_file", "local_images")


def _plain(path: str) -> Column:
    """A path without percent signs for blanks and the like."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), F.col(path))


def _file_name(path: str) -> Column:
    return F.element_at(F.split(_plain(path), "/"), -1)


def _images_of(keys: DataFrame, images: DataFrame) -> DataFrame:
    """profile_key_, local_images: paths of the images whose file names hold the key. Joined by the key's first letters, found at each place of a file name, so that no pair is looked at for nothing."""
    first = 4
    files = images.select(_plain("path").alias("path"), F.upper(_file_name("path")).alias("name"))
    places = F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.transform(F.sequence(F.lit(1), F.lit(first)), lambda n: F.substring(F.col("name"), i, n)))))
    seeded = files.where("name <> ''").select("path", "name", places.alias("seed")).distinct()
    held = keys.where("profile_key_ <> ''").withColumn("seed", F.substring("profile_key_", 1, first))
    return held.join(seeded, "seed").where(F.contains("name", "profile_key_")).groupBy("profile_key_").agg(F.array_sort(F.collect_set("path")).alias("local_images"))


def clean_profile_names(fields: Column, names: list[str]) -> Column:
    """A profile's fields with the named ones empty where they are absent or hold no value; null without a profile."""
    wanted = F.map_from_arrays(F.array(*map(F.lit, names)), F.transform(F.array(*map(F.lit, names)), lambda n: _cleaned(fields, n)))
    return F.when(fields.isNotNull(), F.map_concat(F.map_filter(fields, lambda k, _: ~k.isin(names)), wanted))


def _cleaned(fields: Column, name: Column) -> Column:
    value = F.coalesce(F.try_element_at(fields, name), F.lit(""))
    return F.when(is_token_empty(value), "").otherwise(clean_text(value))


#: The columns that a step reads, by its options, where records come as JSON text.
READS: dict[str, Callable[[dict], list[str]]] = {
    "fix_vessel_rows": lambda o: [o.get(k, d.default) for k, d in inspect.signature(fix_vessel_rows).parameters.items() if k != "rows"],
    "attach_profiles": lambda o: [o.get("url", "detail_url")],
}


def _steps(rules: list[dict], level: str, inputs: dict):
    for rule in rules:
        if rule.get("level", "record") == level:
            yield rule["handler"], find(f"enrich:{level}", rule["handler"]), {**rule.get("options", {}), **inputs.get(rule["handler"], {})}


def enrich(rows: DataFrame, rules: list[dict], level: str, **inputs) -> DataFrame:
    """Applies the rules of a level (dataset, or record by default) in their order; an unknown handler is a ValueError."""
    for _, step, options in _steps(rules, level, inputs):
        rows = rows.transform(step, **options)
    return rows


def _without(fields: Column, names: list[str]) -> Column:
    return F.map_filter(fields, lambda k, _: ~k.isin(names))


def enrich_json(records: DataFrame, rules: list[dict], level: str, **inputs) -> DataFrame:
    """The same for records as JSON text (record): what a step reads becomes columns, and its columns go back into the record; nulls are left out."""
    for name, step, options in _steps(rules, level, inputs):
        read = READS[name](options) if name in READS else []
        made = records.select("record", *(F.get_json_object("record", f"$['{c}']").alias(c) for c in read)).transform(step, **options)
        new = [c for c in made.columns if c != "record"]
        own = _without(F.try_variant_get(F.parse_json("record"), "$", "map<string,variant>"), new)
        added = F.try_variant_get(F.parse_json(F.to_json(F.struct(*(F.col(f"`{c}`") for c in new)))), "$", "map<string,variant>")
        records = made.select(F.to_json(F.map_concat(own, added)).alias("record"))
    return records
