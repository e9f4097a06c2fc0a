"""Scalar text functions as Columns: cleaning, enums, identifiers, name and place heuristics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that count as no value (fixed values).
EMPTY_TOKENS = ["", "N/A", "NA", "NONE", "NULL", "UNKNOWN", "-"]

#: Words whose presence, as a substring of the upper-cased name, marks an organisation (fixed values).
ORGANISATION_WORDS = [
    "INC", "CORP", "COMPANY", "CO.", "LLC", "LTD", "OPC", "SERVICES", "FIRM", "OFFICE", "ASSOCIATES", "PARTNERS", "CPA", "CPAS", "ACCOUNTING",
    "BOOKKEEPING", "AUDITING", "CONSULTANCY", "BUSINESS", "GROUP", "TRADING", "STORE", "SHOP", "REALTY", "BROKERAGE",
]

_TITLES = "(?i)^(mr|mrs|ms|dr|prof|sir|atty|engr|hon)\\.?$"
_SUFFIXES = "(?i)^(jr|sr|ii|iii|iv|phd|md|esq)\\.?$"


def strip(x: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def clean_text(x: Column) -> Column:
    """White space runs become one blank, ends are cut; null becomes empty."""
    return F.coalesce(strip(F.regexp_replace(x, r"(?U)\s+", " ")), F.lit(""))


def is_token_empty(x: Column) -> Column:
    return F.upper(strip(F.coalesce(x, F.lit("")))).isin(EMPTY_TOKENS)


def parse_enum(spec: str) -> dict[str, str]:
    """`a=b|c=d`: the first equals sign splits, parts without one are ignored, later keys win."""
    return {k.strip(): v.strip() for k, eq, v in (part.partition("=") for part in spec.split("|")) if eq}


def enum_map(x: Column, spec: str) -> Column:
    """The mapped value of the trimmed text; the text itself where there is none."""
    known = parse_enum(spec)
    if not known:
        return x
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(t) for kv in known.items() for t in kv)), strip(x)), x)


def remove_list_markers(x: Column) -> Column:
    """Without `(a)` style markers and the blanks after them."""
    return strip(F.regexp_replace(x, r"\([A-Za-z]\)\s*", ""))


def before_parenthesis(x: Column) -> Column:
    """What stands before the first parenthesis, without colons."""
    return strip(F.replace(F.substring_index(x, "(", 1), F.lit(":"), F.lit("")))


def cell(x: Column) -> Column:
    """A table cell: line breaks become blanks, ends are cut; null stays null."""
    return strip(F.replace(x, F.lit("\n"), F.lit(" ")))


def header(x: Column) -> Column:
    """A table header: like a cell, without dots; blank becomes null."""
    return F.nullif(strip(F.replace(F.replace(x, F.lit("\n"), F.lit(" ")), F.lit("."), F.lit(""))), F.lit(""))


def name_from_url(url: Column) -> Column:
    """The last segment of a URL's path, percent-decoded; blank for a blank URL."""
    path = F.coalesce(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("")), F.regexp_extract(url, r"^([^?#]*)", 1))
    last = F.element_at(F.split(F.regexp_replace(path, "^/+|/+$", ""), "/"), -1)
    decoded = F.coalesce(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), last)
    return F.when(strip(F.coalesce(url, F.lit(""))) == "", "").otherwise(strip(decoded))


def last_segment(url: Column) -> Column:
    """What follows the last slash that is not at the end; the query stays."""
    return F.element_at(F.split(F.regexp_replace(strip(url), "/+$", ""), "/"), -1)


def resolution_id(prefix: str, resolution: Column, name: Column) -> Column:
    """`prefix-number-hash`: the first resolution number or UNKNOWN, and ten digits of the lower-cased name's MD5."""
    number = F.regexp_extract(F.coalesce(resolution, F.lit("")), r"(?i)Resolution\s+No\.?\s*(\d+)", 1)
    digest = F.substring(F.md5(F.lower(strip(F.coalesce(name, F.lit("")))).cast("binary")), 1, 10)
    return F.concat_ws("-", F.lit(prefix), F.when(number == "", "UNKNOWN").otherwise(number), digest)


def has_organisation_word(name: Column, words: list[str] = ORGANISATION_WORDS) -> Column:
    upper = F.upper(strip(F.coalesce(name, F.lit(""))))
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(upper, w))


def is_person_name(name: Column) -> Column:
    """A first and a last name are left once titles and suffixes are gone; `Last, First` counts too. A heuristic."""
    parts = F.filter(F.split(strip(F.coalesce(name, F.lit(""))), r"[\s,]+"), lambda w: (w != "") & ~w.rlike(_TITLES) & ~w.rlike(_SUFFIXES))
    return (F.size(parts) >= 2) & F.forall(parts, lambda w: w.rlike(r"^(?U)[\p{L}'.’-]+$"))


def entity_type_of_name(name: Column) -> Column:
    return F.when(has_organisation_word(name), "Organization").when(is_person_name(name), "Individual").otherwise("Organization")


def date_and_place(x: Column) -> tuple[Column, Column]:
    """(date, place) of `date, place`: split at the first comma, if the first part is a date or no value."""
    text = strip(F.coalesce(x, F.lit("")))
    parts = F.split(text, ",", 2)
    first, rest = strip(parts[0]), F.coalesce(strip(F.get(parts, F.lit(1))), F.lit(""))
    empty, dated = is_token_empty(text), first.rlike(r"\d")
    date = F.when(empty | is_token_empty(first) | ~dated, "").otherwise(first)
    place = F.when(empty, "").when(is_token_empty(first) | dated, rest).otherwise(text)
    return date, place


def canonical_type(kind: Column, vessel: Column) -> Column:
    """Individual, Organization or Vessel of a source's type text; `vessel`: the row has vessel data."""
    k = F.lower(strip(F.coalesce(kind, F.lit(""))))
    return (
        F.when(k.isin("individual", "person"), "Individual")
        .when(k.isin("entity", "organization", "organisation"), "Organization")
        .when((k == "vessel") | F.coalesce(vessel, F.lit(False)), "Vessel")
        .otherwise("Individual")
    )
