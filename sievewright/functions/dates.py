"""Partial dates: {date_full, year, month, day}, all text, month and day of two digits or empty."""

from __future__ import annotations

import re
from datetime import datetime
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA = "array<struct<date_full:string,year:string,month:string,day:string>>"

_MONTHS = {m[: n or None]: k for k, m in enumerate("january february march april may june july august september october november december".split(), 1) for n in (3, 0)}

#: Tokens by falling priority: a later pattern never takes what an earlier one has matched. (Formats are fixed values.)
PATTERNS = [
    ("iso", r"\b(\d{4})-(\d{2})-(\d{2})(?:[T ]\d{2}:\d{2}(?::\d{2})?)?\b"),
    ("day_first", r"\b(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})\b"),
    ("month_first", r"\b([A-Za-z]+)\s+(\d{1,2}),(\s*)(\d{4})\b"),
    ("about", r"\b[Aa]pproximately\s+(\d{4})\b"),
    ("slashes", r"\b(\d{1,2})/(\d{1,2})/(\d{4})\b"),
    ("month_year", r"\b(\d{1,2})/(\d{4})\b"),
    ("two_years", r"\b(\d{4})\s*\((\d{4})\)\b"),
    ("year", r"\b(\d{4})\b"),
]
_COMPILED = [(kind, re.compile(p)) for kind, p in PATTERNS]


def _made(full, year, month="", day=""):
    return (full, str(year), f"{int(month):02d}" if month != "" else "", f"{int(day):02d}" if day != "" else "")


def _real(year, month, day) -> bool:
    try:
        datetime(int(year), int(month), int(day))
    except ValueError:
        return False
    return True


def token(kind: str, m: re.Match) -> list[tuple[str, str, str, str]]:
    """The dates of one matched token; none if it is not a real one."""
    g, full = m.groups(), m[0]
    if kind == "iso":
        return [_made(full, *g)] if _real(*g) else []
    if kind in ("day_first", "month_first"):
        day, name, year = (g[0], g[1], g[2]) if kind == "day_first" else (g[1], g[0], g[3])
        month = _MONTHS.get(name.lower())
        spaced = kind == "day_first" or g[2] != ""
        return [_made(full, year, month, day)] if month and spaced and _real(year, month, day) else []
    if kind == "slashes":
        return [_made(full, g[2], g[1], g[0])]
    if kind == "month_year":
        return [_made(full, g[1], g[0])]
    return [_made(y if kind == "two_years" else full, y) for y in g]


def parse(text) -> tuple[tuple[str, str, str, str], ...]:
    """All dates of a text in the order they stand, each (year, month, day) once."""
    return _parse(str(text)) if text else ()


@lru_cache(maxsize=1 << 16)
def _parse(text: str) -> tuple[tuple[str, str, str, str], ...]:
    text = " ".join(text.split())
    taken: list[tuple[int, int]] = []
    found = []
    for kind, pattern in _COMPILED:
        for m in pattern.finditer(text):
            if all(m.end() <= a or m.start() >= b for a, b in taken):
                taken.append(m.span())
                found.append((m.start(), token(kind, m)))
    out, seen = [], set()
    for _, dates in sorted(found, key=lambda f: f[0]):
        for d in dates:
            if d[1:] not in seen:
                seen.add(d[1:])
                out.append(d)
    return tuple(out)


def all_dates(x: Column) -> Column:
    """Every date of a text. Spans of several patterns exclude each other by priority, which no regular expression of the JVM's does."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(parse)

    return F.pandas_udf(run, SCHEMA)(x)


def date_token(x: Column) -> Column:
    """The parts of a text that is one token (null if it is none): no Python."""
    t = F.regexp_replace(F.trim(x), r"\s+", " ")

    def parts(full, year, month=None, day=None):
        pad = lambda c: F.lpad(c.cast("string"), 2, "0") if c is not None else F.lit("")
        return F.struct(full.alias("date_full"), year.cast("string").alias("year"), pad(month).alias("month"), pad(day).alias("day"))

    def by_format(pattern, *formats):
        d = F.coalesce(*(F.try_to_date(t, f) for f in formats))
        return F.when(t.rlike(pattern) & d.isNotNull(), parts(t, F.year(d), F.month(d), F.dayofmonth(d)))

    iso_day = F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2})?)?$") & iso_day.isNotNull(), parts(t, F.year(iso_day), F.month(iso_day), F.dayofmonth(iso_day)))
    part = lambda p, n: F.regexp_extract(t, p, n)
    slashes, month_year, about = r"^(\d{1,2})/(\d{1,2})/(\d{4})$", r"^(\d{1,2})/(\d{4})$", r"^(?:[Aa]pproximately )?(\d{4})$"
    return F.coalesce(
        iso,
        by_format(r"^\d{1,2} ([A-Za-z]{3}|[A-Za-z]{5,}|June|July) \d{4}$", "d MMMM yyyy", "d MMM yyyy"),
        by_format(r"^([A-Za-z]{3}|[A-Za-z]{5,}|June|July) \d{1,2}, \d{4}$", "MMMM d, yyyy", "MMM d, yyyy"),
        F.when(t.rlike(slashes), parts(t, part(slashes, 3), part(slashes, 2), part(slashes, 1))),
        F.when(t.rlike(month_year), parts(t, part(month_year, 2), part(month_year, 1))),
        F.when(t.rlike(about), parts(t, part(about, 1))),
    )
