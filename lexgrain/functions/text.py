"""Text expressions on columns; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Runs of ASCII letters and digits of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4)


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def non_ascii_ratio(text: Column) -> Column:
    n = F.length(text)
    return F.when(n > 0, (n - F.length(F.regexp_replace(text, "[^\\x00-\\x7F]", ""))) / n).otherwise(F.lit(0.0))


def letters_ratio(text: Column) -> Column:
    n = F.length(text)
    return F.when(n > 0, F.length(F.regexp_replace(text, "[^A-Za-z]", "")) / n).otherwise(F.lit(0.0))


def any_date(text: Column) -> Column:
    """The first of five notations that fits, else null."""
    formats = ["yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy", "d MMMM, yyyy", "d MMMM yyyy"]
    return F.coalesce(*[F.try_to_timestamp(F.trim(text), F.lit(f)).cast("date") for f in formats])


def last_segment(url: Column) -> Column:
    """Document id of an address: its last path segment."""
    return F.nullif(F.regexp_extract(F.regexp_replace(url, "/+$", ""), "([^/]+)$", 1), F.lit(""))


def first_match(text: Column, pairs: list[tuple[str, str]], default: str) -> Column:
    """Label of the first pattern that is found in the text."""
    out = None
    for pattern, label in pairs:
        c = text.rlike(pattern)
        out = F.when(c, label) if out is None else out.when(c, label)
    return out.otherwise(default)


def signals(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """Labels of all patterns that are found, in the order of the list."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(label)) for p, label in pairs]))
