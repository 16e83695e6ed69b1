"""Canonical keys of acts and citations, so that the ends of an edge meet however
they were typed. Each comes as a column and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_key(name: Column) -> Column:
    """Lower-case words without signs, digits and a leading article; null if none."""
    words = F.trim(F.regexp_replace(F.lower(name), "[^a-z]+", " "))
    return F.nullif(F.regexp_replace(words, "^the ", ""), F.lit(""))


def act_key(name: Column) -> Column:
    """As :func:`plain_key`, without bracketed parts and years: acts are named with
    and without them; "Adhiniyam" stands for "Act"."""
    return F.regexp_replace(plain_key(F.regexp_replace(name, "\\([^)]*\\)", " ")), " adhiniyam$", " act")


def citation_key(text: Column) -> Column:
    """reporter|court|numbers: however dotted, spaced, bracketed or spelled out; the
    court by its first three letters; null without a reporter or number."""
    low = F.lower(text)
    words = F.regexp_replace(F.regexp_replace(low, "\\b(vol|volume|page|pp|p|para)\\b", " "), "[^a-z]", "")
    words = F.replace(F.replace(words, F.lit("allindiareporter"), F.lit("air")), F.lit("supremecourtcases"), F.lit("scc"))
    reporter = F.nullif(F.regexp_extract(words, "(scconline|scc|air)", 1), F.lit(""))
    court = F.substring(F.regexp_replace(words, "(scconline|scc|air)", ""), 1, 3)
    numbers = F.nullif(F.array_join(F.regexp_extract_all(low, F.lit("([0-9]+)"), F.lit(1)), "|"), F.lit(""))
    return F.concat(reporter, F.lit("|"), court, F.lit("|"), numbers)


def plain_sql(x: str) -> str:
    return f"nullif(regexp_replace(trim(regexp_replace(lower({x}), '[^a-z]+', ' ', 'g')), '^the ', ''), '')"


def act_sql(x: str) -> str:
    bare = f"regexp_replace({x}, '\\([^)]*\\)', ' ', 'g')"
    return f"regexp_replace({plain_sql(bare)}, ' adhiniyam$', ' act')"


def citation_sql(x: str) -> str:
    words = f"regexp_replace(regexp_replace(lower({x}), '\\b(vol|volume|page|pp|p|para)\\b', ' ', 'g'), '[^a-z]', '', 'g')"
    words = f"replace(replace({words}, 'allindiareporter', 'air'), 'supremecourtcases', 'scc')"
    return (
        f"(nullif(regexp_extract({words}, '(scconline|scc|air)', 1), '') || '|' || substr(regexp_replace({words}, '(scconline|scc|air)', '', 'g'), 1, 3)"
        f" || '|' || nullif(array_to_string(regexp_extract_all(lower({x}), '[0-9]+'), '|'), ''))"
    )
