"""Pure functions under SQL names, and citations with their places as a table function."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from lexgrain.functions.legal import FAMILIES

#: SQL functions of one text; the same as the column functions of these names
SQL = {
    "lex_plain_key": ("STRING", "nullif(regexp_replace(trim(regexp_replace(lower(x), '[^a-z]+', ' ')), '^the ', ''), '')"),
    "lex_act_key": ("STRING", r"regexp_replace(nullif(regexp_replace(trim(regexp_replace(lower(regexp_replace(x, '\\([^)]*\\)', ' ')), '[^a-z]+', ' ')), '^the ', ''), ''), ' adhiniyam$', ' act')"),
    "lex_tokens": ("ARRAY<STRING>", "regexp_extract_all(lower(x), '([a-z0-9]+)', 1)"),
    "lex_token_estimate": ("BIGINT", "length(x) div 4"),
    "lex_sigmoid": ("DOUBLE", "1 / (1 + exp(-cast(x AS DOUBLE)))"),
    "lex_fenced_json": ("STRING", r"trim(regexp_replace(regexp_replace(x, '(?s)^\\s*```[a-zA-Z]*\\s*', ''), '(?s)\\s*```\\s*$', ''))"),
}


def spans(text: str | None) -> list[tuple[str, str, int, int]]:
    """(family, citation, start, end) in order of place; a span counts once, a circular
    within an earlier span not at all."""
    taken: dict[tuple[int, int], str] = {}
    for family, form in FAMILIES.items():
        for m in re.finditer(form, text or ""):
            if family != "circular" or not any(a <= m.start() < e for a, e in taken):
                taken.setdefault(m.span(), family)
    return [(k, text[a:e], a, e) for (a, e), k in sorted(taken.items())]


@udtf(returnType="family string, citation string, start int, end int")
class Citations:
    """``SELECT * FROM documents, LATERAL lex_citations(text)``"""

    def eval(self, text: str) -> Iterator[tuple[str, str, int, int]]:
        yield from spans(text)


def register(spark: SparkSession) -> list[str]:
    """Make all of them known to a session's SQL; gives their names."""
    for name, (kind, body) in SQL.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {kind} RETURN {body}")
    spark.udtf.register("lex_citations", Citations)
    return [*SQL, "lex_citations"]
