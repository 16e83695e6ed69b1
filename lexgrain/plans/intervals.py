"""Queries on validity intervals."""

from pyspark.sql import functions as F

from lexgrain.operators.intervals import periods_and_gaps
from lexgrain.session import load


def p3_found(spark, sf):
    out = periods_and_gaps(load(spark, sf, "section_versions"), ["act_id", "section_number"], "effective_from", "effective_until")
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    return out.select("act_id", "section_number", "kind", day("lo").alias("starts"), day("hi").alias("ends"))


P3_SQL = """
WITH v AS (SELECT DISTINCT act_id, section_number, effective_from AS lo, coalesce(effective_until, DATE '9999-12-31') AS hi
           FROM section_versions WHERE effective_from IS NOT NULL AND (effective_until IS NULL OR effective_until > effective_from)),
m AS (SELECT *, max(hi) OVER (PARTITION BY act_id, section_number ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM v),
i AS (SELECT *, sum(CASE WHEN far >= lo THEN 0 ELSE 1 END) OVER (PARTITION BY act_id, section_number ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS isle FROM m),
p AS (SELECT act_id, section_number, min(lo) AS lo, max(hi) AS hi FROM i GROUP BY act_id, section_number, isle),
g AS (SELECT *, lead(lo) OVER (PARTITION BY act_id, section_number ORDER BY lo) AS nxt FROM p)
SELECT act_id, section_number, 'period' AS kind, strftime(lo, '%Y-%m-%d') AS starts,
       CASE WHEN hi = DATE '9999-12-31' THEN '' ELSE strftime(hi, '%Y-%m-%d') END AS ends FROM p
UNION ALL
SELECT act_id, section_number, 'gap', strftime(hi, '%Y-%m-%d'), strftime(nxt, '%Y-%m-%d') FROM g WHERE nxt IS NOT NULL
"""

QUERIES = {"p3_found": (p3_found, P3_SQL)}
