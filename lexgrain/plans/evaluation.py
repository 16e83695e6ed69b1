"""Evaluation over a fixed small set of test queries with the results of a run.

The rows stand for what the test-set source and the score sheets hold
(:mod:`lexgrain.sources.tables`); the oracle computes the same from the same rows.
"""

from pyspark.sql import functions as F

from lexgrain.functions import legal as L
from lexgrain.operators import evaluation as E

COLUMNS = {
    "query_id": "VARCHAR", "query_type": "VARCHAR", "response": "VARCHAR", "contexts": "VARCHAR[]", "expected_sections": "VARCHAR[]", "cross_reference": "BOOLEAN", "expected_route": "VARCHAR", "route": "VARCHAR",
    "elapsed_ms": "DOUBLE", "cache_hit": "BOOLEAN", "total_claims": "INTEGER", "supported_claims": "INTEGER", "with_parent": "BOOLEAN", "further": "INTEGER",
    "context_recall": "DOUBLE", "context_precision": "DOUBLE", "faithfulness": "DOUBLE", "answer_relevancy": "DOUBLE",
}
NAN = float("nan")
ROWS = [
    ("t01", "lookup", "Section 302 of the Indian Penal Code punishes murder.", ["The text of section 302 of the code"], ["302"], False, "simple", "simple", 150.0, False, 1, 1, True, 0, 1.0, 0.9, 1.0, 0.9),
    ("t02", "lookup", "Section 420 IPC was repealed; see the Bharatiya Nyaya Sanhita. (2019) 5 SCC 123 applies.", ["as held in (2019) 5 SCC 123 on cheating"], ["420", "318"], True, "simple", "standard", 200.0, True, 4, 3, False, 1, 0.8, None, 0.7, 0.9),
    ("t03", "temporal", "Section 438 of the Code of Criminal Procedure gave anticipatory bail.", ["no context names it"], [], False, "standard", "standard", 801.0, False, 0, 0, True, 0, 0.9, 0.8, NAN, 1.0),
    ("t04", "comparison", "Section 25 of the Indian Evidence Act bars confessions. AIR 1978 SC 597 was followed.", ["air 1978 sc 597", "Section 25"], ["25", "23A"], True, "analytical", "", 5000.0, None, None, None, False, 3, 0.95, 0.9, 0.96, 0.8),
    ("t05", "lookup", "No provision is cited here.", [], ["12"], False, "", None, 700.0, False, 2, 0, True, 0, 0.5, 0.4, 0.6, 0.7),
    ("t06", "lookup", None, None, None, True, "complex", "complex", 2500.0, True, 0, 0, None, None, None, None, None, None),
    ("t07", "complex", "Article 21 and Section 12A read with Section 300. G.S.R. 12 (E)", ["article 21 of the constitution; 12A"], ["12A", "300"], True, "complex", "complex", 1999.5, False, 3, 3, True, 2, 1.0, 1.0, 1.0, 1.0),
    ("t08", "lookup", "section 5 of IPC, sec. 6 of the Evidence Act and S. 7 CrPC remain", ["5 and 6"], ["5", "6", "7"], False, "standard", "fast", 640.0, False, 5, 5, True, 0, 0.85, 0.9, 0.99, 0.9),
]
SHEETS = [("t01", "a", 5, 4, 3, 5), ("t02", "a", 3, 3, 2, 4), ("t03", "b", 4, 5, 5, 4), ("t04", "b", 2, 2, 1, 3), ("t07", "a", 5, 5, 5, 5)]


def _inputs(spark):
    kinds = {"VARCHAR": "string", "VARCHAR[]": "array<string>", "BOOLEAN": "boolean", "DOUBLE": "double", "INTEGER": "int"}
    return spark.createDataFrame(ROWS, ", ".join(f"{c} {kinds[t]}" for c, t in COLUMNS.items()))


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _long(df):
    return df.select(*[F.col(c).cast("bigint").alias(c) if t == "int" else c for c, t in df.dtypes])


def citation_accuracy_run(spark, sf):
    return _long(_rounded(E.citation_accuracy(_inputs(spark)), "accuracy"))


def temporal_accuracy(spark, sf):
    return _long(_rounded(E.temporal_accuracy(_inputs(spark)), "accuracy"))


def section_completeness_run(spark, sf):
    return _long(_rounded(E.sections_retrieved(_inputs(spark)), "score"))


def cross_reference_resolution(spark, sf):
    return _long(_rounded(E.sections_retrieved(_inputs(spark), F.col("cross_reference")), "score"))


def latency_check(spark, sf):
    return E.latency(_inputs(spark))


def latency_per_route(spark, sf):
    g = E.latency(_inputs(spark)).groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.avg("elapsed_ms").alias("mean"), F.avg(F.col("passed").cast("double")).alias("pass_rate"))
    return _rounded(g, "mean", "pass_rate")


def qi_metrics(spark, sf):
    q = E.query_ratios(_inputs(spark))
    return _rounded(q, *q.columns)


JUDGED = ["context_recall", "context_precision", "faithfulness", "answer_relevancy"]


def judge_means(spark, sf):
    return _rounded(E.means(_inputs(spark), JUDGED), *JUDGED)


def human_eval_agg(spark, sf):
    h = E.human_means(spark.createDataFrame(SHEETS, "query_id string, evaluator_id string, accuracy int, completeness int, recency int, usefulness int"))
    return _rounded(h, "accuracy", "completeness", "recency", "usefulness", "pass_rate")


def _legal_means(spark):
    i = _inputs(spark)
    a = E.citation_accuracy(i).agg(F.avg("accuracy").alias("citation_accuracy")).crossJoin(E.temporal_accuracy(i).agg(F.avg("accuracy").alias("temporal_accuracy")))
    s = E.sections_retrieved(i).agg(F.avg("score").alias("section_completeness")).crossJoin(E.sections_retrieved(i, F.col("cross_reference")).agg(F.avg("score").alias("cross_reference")))
    return a.crossJoin(s)  # one row each


def targets_report(spark, sf):
    """The eight means against their targets; latency, ratios of the query stage and
    human scores aren't part of it."""
    return _rounded(E.targets(E.means(_inputs(spark), JUDGED).crossJoin(_legal_means(spark))), "value")


def _lit(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "'nan'::DOUBLE" if v != v else repr(v)
    if isinstance(v, list):
        return "[" + ", ".join(map(_lit, v)) + "]"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


I = "i AS (SELECT " + ", ".join(f"{c}::{t} AS {c}" for c, t in COLUMNS.items()) + " FROM (VALUES " + ", ".join("(" + ", ".join(map(_lit, r)) + ")" for r in ROWS) + f") v({', '.join(COLUMNS)}))"  # noqa: E741
_CITES = "list_distinct(list_concat(" + ", ".join(f"regexp_extract_all(r, '{p}')" for p in L.FAMILIES.values()) + "))"
CIT = f"""ci AS (SELECT query_id, {_CITES} AS c, lower(array_to_string(coalesce(contexts, []), ' ')) AS j FROM (SELECT *, coalesce(response, '') AS r FROM i)),
cit AS (SELECT query_id, len(c) AS cited, len(list_filter(c, lambda x: contains(j, lower(x)) OR (regexp_extract(x, '^[Ss]ection\\s+(\\d+[A-Za-z]*)$', 1) <> '' AND contains(j, lower(regexp_extract(x, '^[Ss]ection\\s+(\\d+[A-Za-z]*)$', 1)))))) AS held FROM ci)""".replace("\\\\", "\\")
_NAMES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.OLD_NAMES.items())
_NEW = " ".join(f"WHEN '{k}' THEN '{v.lower()}'" for k, v in L.REPLACED_CODES.items())
TEM = f"""ti AS (SELECT query_id, query_type, lower(r) AS low, list_transform(regexp_extract_all(r, '{L.OLD_CODE}', 1), lambda x: CASE lower(x) {_NAMES} END) AS a FROM (SELECT *, coalesce(response, '') AS r FROM i)),
tem AS (SELECT query_id, len(a) AS refs, len(list_filter(a, lambda x: query_type = 'temporal' OR regexp_matches(low, 'repealed|replaced|no longer in force') OR contains(low, CASE x {_NEW} END))) AS right_ FROM ti)"""
SEC = r"""si AS (SELECT query_id, cross_reference, coalesce(expected_sections, []) AS w, array_to_string(coalesce(contexts, []), ' ') AS j FROM i),
sec AS (SELECT query_id, cross_reference, len(w) AS expected, len(list_filter(w, lambda x: regexp_matches(j, '\b' || x || '\b'))) AS found FROM si)""".replace("\\\\", "\\")
SCORE = "CASE WHEN expected > 0 THEN found::DOUBLE / expected ELSE 1.0 END::DOUBLE"
LAT = "l0 AS (SELECT query_id, coalesce(nullif(route, ''), nullif(expected_route, ''), 'standard') AS route, elapsed_ms FROM i), lat AS (SELECT *, elapsed_ms <= CASE route " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in E.LATENCY.items()) + " ELSE 800.0 END AS passed FROM l0)"
MEANS = ", ".join(f"avg(CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0::DOUBLE ELSE {c} END) AS {c}" for c in JUDGED)

QUERIES = {
    "citation_accuracy_run": (citation_accuracy_run, f"WITH {I}, {CIT} SELECT query_id, cited, held, CASE WHEN cited > 0 THEN round(held::DOUBLE / cited, 6) ELSE 1.0 END::DOUBLE AS accuracy FROM cit"),
    "temporal_accuracy": (temporal_accuracy, f"WITH {I}, {TEM} SELECT query_id, refs AS \"references\", right_ AS \"right\", CASE WHEN refs > 0 THEN round(right_::DOUBLE / refs, 6) ELSE 1.0 END::DOUBLE AS accuracy FROM tem"),
    "section_completeness_run": (section_completeness_run, f"WITH {I}, {SEC} SELECT query_id, expected, found, round({SCORE}, 6) AS score FROM sec"),
    "cross_reference_resolution": (cross_reference_resolution, f"WITH {I}, {SEC} SELECT query_id, expected, found, CASE WHEN cross_reference THEN round({SCORE}, 6) ELSE 1.0 END::DOUBLE AS score FROM sec"),
    "latency_check": (latency_check, f"WITH {I}, {LAT} SELECT query_id, route, elapsed_ms, passed FROM lat"),
    "latency_per_route": (latency_per_route, f"WITH {I}, {LAT} SELECT route, count(*) AS n, round(avg(elapsed_ms), 6) AS mean, round(avg(passed::INT), 6) AS pass_rate FROM lat GROUP BY 1"),
    "qi_metrics": (qi_metrics, f"""WITH {I} SELECT round(count(*) FILTER (cache_hit)::DOUBLE / count(*), 6) AS cache_hit_rate, round(count(*) FILTER (trim(expected_route) <> '' AND route = expected_route)::DOUBLE / count(*) FILTER (trim(expected_route) <> ''), 6) AS routing_accuracy,
 round(sum(CASE WHEN total_claims = 0 THEN 1 ELSE supported_claims END)::DOUBLE / sum(CASE WHEN total_claims = 0 THEN 1 ELSE total_claims END), 6) AS claim_rate, round(count(*) FILTER (with_parent)::DOUBLE / count(*), 6) AS parent_use, round(count(*) FILTER (further > 0)::DOUBLE / count(*), 6) AS further_rate FROM i"""),
    "judge_means": (judge_means, f"WITH {I}, m AS (SELECT {MEANS} FROM i) SELECT " + ", ".join(f"round({c}, 6) AS {c}" for c in JUDGED) + " FROM m"),
    "human_eval_agg": (human_eval_agg, "SELECT count(*) AS sheets, round(avg(accuracy), 6) AS accuracy, round(avg(completeness), 6) AS completeness, round(avg(recency), 6) AS recency, round(avg(usefulness), 6) AS usefulness, round(avg((accuracy >= 4)::INT), 6) AS pass_rate FROM (VALUES " + ", ".join(map(str, SHEETS)) + ") v(query_id, evaluator_id, accuracy, completeness, recency, usefulness)"),
    "targets_report": (targets_report, f"""WITH {I}, {CIT}, {TEM}, {SEC}, m AS (SELECT {MEANS} FROM i), x AS (SELECT (SELECT avg(CASE WHEN cited > 0 THEN held::DOUBLE / cited ELSE 1.0 END) FROM cit) AS citation_accuracy, (SELECT avg(CASE WHEN refs > 0 THEN right_::DOUBLE / refs ELSE 1.0 END) FROM tem) AS temporal_accuracy,
 (SELECT avg({SCORE}) FROM sec) AS section_completeness, (SELECT avg(CASE WHEN cross_reference THEN {SCORE} ELSE 1.0 END) FROM sec) AS cross_reference), a AS (SELECT * FROM m, x),
u AS (""" + " UNION ALL ".join(f"SELECT '{k}' AS metric, {k}::DOUBLE AS value, {v}::DOUBLE AS target FROM a" for k, v in E.TARGETS.items()) + ") SELECT metric, round(value, 6) AS value, target, value >= target AS passed FROM u"),
}
