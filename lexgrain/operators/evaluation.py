"""Evaluation of a run: legal metrics, latency, ratios of the query stage, judged and
human scores, targets. One row per test query in, one row per query or one out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrain.functions import legal as L
from lexgrain.operators.verification import ratio

#: milliseconds a route may take
LATENCY = {"simple": 200.0, "standard": 800.0, "complex": 2000.0, "analytical": 5000.0}
#: least values of the means
TARGETS = {
    "context_recall": 0.90, "context_precision": 0.85, "faithfulness": 0.95, "answer_relevancy": 0.85,
    "citation_accuracy": 0.98, "temporal_accuracy": 0.99, "section_completeness": 0.90, "cross_reference": 0.80,
}


def _texts(c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast("array<string>"))


def citations(text: Column) -> Column:
    """All citations of a text, each distinct one once."""
    each = [F.regexp_extract_all(text, F.lit(f"({p})"), F.lit(1)) for p in L.FAMILIES.values()]
    return F.array_distinct(F.flatten(F.array(*each)))


def citation_accuracy(inputs: DataFrame) -> DataFrame:
    """Share of a response's citations that its contexts hold, as they stand or by
    their bare section number, whatever the case; 1 without citations."""
    joined = F.lower(F.array_join(_texts("contexts"), " "))
    number = lambda x: F.nullif(F.regexp_extract(x, "^[Ss]ection\\s+(\\d+[A-Za-z]*)$", 1), F.lit(""))
    ok = lambda x: F.contains(F.col("_j"), F.lower(x)) | F.coalesce(F.contains(F.col("_j"), F.lower(number(x))), F.lit(False))
    d = inputs.withColumn("_j", joined).withColumn("_c", citations(F.coalesce("response", F.lit(""))))
    return d.select("query_id", F.size("_c").alias("cited"), F.size(F.filter("_c", ok)).alias("held")).withColumn("accuracy", ratio(F.col("held"), F.col("cited"), 1.0))


def temporal_accuracy(inputs: DataFrame) -> DataFrame:
    """Share of references to the repealed codes that the response acknowledges as
    such; queries about time always do; 1 without such references."""
    text = F.coalesce("response", F.lit(""))
    named = F.transform(F.regexp_extract_all(text, F.lit(L.OLD_CODE), F.lit(1)), F.lower)
    names = F.create_map(*[F.lit(x) for kv in L.OLD_NAMES.items() for x in kv])
    new = F.create_map(*[F.lit(x) for k, v in L.REPLACED_CODES.items() for x in (k, v.lower())])
    d = inputs.withColumn("_a", F.transform(named, lambda x: names[x])).withColumn("_low", F.lower(text))
    said = F.col("_low").rlike("repealed|replaced|no longer in force")
    ok = F.filter("_a", lambda a: (F.col("query_type") == "temporal") | said | F.contains(F.col("_low"), new[a]))
    return d.select("query_id", F.size("_a").alias("references"), F.size(ok).alias("right")).withColumn("accuracy", ratio(F.col("right"), F.col("references"), 1.0))


def sections_retrieved(inputs: DataFrame, only: Column | None = None) -> DataFrame:
    """Share of the expected sections that the contexts name as whole words; 1 where
    none is expected, or where the condition ``only`` doesn't hold."""
    joined = F.array_join(_texts("contexts"), " ")
    hit = F.filter(_texts("expected_sections"), lambda x: F.regexp_like(joined, F.concat(F.lit("\\b"), x, F.lit("\\b"))))
    d = inputs.select("query_id", F.size(_texts("expected_sections")).alias("expected"), F.size(hit).alias("found"), (F.lit(True) if only is None else only).alias("_on"))
    return d.select("query_id", "expected", "found", F.when(F.col("_on"), ratio(F.col("found"), F.col("expected"), 1.0)).otherwise(1.0).alias("score"))


def latency(inputs: DataFrame) -> DataFrame:
    """(query_id, route, elapsed_ms, passed): the result's route, else the expected
    one, else standard; an unknown route has the standard target."""
    route = F.coalesce(F.nullif(F.col("route"), F.lit("")), F.nullif(F.col("expected_route"), F.lit("")), F.lit("standard"))
    target = F.create_map(*[F.lit(x) for kv in LATENCY.items() for x in kv])
    d = inputs.select("query_id", route.alias("route"), "elapsed_ms")
    return d.withColumn("passed", F.col("elapsed_ms") <= F.coalesce(F.try_element_at(target, F.col("route")), F.lit(LATENCY["standard"])))


def query_ratios(inputs: DataFrame) -> DataFrame:
    """One row: cache hits, routing accuracy over expected routes, supported claims
    (a summary without claims counts as one of one, none isn't counted), queries with
    a parent's text, queries with further retrieval."""
    n = F.count(F.lit(1))
    known = F.count_if(F.coalesce(F.trim("expected_route"), F.lit("")) != "")
    right = F.count_if((F.coalesce(F.trim("expected_route"), F.lit("")) != "") & (F.col("route") == F.col("expected_route")))
    total = F.when(F.col("total_claims") == 0, 1).otherwise(F.col("total_claims"))
    good = F.when(F.col("total_claims") == 0, 1).otherwise(F.col("supported_claims"))
    share = lambda c: ratio(F.count_if(F.coalesce(c, F.lit(False))), n)
    return inputs.agg(
        share(F.col("cache_hit")).alias("cache_hit_rate"), ratio(right, known).alias("routing_accuracy"), ratio(F.coalesce(F.sum(good), F.lit(0)), F.coalesce(F.sum(total), F.lit(0))).alias("claim_rate"),
        share(F.col("with_parent")).alias("parent_use"), share(F.col("further") > 0).alias("further_rate"))


def means(inputs: DataFrame, columns: list[str]) -> DataFrame:
    """Means of judged scores; missing and NaN count as 0, no row gives 0."""
    return inputs.agg(*[F.coalesce(F.avg(F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))), F.lit(0.0)).alias(c) for c in columns])


def human_means(sheets: DataFrame) -> DataFrame:
    """Means of the four human scores of 1..5, and the share of accuracy of 4 or more."""
    marks = ("accuracy", "completeness", "recency", "usefulness")
    return sheets.agg(F.count(F.lit(1)).alias("sheets"), *[F.avg(c).alias(c) for c in marks], F.avg((F.col("accuracy") >= 4).cast("double")).alias("pass_rate"))


def targets(values: DataFrame) -> DataFrame:
    """(metric, value, target, passed) of a row of means; metrics without a target
    are left out."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"), F.lit(TARGETS[k]).alias("target")) for k in values.columns if k in TARGETS]))
    return values.select(each.alias("x")).select("x.*").withColumn("passed", F.col("value") >= F.col("target"))
