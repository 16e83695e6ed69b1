"""Verification of answers and evaluation aggregates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexgrain.functions import legal as L
from lexgrain.functions.register import spans


def citation_spans(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, family, citation, start, end) of every citation, in order of place.

    The same span counts once; a circular inside an earlier span doesn't count.
    Null texts give no row.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, *x) for i, t in zip(b["id"], b["t"]) for x in spans(t)]
            yield pd.DataFrame(rows, columns=["id", "family", "citation", "start", "end"])

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t is not null")
    return src.mapInPandas(run, f"id {dict(src.dtypes)['id']}, family string, citation string, start int, end int")


def verify_citations(cited: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``status`` to cited(..., family, key): verified if the key is among
    known(key), not_found if not or if there is no key; notices and circulars, of
    which the graph holds none, are kg_unavailable."""
    k = known.select(F.col("key").alias("_k")).where("_k is not null").distinct()
    j = cited.join(k, F.col("key") == F.col("_k"), "left")
    status = F.when(F.col("family").isin("gazette", "circular"), "kg_unavailable").when(F.col("_k").isNotNull(), "verified").otherwise("not_found")
    return j.withColumn("status", status).drop("_k")


def temporal_warnings(refs: DataFrame, sections: DataFrame, acts: DataFrame, replaces: DataFrame) -> DataFrame:
    """(source, ref, section, act, reason, by_act, by_section) of the references that
    warrant a warning.

    refs(source, ref, section, act, day), sections(act, number, is_in_force,
    replaced_by), acts(act, status), replaces(from_key, to_key). First rule that
    holds: one of the repealed codes, at a day on or after their repeal; a section of
    the graph that isn't in force; a section of the graph whose act is repealed.
    """
    new = F.create_map(*[F.lit(x.lower()) for kv in L.REPLACED_CODES.items() for x in kv])
    code = F.try_element_at(new, F.col("act"))
    s = sections.select("act", F.col("number").alias("section"), "is_in_force", "replaced_by", F.lit(True).alias("_s"))
    by = replaces.groupBy(F.col("to_key").alias("act")).agg(F.min("from_key").alias("_by"))
    j = refs.join(s, ["act", "section"], "left").join(acts.select("act", "status"), "act", "left").join(by, "act", "left")
    reason = F.when(code.isNotNull() & (F.col("day") >= F.lit(L.REPEAL_DAY).cast("date")), "code repealed").when(F.col("_s") & ~F.col("is_in_force"), "not in force").when(F.col("_s") & (F.col("status") == "repealed"), "act repealed")
    out = j.select("source", "ref", "section", "act", reason.alias("reason"), F.coalesce(code, "_by").alias("by_act"), F.col("replaced_by").alias("by_section"))
    return out.where("reason is not null")


def caveat(text: Column, unsupported: Column, partial: Column) -> Column:
    """The text with a note on how many claims aren't or only partly supported."""
    note = F.concat(F.lit("\n\nNote: "), unsupported.cast("string"), F.lit(" unsupported, "), partial.cast("string"), F.lit(" partly supported."))
    return F.when(unsupported + partial > 0, F.concat(text, note)).otherwise(text)


def recency(day: Column, today: str) -> Column:
    age = F.datediff(F.lit(today).cast("date"), day)
    return F.when(day.isNull(), 0.5).when(age <= 0, 1.0).when(age < 365, 0.9).when(age < 730, 0.7).when(age < 1825, 0.5).otherwise(0.3)


def authority(kind: Column, level: Column) -> Column:
    return F.when(kind == "statute", 0.8).when(level == 1, 1.0).when(level == 2, 0.7).when(level == 3, 0.4).when(level == 4, 0.2).otherwise(0.1)


#: weights of the factors of confidence
WEIGHTS = {"relevance": 0.25, "citations": 0.20, "authority": 0.20, "agreement": 0.15, "recency": 0.10, "specificity": 0.10}


def specificity(route: Column, hits: Column) -> Column:
    """A simple question with few hits is specific; one for everything isn't."""
    base = F.when(route == "simple", 0.9).when(route == "standard", 0.7).when(route == "complex", 0.5).when(route == "analytical", 0.3).otherwise(0.5)
    return F.when(hits <= 3, F.least(F.lit(1.0), base + 0.2)).when(hits <= 10, base).otherwise(F.greatest(F.lit(0.1), base - 0.2))


def weighted(factors: dict[str, float]) -> Column:
    """Weighted sum of columns, held within 0..1, four digits."""
    s = sum((F.col(c) * w for c, w in factors.items()), F.lit(0.0))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 4)


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """part / whole, or ``empty`` where there is nothing."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty))


def contained(expected: Column, contexts: Column) -> Column:
    """How many of the expected strings stand in the joined contexts, as whole
    words, whatever their case."""
    joined = F.lower(F.concat_ws(" ", contexts))
    return F.size(F.filter(expected, lambda x: F.regexp_like(joined, F.concat(F.lit("\\b"), F.lower(x), F.lit("\\b")))))


def latency_pass(ms: Column, route: Column, targets: dict[str, float], default: str) -> Column:
    t = F.create_map(*[F.lit(x) for kv in targets.items() for x in kv])
    return ms <= F.coalesce(F.try_element_at(t, route), F.lit(targets[default]))


def report(values: dict[str, float], targets: dict[str, float]) -> str:
    """Fixed-width report with PASS or FAIL for each target."""
    lines = [f"{'metric':<28}{'value':>10}{'target':>10}  result"]
    for k, v in values.items():
        t = targets.get(k)
        lines.append(f"{k:<28}{v:>10.4f}" + (f"{t:>10.2f}  {'PASS' if v >= t else 'FAIL'}" if t is not None else ""))
    return "\n".join(lines)
