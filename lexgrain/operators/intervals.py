"""Continuous periods and gaps of validity intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: end that stands for "open" inside the operator; no parsed date reaches it
OPEN = "make_date(10000, 1, 1)"


def _sessions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge overlapping [lo, hi) rows per key: each row opens a session as long
    as its own interval, and Spark merges sessions that overlap."""
    ts = df.withColumn("_ts", F.col("lo").cast("timestamp")).withColumn("_gap", F.concat(F.datediff("hi", "lo"), F.lit(" days")))
    w = ts.groupBy(*keys, F.session_window("_ts", F.col("_gap")).alias("_w")).agg(F.count(F.lit(1)).alias("_n"))
    return w.select(*keys, F.col("_w.start").cast("date").alias("lo"), F.col("_w.end").cast("date").alias("hi"))


def _touching(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join periods of which one ends where another starts."""
    w = W.partitionBy(*keys).orderBy("lo", "hi")
    far = F.max("hi").over(w.rowsBetween(W.unboundedPreceding, -1))
    isle = df.withColumn("_new", F.when(far >= F.col("lo"), 0).otherwise(1))
    isle = isle.withColumn("_isle", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return isle.groupBy(*keys, "_isle").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_isle")


def periods(df: DataFrame, keys: Sequence[str], start: str, end: str, bucket_years: int = 5) -> DataFrame:
    """Continuous periods per entity: keys..., lo, hi (``hi`` null if open).

    Intervals hold their start and not their end; a null end is open; rows with a
    null start or with an end not after it are ignored; repeats count once;
    touching intervals are one period; null keys form an entity of their own;
    an empty table gives an empty result. Columns other than keys, start and end
    are not read, whatever their names.

    Skew: sessions are merged first per (entity, start bucket), so an entity with
    very many rows is spread over tasks; what is left per bucket is bounded by
    its number of days, and only that meets again per entity.
    """
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(start).cast("date").alias("lo"), F.coalesce(F.col(end).cast("date"), F.expr(OPEN)).alias("hi"))
    rows = rows.where("lo is not null and hi > lo").withColumn("_b", F.floor(F.year("lo") / bucket_years))
    rows = rows.groupBy(*names, "_b", "lo").agg(F.max("hi").alias("hi"))
    part = _sessions(rows, [*names, "_b"]).drop("_b")
    whole = _touching(_sessions(part, names), names)
    return whole.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "lo", F.when(F.col("hi") < F.expr(OPEN), F.col("hi")).alias("hi"))


def periods_and_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """keys..., kind ('period' or 'gap'), lo, hi; see :func:`periods`."""
    p = periods(df, keys, start, end)
    w = W.partitionBy(*keys).orderBy("lo")
    nxt = p.withColumn("_next", F.lead("lo").over(w))
    both = F.array(
        F.struct(F.lit("period").alias("kind"), F.col("lo").alias("a"), F.col("hi").alias("b")),
        F.when(F.col("_next").isNotNull(), F.struct(F.lit("gap").alias("kind"), F.col("hi").alias("a"), F.col("_next").alias("b"))),
    )
    out = nxt.select(*keys, F.explode(F.array_compact(both)).alias("r"))
    return out.select(*keys, "r.kind", F.col("r.a").alias("lo"), F.col("r.b").alias("hi"))
