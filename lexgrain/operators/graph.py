"""A temporal property graph as plain tables: node upserts, typed edges, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def upsert_nodes(rows: DataFrame, key: list[str], seq: Column, keep: dict[str, Column], overwrite: dict[str, Column]) -> DataFrame:
    """One row per key from all rows of an ingestion.

    Properties in ``keep`` take the last value that isn't null, those in
    ``overwrite`` the last value even if null. ``seq`` orders the ingestion and
    must be unique per key. All are partial aggregates, so a key with very many
    rows is combined before the shuffle.
    """
    aggs = [F.max_by(c, F.when(c.isNotNull(), seq)).alias(n) for n, c in keep.items()] + [F.max_by(c, seq).alias(n) for n, c in overwrite.items()]
    return rows.groupBy(*key).agg(*aggs)


def resolve_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of which both ends exist; nodes(label, key)."""
    n = nodes.select("label", "key").distinct()
    a = edges.join(n.select(F.col("label").alias("from_label"), F.col("key").alias("from_key")), ["from_label", "from_key"], "left_semi")
    return a.join(n.select(F.col("label").alias("to_label"), F.col("key").alias("to_key")), ["to_label", "to_key"], "left_semi").select(*edges.columns)


def ends(edges: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Edges whose end ``key`` is among the known nodes."""
    return edges.join(known.select(key).distinct(), key, "left_semi")


def lower_overrules(edges: DataFrame, levels: DataFrame) -> DataFrame:
    """(overruler, overruled) of edges from a court of lower rank, that is a greater
    level number, than the overruled judgment's; levels(key, court_level)."""
    a, b = levels.select(F.col("key").alias("from_key"), F.col("court_level").alias("a")), levels.select(F.col("key").alias("to_key"), F.col("court_level").alias("b"))
    return edges.join(a, "from_key").join(b, "to_key").where("a > b").select(F.col("from_key").alias("overruler"), F.col("to_key").alias("overruled"))


def version_at(versions: DataFrame, points: DataFrame, keys: list[str], point: str, start: str, end: str, version: str) -> DataFrame:
    """As-of join: for each row of ``points`` the latest version in force at its
    date: start <= date < end, an open end lasts. Ties go to the greater id."""
    j = points.join(versions, keys).where(F.col(start).isNotNull() & (F.col(start) <= F.col(point)) & (F.col(end).isNull() | (F.col(end) > F.col(point))))
    return j.groupBy(*points.columns).agg(F.max_by(version, F.struct(F.col(start), F.col(version))).alias(version), F.max(start).alias(start))


def neighbours(edges: DataFrame, label: str) -> DataFrame:
    """(key, relation, others): sorted neighbours of all nodes of a label by kind
    and direction, in one pass over the edges."""
    out = edges.where(F.col("from_label") == label).select(F.col("from_key").alias("key"), F.concat(F.lit("out:"), "kind").alias("relation"), F.col("to_key").alias("other"))
    inc = edges.where(F.col("to_label") == label).select(F.col("to_key").alias("key"), F.concat(F.lit("in:"), "kind").alias("relation"), F.col("from_key").alias("other"))
    return out.unionByName(inc).groupBy("key", "relation").agg(F.array_sort(F.collect_set("other")).alias("others"))


def hops(edges: DataFrame, start: DataFrame, most: int) -> DataFrame:
    """(origin, node, distance): nodes within ``most`` steps along the edges
    (src, dst), each at its least distance. Each step is a join of the frontier."""
    seen = start.select(F.col("node").alias("origin"), "node", F.lit(0).alias("distance"))
    front = seen
    for d in range(1, most + 1):
        step = front.join(edges.select(F.col("src").alias("node"), "dst"), "node").select("origin", F.col("dst").alias("node")).distinct()
        front = step.join(seen.select("origin", "node"), ["origin", "node"], "left_anti").withColumn("distance", F.lit(d))
        seen = seen.unionByName(front)
    return seen


def overlaps(versions: DataFrame, keys: list[str], version: str, start: str, end: str) -> DataFrame:
    """Versions that begin before all earlier ones have ended, with the number of
    days shared with the longest; one pass per entity, no pairs."""
    far = F.coalesce(F.col(end), F.expr("make_date(9999, 12, 31)"))
    w = W.partitionBy(*keys).orderBy(start, version)
    v = versions.where(F.col(start).isNotNull() & (far > F.col(start))).withColumn("_far", far)
    v = v.withColumn("_before", F.max("_far").over(w.rowsBetween(W.unboundedPreceding, -1)))
    return v.where(F.col("_before") > F.col(start)).select(*keys, version, F.datediff(F.least("_before", "_far"), start).cast("bigint").alias("days"))
