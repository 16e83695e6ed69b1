"""Connected components by alternating large-star and small-star steps.

Every step is one aggregation and one join on hashed keys. A node's neighbours
are never gathered in one row: both steps only need the smallest neighbour, a
partial aggregate, so a hub with a third of all edges costs one combiner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.session import cut, joined


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``edges`` (any direction, repeats and loops allowed) -> (node, component).

    ``component`` is the smallest node of the component. Null endpoints are
    ignored, an empty input gives an empty result. Nodes without any edge do not
    appear, a node with only a loop is its own component.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    loops = e.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    e = cut(e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of u hangs itself under u's minimum
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = joined(both.where("v > u"), low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every smaller neighbour of u hangs itself under u's minimum
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            joined(large, small_low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small_low.select("u", F.col("m").alias("v")))
        )
        e = cut(small.distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == tuple(now):
            break
        state = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).unionByName(loops)
    return out.groupBy("node").agg(F.min("component").alias("component"))
