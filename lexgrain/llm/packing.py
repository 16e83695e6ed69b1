"""Filling containers of fixed capacity, best fit decreasing.

Items are dealt into groups of bounded size by a hash of their id; each group
is packed by one task. A segment tree over the remaining capacities finds the
tightest container that still takes an item in logarithmic time. A group leaves
less than one container unfilled on average, so the loss against one packing of
everything shrinks with the size of a group, not with the data.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.llm.lexicon import encode
from lexgrain.session import cut


class OpenBins:
    """Open containers by remaining capacity; the tree's inner nodes count the
    containers below them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << max(1, capacity.bit_length())
        self.tree = [0] * (2 * self.leaves)
        self.at: dict[int, list[int]] = {}

    def _add(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.tree[i] += by
            i >>= 1

    def put(self, room: int, bin_no: int) -> None:
        self.at.setdefault(room, []).append(bin_no)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, number) of the tightest container with
        room >= size, the latest of equals."""
        i = size + self.leaves
        if not self.tree[i]:
            while i > 1 and (i & 1 or not self.tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return room, self.at[room].pop()


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Container number of each size; all sizes lie in 1..capacity."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins, open_bins, used = [0] * len(sizes), OpenBins(capacity), 0
    for i in order:
        got = open_bins.take(sizes[i])
        room, b = got if got else (capacity, used)
        used += not got
        bins[i] = b
        if room > sizes[i]:
            open_bins.put(room - sizes[i], b)
    return bins


def pack(sizes: DataFrame, id_col: str, size_col: str, capacity: int, group_rows: int = 50_000) -> DataFrame:
    """(container, doc_ids, parts, used): ``parts`` holds (doc_id, start, size)
    of what lies in the container, in tokens of the item.

    An item within the capacity is never split; a larger one fills whole
    containers of its own, and its rest is packed like an item. Null ids and
    null or non-positive sizes are left out; a repeated id counts once (its
    largest size); equal sizes go by id; an empty table gives an empty result.
    """
    items = sizes.select(F.col(id_col).cast("long").alias("id"), F.col(size_col).cast("long").alias("size")).where("id is not null and size > 0")
    items = cut(items.groupBy("id").agg(F.max("size").alias("size")))  # sizes may come from a costly encoding
    groups = max(1, math.ceil(items.count() / group_rows))
    items = items.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    part = "struct<doc_id: bigint, start: bigint, size: bigint>"
    full = items.where(f"size >= {capacity}").select(
        "id", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"size div {capacity} - 1"))).alias("i")
    ).select(
        F.concat(F.lit("f"), F.col("id"), F.lit("-"), F.col("i")).alias("container"), F.array("id").alias("doc_ids"),
        F.array(F.struct(F.col("id").alias("doc_id"), (F.col("i") * capacity).alias("start"), F.lit(capacity).cast("long").alias("size"))).cast(f"array<{part}>").alias("parts"),
        F.lit(capacity).cast("long").alias("used"),
    )

    def one(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("id")
        df = df.assign(bin=best_fit_decreasing(df["rest"].tolist(), capacity)).sort_values(["bin", "id"], kind="stable")
        g = int(df["g"].iloc[0])
        rows = []
        for b, x in df.groupby("bin", sort=True):
            ids, rest, size = x["id"].tolist(), x["rest"].tolist(), x["size"].tolist()
            rows.append((f"g{g}-{b}", ids, [{"doc_id": i, "start": s - r, "size": r} for i, r, s in zip(ids, rest, size)], sum(rest)))
        return pd.DataFrame(rows, columns=["container", "doc_ids", "parts", "used"])

    rest = items.withColumn("rest", F.expr(f"size % {capacity}")).where("rest > 0")
    packed = rest.groupBy("g").applyInPandas(one, f"container string, doc_ids array<long>, parts array<{part}>, used long")
    return packed.unionByName(full)


def p9_containers(spark, sf):
    from lexgrain.session import load

    docs = load(spark, sf, "documents").where("text is not null and text <> ''")
    return pack(encode(docs, "doc_id", "text", count_only=True), "id", "tokens", 2048)


QUERIES = {"p9_containers": (p9_containers, None)}
