"""Most similar vectors by counting collisions of single projections.

Every vector is projected on random lines, and a projection is kept as the number of
a narrow bucket. Vectors of one block are put into one sorted array per line. A window
around a query's own bucket holds the vectors that collide with it on this line; a
window of r buckets to either side is what merging r buckets gives (virtual
rehashing), so windows of growing r nest and need no further tables. Similar vectors
collide on most lines: those whose count of collisions passes a threshold are compared
exactly. A window is a range of the sorted array and so the difference of two prefix
sets; sets are kept as bits and counts as bit slices, so that one word operation
counts for 64 vectors (:func:`colliding`). Two forms:

* :func:`similar_pairs`: all pairs above a cosine. The bound fixes the radius: the
  windows are widened to what a pair at the bound keeps on most lines. Blocks are the
  cells of some further lines, cut at their medians, in several tables, whose number
  follows from a stated miss probability; never all pairs.
* :func:`nearest`: the k nearest of stated queries. Rows are cut into blocks, and the
  windows around each query are widened step by step until enough vectors have passed
  the threshold; these are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.session import cut, joined

#: width of a bucket of a projection; 8 bits hold nearly four standard deviations
STEP = 0.03
#: lines on which collisions are counted
LINES = 48
#: vectors at most that the medians of block lines are taken from
SAMPLE = 4096


def lines(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, n)).astype(np.float32)


def unit_rows(v: np.ndarray) -> np.ndarray:
    m = v.astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # no overflow or underflow of the squares
    return (m / np.sqrt((m * m).sum(axis=1, keepdims=True))).astype(np.float32)


def valid(df: DataFrame, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """(v, x): rows with an id whose vector has ``dim`` finite numbers, not all
    zero. A repeated id counts once (its smallest vector, if they differ)."""
    x = df.select(F.col(id_col).cast("long").alias("v"), F.col(vec_col).cast("array<float>").alias("x"))
    bad = "exists(x, e -> e is null or isnan(e) or abs(e) = float('inf'))"
    return x.where(f"v is not null and size(x) = {dim} and not {bad} and exists(x, e -> e <> 0)")


def _matrix(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(np.float32)


def buckets(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bucket numbers of unit vectors on each line."""
    return np.clip(np.rint(x @ at / STEP), -127, 127).astype(np.int8)


class Sorted:
    """Vectors of a block in one sorted array per line; of each array the prefix sets."""

    def __init__(self, q: np.ndarray):
        self.n, self.m = q.shape
        self.words = (self.n + 63) // 64
        self.q = q

    def prefixes(self, line: int) -> tuple[np.ndarray, np.ndarray]:
        """(sets, ends): sets[r] the first r vectors of the array as bits, ends[b] the
        number of vectors in buckets below b - 128."""
        col = self.q[:, line]
        order = np.argsort(col, kind="stable")
        sets = np.zeros((self.n + 1, self.words), np.uint64)
        sets[np.arange(1, self.n + 1), order >> 6] = np.left_shift(np.uint64(1), (order & 63).astype(np.uint64))
        np.bitwise_or.accumulate(sets, axis=0, out=sets)
        ends = np.zeros(258, np.int64)
        ends[1:257] = np.cumsum(np.bincount(col.astype(np.int64) + 128, minlength=256))
        ends[257] = self.n
        return sets, ends


def _windows(sets: np.ndarray, ends: np.ndarray, q: np.ndarray, radius: int) -> np.ndarray:
    """Of each query (its bucket) the vectors within ``radius`` buckets."""
    at = q.astype(np.int64) + 128
    lo, hi = ends[np.maximum(at - radius, 0)], ends[np.minimum(at + radius + 1, 257)]
    return sets[hi] ^ sets[lo]


def colliding(block: Sorted, q: np.ndarray, radii: list[int], need: int) -> list[np.ndarray]:
    """For each radius, of each query the set of vectors (as bits) that are in its
    window on at least ``need`` lines."""
    slices: list[list[np.ndarray]] = [[] for _ in radii]
    spare: list[dict[int, np.ndarray]] = [{} for _ in radii]

    def add(k: int, level: int, x: np.ndarray) -> None:
        # counts as bit slices; two waiting carries of a level and the slice make one full adder
        while True:
            while len(slices[k]) <= level:
                slices[k].append(np.zeros_like(x))
            y = spare[k].pop(level, None)
            if y is None:
                spare[k][level] = x
                return
            s = slices[k][level]
            u = s ^ x
            carry = (s & x) | (u & y)
            slices[k][level] = u ^ y
            level, x = level + 1, carry

    for line in range(block.m):
        sets, ends = block.prefixes(line)
        for k, r in enumerate(radii):
            add(k, 0, _windows(sets, ends, q[:, line], r))
    out = []
    for k in range(len(radii)):
        pending: list[np.ndarray] = []
        for level in range(block.m.bit_length()):
            if level == len(slices[k]):
                slices[k].append(np.zeros_like(slices[k][0]))
            waiting = pending + ([spare[k].pop(level)] if level in spare[k] else [])
            pending = []
            for x in waiting:
                s = slices[k][level]
                slices[k][level] = s ^ x
                pending.append(s & x)
        more, same = np.zeros_like(slices[k][0]), ~np.zeros_like(slices[k][0])
        for level in reversed(range(max(len(slices[k]), need.bit_length()))):
            s = slices[k][level] if level < len(slices[k]) else np.zeros_like(more)
            if need >> level & 1:
                same &= s
            else:
                more |= same & s
                same &= ~s
        out.append(more | same)
    return out


def members(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) of every bit that is set."""
    row, word = np.nonzero(sets)
    bits = np.unpackbits(sets[row, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(bits)
    return row[at], word[at] * 64 + bit


def enough(n: int, p: float, miss: float) -> int:
    """The greatest count that at least a share of 1 - miss reaches of n trials at p."""
    below = 0.0
    for c in range(n + 1):
        below += math.comb(n, c) * p**c * (1 - p) ** (n - c)
        if below > miss:
            return c
    return n


def _blocks(sample: np.ndarray, dim: int, bits: int, spread: float, misses: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines and cuts of the tables of blocks, ``bits`` a table: so many tables that a
    pair whose projections differ with deviation ``spread`` is in no common block with
    probability ``misses`` at most. How often a cut parts such a pair is measured on
    the sample."""
    from statistics import NormalDist

    apart = np.array([spread * NormalDist().inv_cdf(0.5 + (k + 0.5) / 64) for k in range(32)])
    at, cuts, lost, t = [], [], 1.0, 0
    while lost > misses and t < 5000:
        a = lines(dim, bits, seed + t)
        p = sample @ a
        c = np.median(p, axis=0) if len(p) else np.zeros(bits)
        off = np.abs(p - c)
        parted = np.array([np.searchsorted(np.sort(off[:, i]), apart / 2).mean() / max(1, len(off)) for i in range(bits)])
        lost *= 1 - float(np.prod(1 - np.minimum(parted, 0.999)))
        at.append(a)
        cuts.append(c)
        t += 1
    return np.concatenate(at, axis=1) if bits else np.zeros((dim, 0), np.float32), np.concatenate(cuts) if bits else np.zeros(0)


def similar_pairs(df: DataFrame, id_col: str, vec_col: str, dim: int, min_cos: float, misses: float = 0.0005, seed: int = 11, block_rows: int = 1024, most_rows: int = 8192) -> DataFrame:
    """(left, right, cosine), left < right, of all pairs with cosine >= min_cos.

    A pair at exactly ``min_cos`` is lost with probability ``misses`` by the blocks
    and as rarely by the collision threshold; closer pairs far more rarely. Vectors
    that are null, all zero, of another length or not finite take no part; a repeated
    id counts once; identical vectors are one class and expanded at the end; an empty
    table gives an empty result; other columns aren't read. A block of more than
    ``most_rows`` vectors is cut into parts that meet pair by pair.
    """
    base = valid(df, id_col, vec_col, dim).withColumn("g", F.xxhash64("x"))
    ids = base.groupBy("v").agg(F.min("g").alias("g"))
    reps = base.dropDuplicates(["g"]).select("g", "x")
    n = max(2, reps.count())
    bits = max(0, math.ceil(math.log2(n / block_rows)))
    spread = math.sqrt(2 - 2 * min_cos)
    picked = reps.orderBy("g").limit(SAMPLE).collect() if bits else []
    sample = unit_rows(np.array([r["x"] for r in picked], np.float32)) if picked else np.zeros((0, dim), np.float32)
    coarse, cuts = _blocks(sample, dim, bits, spread, misses, seed + 1)
    tables = max(1, coarse.shape[1] // bits) if bits else 1

    fine = lines(dim, LINES, seed)
    # the radius: windows of 1.8 deviations of such a pair; buckets are rounded, so one more
    radius = math.ceil(1.8 * spread / STEP) + 1
    need = enough(LINES, math.erf(1.8 / math.sqrt(2)), misses)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = np.left_shift(np.int64(1), np.arange(bits, dtype=np.int64))
        for b in batches:
            for at in range(0, len(b), 4096):
                c = b.iloc[at : at + 4096]
                x = unit_rows(_matrix(c["x"]))
                q = np.array([r.tobytes() for r in buckets(x, fine)], dtype=object)
                key = ((x @ coarse) > cuts).reshape(len(c), tables, bits) @ weight if bits else np.zeros((len(c), 1), np.int64)
                key = key * tables + np.arange(tables)
                rep = np.repeat(np.arange(len(c)), tables)
                yield pd.DataFrame({"key": key.ravel(), "g": c["g"].to_numpy()[rep], "q": q[rep]})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come in order of their block."""

        def pairs(parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
            g, q = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            i, j = members(colliding(Sorted(q), q, [radius], need)[0])
            i, j = i[i < j], j[i < j]
            return pd.DataFrame({"g1": np.minimum(g[i], g[j]), "g2": np.maximum(g[i], g[j])})

        held, last = [], None
        for b in batches:
            if not len(b):
                continue
            key = b[[c for c in b.columns if c in ("key", "i", "j")]].to_numpy()
            g, q = b["g"].to_numpy(), np.frombuffer(b"".join(b["q"]), np.int8).reshape(-1, LINES)
            ends = np.r_[np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(b)]
            at = 0
            for e in ends:
                this = tuple(key[at])
                if this != last and held:
                    yield pairs(held)
                    held = []
                last = this
                held.append((g[at:e], q[at:e]))
                at = e
        if held:
            yield pairs(held)

    t = reps.mapInPandas(place, "key long, g long, q binary").withColumn("m", F.count(F.lit(1)).over(W.partitionBy("key")))
    out = "g1 long, g2 long"
    met = t.where(f"m <= {most_rows}").select("key", "g", "q").sortWithinPartitions("key").mapInPandas(count, out)
    large = t.where(f"m > {most_rows}").withColumn("of", F.ceil(F.col("m") / (most_rows // 2)).cast("int")).withColumn("own", F.pmod(F.xxhash64("g"), F.col("of")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    large = large.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "g", "q").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    cand = cut(met.unionByName(large.mapInPandas(count, out)).distinct())

    wanted = cand.select(F.explode(F.array("g1", "g2")).alias("g")).distinct()
    full = joined(reps, wanted, "g", "left_semi")
    both = joined(joined(cand, full.select(F.col("g").alias("g1"), F.col("x").alias("x1")), "g1"), full.select(F.col("g").alias("g2"), F.col("x").alias("x2")), "g2")

    def cosine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                u, v = (_matrix(b[k]).astype(np.float64) for k in ("x1", "x2"))
                u, v = (m / np.abs(m).max(axis=1, keepdims=True) for m in (u, v))
                c = (u * v).sum(1) / np.sqrt((u * u).sum(1) * (v * v).sum(1))
                yield b[["g1", "g2"]].assign(cosine=c)[c >= min_cos]

    near = both.mapInPandas(cosine, "g1 long, g2 long, cosine double")
    i1, i2 = ids.select(F.col("v").alias("v1"), F.col("g").alias("g1")), ids.select(F.col("v").alias("v2"), F.col("g").alias("g2"))
    across = joined(joined(near, i1, "g1"), i2, "g2").select("v1", "v2", "cosine")
    many = ids.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo < hi").select("g")
    own = joined(ids, many, "g", "left_semi")
    same = joined(own.select(F.col("v").alias("v1"), "g"), own.select(F.col("v").alias("v2"), "g"), "g").where("v1 < v2").select("v1", "v2", F.lit(1.0).alias("cosine"))
    return across.unionByName(same).select(F.least("v1", "v2").alias("left"), F.greatest("v1", "v2").alias("right"), "cosine").distinct()


#: windows of a search, in buckets, each half as wide again as the one before
LEVELS = [round(0.3 * 1.3**k / STEP) for k in range(10)]


def search_block(x: np.ndarray, at: np.ndarray, q: np.ndarray, k: int, share: float, step: int = 512) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, numbers, cosines) of the k best of the vectors that collided on
    six lines of ten, in the narrowest windows in which at least ``share`` of the
    block (and 256, or all) did."""
    n = len(x)
    block, want = Sorted(buckets(x, at)), min(n, max(k, 256, math.ceil(share * n)))
    need = math.ceil(at.shape[1] * 0.6)
    for begin in range(0, len(q), step):
        part = q[begin : begin + step]
        p, open_ = buckets(part, at), np.arange(len(part))
        for level, radius in enumerate(LEVELS):
            sets = colliding(block, p[open_], [radius], need)[0]
            found = np.bitwise_count(sets).sum(axis=1)
            done = found >= want if level + 1 < len(LEVELS) else np.ones(len(open_), bool)
            for r in np.flatnonzero(done):
                hit = members(sets[r : r + 1])[1] if found[r] >= min(k, n) else np.arange(n)
                c = x[hit] @ part[open_[r]]
                top = np.argsort(-c, kind="stable")[:k]
                yield begin + int(open_[r]), hit[top], c[top]
            open_ = open_[~done]
            if not len(open_):
                break


def nearest(df: DataFrame, id_col: str, vec_col: str, dim: int, is_query: str, k: int = 10, share: float = 0.25, block_rows: int = 8192, query_block: int = 65536, seed: int = 5) -> DataFrame:
    """(query, rank, neighbour, cosine): the k nearest of every row for which the
    SQL condition ``is_query`` on ``v`` (the id) holds, among all other rows.

    Rows and queries are cut into blocks; a task holds one block of each, and the
    sorted arrays of a block of rows serve all its queries. Ties go to the smaller id.
    Unusable vectors as in :func:`similar_pairs`.
    """
    base = valid(df, id_col, vec_col, dim).groupBy("v").agg(F.min("x").alias("x"))
    n = base.count()
    nq = base.where(is_query).count()
    d, b = max(1, math.ceil(n / block_rows)), max(1, math.ceil(nq / query_block))
    grid = lambda name, size: F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias(name)
    rows = base.select("v", "x", F.pmod(F.xxhash64("v"), F.lit(d)).cast("int").alias("db"), grid("qb", b))
    ask = base.where(is_query).select("v", "x", F.pmod(F.xxhash64("v", F.lit(1)), F.lit(b)).cast("int").alias("qb"), grid("db", d))
    at = lines(dim, LINES, seed)

    def search(r: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        cols = {"query": np.int64, "neighbour": np.int64, "cosine": np.float64}
        if not len(r) or not len(q):
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in cols.items()})
        ids, asked = r["v"].to_numpy(), q["v"].to_numpy()
        out = []
        for i, hit, c in search_block(unit_rows(_matrix(r["x"])), at, unit_rows(_matrix(q["x"])), k + 1, share):
            keep = ids[hit] != asked[i]
            out.append(pd.DataFrame({"query": asked[i], "neighbour": ids[hit][keep][:k], "cosine": c[keep][:k].astype(np.float64)}))
        return pd.concat(out)

    part = rows.groupBy("db", "qb").cogroup(ask.groupBy("db", "qb")).applyInPandas(search, "query long, neighbour long, cosine double")
    w = W.partitionBy("query").orderBy(F.desc("cosine"), "neighbour")
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query", "rank", "neighbour", F.round("cosine", 6).alias("cosine"))


def _all_vectors(spark, sf):
    from lexgrain.session import load

    q = load(spark, sf, "queries")
    one = q.select((F.col("query_id") * 2).alias("vec"), F.col("query_embedding").alias("x"))
    return one.unionByName(q.select((F.col("query_id") * 2 + 1).alias("vec"), F.col("hyde_embedding").alias("x")))


def p6_found(spark, sf):
    out = similar_pairs(_all_vectors(spark, sf), "vec", "x", 64, 0.90)
    return out.select(F.col("left").alias("left_vec"), F.col("right").alias("right_vec")).distinct()


def p6_nearest(spark, sf):
    return nearest(_all_vectors(spark, sf), "vec", "x", 64, "v % 100 in (0, 1)")


QUERIES = {"p6_found": (p6_found, None), "p6_nearest": (p6_nearest, None)}
