"""Near-duplicate records by segment popcounts and an exact check.

Fingerprint of a text: the set of 64-bit hashes of its runs of k words.
Embedding: the hash range is cut into 256 segments (512 for long texts, which two
by two are the others' 256), and a text maps to the number of its hashes in each. The Manhattan distance of two such vectors never exceeds
the size of the symmetric difference of the sets, and sets of Jaccard similarity
at least t differ in at most (1 - t) / (1 + t) * (|A| + |B|) hashes, so a greater
distance refutes a pair. Of each count its lowest bit is kept: where these differ
the counts do, so the number of differing bits is a lower bound as well, and it
is four bit counts of an XOR.

Grid: the counts alone can't serve as join key. At t = 0.6 the bound on the
distance is half a text's size, which unrelated texts also keep in any number of
dimensions small enough for a grid. The cells of the grid are therefore taken
from the rare end of the fingerprint: its hashes are put into the order of their
corpus frequency (rarest first); similar sets must share a hash of their prefixes of
|A| - ceil(t |A|) + 1 hashes, and m of them in prefixes longer by m - 1. Every hash
of a prefix is a cell of its own, however frequent, so that each link is found for
certain whatever the sketch says: its counts only make the order, which is the same
for all texts.
Texts meet in a cell, in size range, with enough hashes left behind the shared one
and under the Manhattan bound, in ``shared`` cells if the longer prefixes of both are
seldom throughout (at most ``rare`` occurrences), and only then have their whole sets
compared.

Cells travel once, sorted, and the texts of a cell are compared where they arrive: in
order of size each text meets a window of larger ones, pair lists of small cells and
tiles of large ones go through the bound as arrays. The pairs of a cell still grow with
the square of its texts, at some nanoseconds each. Cells of more than ``SPREAD * hot``
texts come out again, are counted and cut into blocks, and each pair of blocks is a key
of its own.

Sizes that Spark estimates behind a Python step are far too small, so every join of
pairs and sets names its strategy: all are sort-merge joins over shuffles and nothing
that grows with the data is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.operators.components import connected_components
from lexgrain.session import cut, joined

MIX = np.uint64(0x9E3779B97F4A7C15)
#: hashes of a pair from which on it is looked at with 2048 segments
LONG = 220
#: a text in a cell: its class, parities of 256 segments, hashes, and hashes from the shared one on (their number negative: open)
ROW = np.dtype([("c", "<i8"), ("p", "<u8", 4), ("n", "<i4"), ("left", "<i4")])
#: a task compares cells of up to so many times ``hot`` rows as a whole
SPREAD = 16
#: rows of a cell from which on pairs are looked at in tiles, and a tile's sides; rows looked at in one go
TILED, TILE, AT_ONCE = 256, (64, 1024), 50_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:  # a cache only
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


#: all bytes but lower-case letters and digits become blanks
BLANKS = bytes(i if chr(i) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for i in range(256))


def _split(text: str) -> list[bytes]:
    """Words of a text: runs of a-z and 0-9 after lower-casing."""
    return text.lower().encode("ascii", "replace").translate(BLANKS).split()


def _class(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63)


def _shingles(split: list[list[bytes]], words: _Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of every run of k words."""
    lens = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    if lens.sum() < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    flat = np.fromiter(map(words.__getitem__, chain.from_iterable(split)), dtype=np.uint64, count=int(lens.sum()))
    doc = np.repeat(np.arange(len(split)), lens)
    n = len(flat) - k + 1
    h = flat[:n].copy()
    for i in range(1, k):
        h = _mix(h) ^ flat[i : n + i]
    keep = doc[:n] == doc[k - 1 :]
    return doc[:n][keep], _mix(h[keep])


def _sets(split: list[list[bytes]], words: _Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_shingles`, each hash once per document, sorted."""
    doc, h = _shingles(split, words, k)
    o = np.lexsort((h, doc))
    doc, h = doc[o], h[o]
    if len(h):
        first = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
        doc, h = doc[first], h[first]
    return doc, h


def _frequencies(norm: DataFrame, k: int, bits: int, blocks: int = 16) -> np.ndarray:
    """Frequency sketch over all texts: one table of 2**bits counters, summed over
    all tasks block by block. Its size doesn't depend on the data."""
    size = 1 << bits

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, acc = _Words(), np.zeros(size, np.int64)
        for b in batches:
            _, h = _shingles([_split(t) for t in b["_t"]], words, k)
            acc += np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size)
        acc = np.minimum(acc, 2**32 - 1).astype(np.uint32)
        yield pd.DataFrame({"block": range(blocks), "counts": [x.tobytes() for x in np.split(acc, blocks)]})

    def add(g: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.uint32).astype(np.uint64) for x in g["counts"])
        return pd.DataFrame({"block": [g["block"].iloc[0]], "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})

    schema = "block int, counts binary"
    rows = norm.select("_t").mapInPandas(count, schema).groupBy("block").applyInPandas(add, schema).collect()
    out = np.zeros(size, np.uint32)
    for r in rows:
        out[r["block"] * (size // blocks) : (r["block"] + 1) * (size // blocks)] = np.frombuffer(r["counts"], np.uint32)
    return out


def _packed(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _near(cell: np.ndarray, rows: np.ndarray, side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows in order of cell and size, each text once a cell, and the places of
    all pairs in them that meet: in size range, with enough hashes behind the shared
    one and under the Manhattan bound. ``side``: -1, or rows of one side don't meet."""
    bound, share = (1 - threshold) / (1 + threshold), threshold / (1 + threshold)
    o = np.lexsort((rows["c"], rows["n"], cell))
    cell, rows, side = cell[o], rows[o], side[o]
    if len(rows):
        own = np.r_[True, (cell[1:] != cell[:-1]) | (rows["c"][1:] != rows["c"][:-1])]
        cell, rows, side = cell[own], rows[own], side[own]
    m = len(rows)
    n, left = rows["n"].astype(np.int64), np.abs(rows["left"]).astype(np.int64)
    p = np.ascontiguousarray(rows["p"].T)
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if m else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, m]))
    # of the larger texts behind it a row meets those up to a size
    most = np.floor(np.minimum((n + 1e-9) / threshold, (left + 1e-9) / share - n) + 1e-6).astype(np.int64)
    end = np.searchsorted(group << 32 | n, group << 32 | np.clip(most, 0, 2**32 - 1), "right")
    end = np.maximum(end, np.arange(m) + 1)
    found_i, found_j = [], []

    def look(i: np.ndarray, j: np.ndarray) -> None:
        both = n[i] + n[j]
        far = sum(np.bitwise_count(q[i] ^ q[j]).astype(np.int64) for q in p)
        ok = (far <= bound * both + 1e-9) & (np.minimum(left[i], left[j]) >= share * both - 1e-9) & (n[i] >= threshold * n[j] - 1e-9)
        ok &= (side[i] != side[j]) | (side[i] < 0)
        found_i.append(i[ok])
        found_j.append(j[ok])

    large = np.diff(np.r_[first, m]) >= TILED
    small = np.flatnonzero(~large[group] & (end > np.arange(m) + 1))
    width = end[small] - small - 1
    upto = np.cumsum(width)
    at = 0
    while at < len(small):  # some 300,000 pairs at a time
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + 300_000, "right")))
        w, i = width[at:to], small[at:to]
        j = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w - i - 1, w)
        look(np.repeat(i, w), j)
        at = to
    for g in np.flatnonzero(large):
        start, stop = first[g], first[g + 1] if g + 1 < len(first) else m
        x = start + np.flatnonzero(end[start:stop] > np.arange(start, stop) + 1)
        for s in range(0, len(x), TILE[0]):
            i = x[s : s + TILE[0]]
            q, to = p[:, i, None], end[i].max()
            for t in range(i[0] + 1, to, TILE[1]):
                u = min(t + TILE[1], to)
                far = np.bitwise_count(q[0] ^ p[0, None, t:u])
                for z in (1, 2):  # three of four words, whose distance is a lower bound too
                    far += np.bitwise_count(q[z] ^ p[z, None, t:u])
                a, b = np.nonzero(far <= min(int(bound * (n[i[-1]] + n[u - 1]) + 1e-9), 255))
                a, b = i[a], b + t
                ok = (b > a) & (b < end[a])
                look(a[ok], b[ok])
    empty = np.zeros(0, np.int64)
    return rows, np.concatenate([empty, *found_i]), np.concatenate([empty, *found_j])


def _meet(batches: Iterator[pa.RecordBatch], threshold: float, shared: int, most: int | None) -> Iterator[pa.RecordBatch]:
    """Pairs that meet in a cell, from rows sorted by cell. Rows of cells of more than
    ``most`` rows come out as they are, with their class as ``a``."""
    share = threshold / (1 + threshold)

    def out(cell, a, b, need, size, row) -> pa.RecordBatch:
        nulls = lambda kind: pa.nulls(len(a), kind)
        return pa.record_batch(
            {
                "cell": nulls(pa.int64()) if cell is None else pa.array(cell), "a": pa.array(a), "b": nulls(pa.int64()) if b is None else pa.array(b),
                "need": pa.array(need.astype(np.int32)), "size": pa.array(size.astype(np.int32)), "row": nulls(pa.binary()) if row is None else _packed(row),
            }
        )

    def pairs(cell: np.ndarray, rows: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
        rows, i, j = _near(cell, rows, side, threshold)
        a, b, size = rows["c"][i], rows["c"][j], rows["n"][i].astype(np.int64) + rows["n"][j]
        seldom = (rows["left"][i] < 0) & (rows["left"][j] < 0)
        need = np.where(seldom, np.minimum(shared, np.ceil(share * size - 1e-9)), 1)
        return out(None, np.minimum(a, b), np.maximum(a, b), need, size, None)

    def split(cell: np.ndarray, rows: np.ndarray, side: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole cells."""
        nonlocal held
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        times = np.diff(np.r_[first, len(cell)])
        times = np.repeat(times, times)
        large = times > most if most else np.zeros(len(cell), bool)
        if held is not None:
            large |= cell == held
        if large.any():
            zero = np.zeros(int(large.sum()), np.int32)
            yield out(cell[large], rows["c"][large], None, zero, zero, rows[large])
        keep = ~large & (times > 1)
        if keep.any():
            yield pairs(cell[keep], rows[keep], side[keep])

    held, rest, kept = None, [], 0
    for b in chain(batches, [None]):
        if b is not None and b.num_rows:
            row = b.column("row")
            ends = np.frombuffer(row.buffers()[1], np.int64 if pa.types.is_large_binary(row.type) else np.int32)[row.offset : row.offset + len(row) + 1]
            rows = np.frombuffer(row.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(ROW)
            cell = b.column("cell").to_numpy()
            side = b.column("side").to_numpy() if "side" in b.schema.names else np.full(len(cell), -1, np.int32)
            rest.append((cell, rows.copy(), side))
            kept += len(cell)
        if not rest or (b is not None and kept < AT_ONCE):
            continue
        cell, rows, side = (np.concatenate(x) for x in zip(*rest))
        # the last cell may go on in the next batch
        last = int(np.searchsorted(cell, cell[-1])) if b is not None else len(cell)
        if most and len(cell) - last > most:
            held = cell[-1]
        if last < len(cell) and cell[-1] == held:
            last = len(cell)
        if last:
            yield from split(cell[:last], rows[:last], side[:last])
        rest, kept = ([(cell[last:], rows[last:], side[last:])], 0) if last < len(cell) else ([], 0)


def near_duplicates(
    df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, k: int = 5, min_words: int | None = None, sketch_bits: int = 20, bitmap_bits: int = 24, rare: int = 64, shared: int = 3,
    hot: int = 4096,
) -> tuple[DataFrame, DataFrame]:
    """Links between different texts, and the members of each text.

    Returns ``(links, members)``: links(a, b, similarity) with a < b, classes of
    equal word sequences whose shingle sets have a Jaccard similarity of at
    least ``threshold``; members(id, c) the class of each id with at least
    ``min_words`` words (k if not given).

    Null ids or texts, and shorter texts, take no part; a repeated row counts
    once; equal texts are one class and never compared with each other; an empty
    table gives empty results; no other column is read, whatever its name.
    """
    spark = df.sparkSession
    least = max(k, min_words or k)
    texts = df.select(F.col(id_col).cast("string").alias("_id"), F.col(text_col).alias("_t")).where(f"_id is not null and length(_t) >= {2 * least - 1}")
    freq = spark.sparkContext.broadcast(_frequencies(texts, k, sketch_bits))
    mask = np.uint64((1 << sketch_bits) - 1)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, f = _Words(), set(), freq.value
        bit = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
        for b in batches:
            new = {}  # copies of a text within a task name their cells once
            for w in map(_split, b.column("_t").to_pylist()):
                if len(w) >= least and (c := _class(w)) not in seen:
                    new[c] = w
            seen.update(new)
            if not new:
                continue
            doc, h = _sets(list(new.values()), words, k)
            d, c = len(new), np.fromiter(new, np.int64, len(new))
            n = np.bincount(doc, minlength=d)
            odd = np.bincount(doc * 256 + (h >> np.uint64(56)).astype(np.int64), minlength=d * 256).reshape(d, 4, 64) & 1
            p = (odd * bit).sum(axis=2, dtype=np.uint64)
            count = f[(h & mask).astype(np.int64)]
            o = np.lexsort((h, count, doc))
            h, count = h[o], count[o]
            start = np.concatenate(([0], np.cumsum(n)[:-1]))
            at = np.arange(len(h)) - start[doc]
            strict = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
            prefix = np.minimum(strict + shared - 1, n)
            # a prefix that is seldom throughout names its longer form, any other the one that is enough
            open_ = np.bincount(doc[(at < prefix[doc]) & (count > rare)], minlength=d) == 0
            # a hash seen once in all texts is in no other
            named = (at < np.where(open_, prefix, strict)[doc]) & (count > 1)
            of = doc[named]
            rows = np.empty(len(of), ROW)
            rows["c"], rows["p"], rows["n"] = c[of], p[of], n[of]
            rows["left"] = np.where(open_[of], -n[of], (n[doc] - at)[named])
            yield pa.record_batch({"cell": _mix(h[named] ^ MIX).view(np.int64), "row": _packed(rows)})

    grid = texts.select("_t").mapInArrow(cells, "cell long, row binary").repartition("cell").sortWithinPartitions("cell")
    bound, share = (1 - threshold) / (1 + threshold), threshold / (1 + threshold)
    met_schema = "cell long, a long, b long, need int, size int, row binary"
    met = grid.mapInArrow(partial(_meet, threshold=threshold, shared=shared, most=SPREAD * hot), met_schema)
    # similar texts share at least ``need`` hashes within their prefixes; rows of cells too large for one task come out as they went in
    met = cut(met.groupBy("cell", "a", "b", "size", "row").agg(F.count(F.lit(1)).alias("n"), F.max("need").alias("need")))
    times = met.where("row is null").select("a", "b", "size", "n", "need")
    held = met.where("row is not null").select("cell", "a", "row")
    if not held.isEmpty():
        # such cells are counted and cut into blocks; block i meets block j under a key of their own
        held = held.withColumn("of", F.ceil(F.count(F.lit(1)).over(W.partitionBy("cell")) / (SPREAD * hot)).cast("int"))
        held = held.withColumn("own", F.pmod(F.xxhash64("a"), F.col("of")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
        held = held.select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"), "row")
        more = held.repartition("cell").sortWithinPartitions("cell").mapInArrow(partial(_meet, threshold=threshold, shared=shared, most=None), met_schema)
        times = times.unionByName(more.select("a", "b", "size", F.lit(1).cast("long").alias("n"), "need"))
        times = times.groupBy("a", "b", "size").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    cand = times.where("n >= need").select("a", "b", "size")

    def few(pairs: DataFrame):
        """The classes of the pairs, and a bitmap of them for the workers: its
        size is fixed, what it lets through besides is dropped by the joins."""
        c = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
        at = F.pmod("c", F.lit(1 << bitmap_bits)) + 1
        rows = c.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
        bits = np.zeros(max(1, (1 << bitmap_bits) // 32768) * 4096, np.uint8)
        for r in rows:
            bits[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
        return c, spark.sparkContext.broadcast(bits)

    def among(bits: np.ndarray, c: int) -> bool:
        i = c % (1 << bitmap_bits)
        return bool(bits[i >> 3] >> (i & 7) & 1)

    # long texts outgrow 256 segments: a second look with 2048, before whole sets travel
    long = cand.where(f"size > {LONG}")
    long_classes, only_long = few(long)

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        bit = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
        for b in batches:
            new = {c: w for w in map(_split, b["_t"]) if len(w) >= least and among(only_long.value, c := _class(w))}
            if not new:
                continue
            doc, h = _sets(list(new.values()), words, k)
            odd = np.bincount(doc * 2048 + (h >> np.uint64(53)).astype(np.int64), minlength=len(new) * 2048).reshape(len(new), 32, 64) & 1
            yield pd.DataFrame({"c": list(new), "s": pd.Series(list((odd * bit).sum(axis=2, dtype=np.uint64).view(np.int64)), dtype=object)})

    g = texts.where(f"length(_t) > {LONG // 2}").select("_t").mapInPandas(segments, "c long, s array<long>")
    g = joined(g, long_classes, "c", "left_semi").dropDuplicates(["c"])
    seen = joined(joined(long, g.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a"), g.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b")
    apart = "aggregate(zip_with(sa, sb, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    cand = cut(cand.where(f"size <= {LONG}").select("a", "b").unionByName(seen.where(f"{apart} <= {bound!r} * size + 1e-9").select("a", "b")))

    wanted, only = few(cand)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, done = _Words(), set()
        for b in batches:
            new = {c: w for w in map(_split, b["_t"]) if len(w) >= least and (c := _class(w)) not in done and among(only.value, c)}
            done.update(new)
            if not new:
                continue
            doc, h = _sets(list(new.values()), words, k)
            cuts = np.cumsum(np.bincount(doc, minlength=len(new)))[:-1]
            yield pd.DataFrame({"c": list(new), "h": pd.Series(np.split(h.view(np.int64), cuts), dtype=object)})

    def member(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            w = [_split(t) for t in b["_t"]]
            keep = [len(x) >= least for x in w]
            yield pd.DataFrame({"id": b["_id"][keep], "c": [_class(x) for x, ok in zip(w, keep) if ok]})

    s = joined(texts.select("_t").mapInPandas(sets, "c long, h array<long>"), wanted, "c", "left_semi").groupBy("c").agg(F.first("h").alias("h"))
    both = joined(joined(cand, s.select(F.col("c").alias("a"), F.col("h").alias("ha")), "a"), s.select(F.col("c").alias("b"), F.col("h").alias("hb")), "b")
    both = both.withColumn("_i", F.size(F.array_intersect("ha", "hb")))
    both = both.withColumn("similarity", F.col("_i") / (F.size("ha") + F.size("hb") - F.col("_i")))
    links = both.where(f"similarity >= {threshold} - 1e-12").select("a", "b", "similarity")
    return links, cut(texts.mapInPandas(member, "id string, c long").distinct())


def pairs_of_members(links: DataFrame, members: DataFrame) -> DataFrame:
    """(left, right) with left < right: all pairs of ids in linked or equal classes."""
    many = members.groupBy("c").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("c")
    within = joined(members, many, "c", "left_semi")
    same = joined(within.select(F.col("id").alias("x"), "c"), within.select(F.col("id").alias("y"), "c"), "c").where("x < y").select(F.col("x").alias("left"), F.col("y").alias("right"))
    ends = cut(links.select("a", "b"))
    members = joined(members, ends.select(F.explode(F.array("a", "b")).alias("c")).distinct(), "c", "left_semi")
    x, y = members.select(F.col("id").alias("x"), F.col("c").alias("a")), members.select(F.col("id").alias("y"), F.col("c").alias("b"))
    across = joined(joined(ends, x, "a"), y, "b").where("x <> y").select(F.least("x", "y").alias("left"), F.greatest("x", "y").alias("right"))
    return same.unionByName(across).distinct()


def classes(links: DataFrame, members: DataFrame) -> DataFrame:
    """(id, class, links): one row per id; class is the least id that is reached
    by links, links the number of other texts linked to its text."""
    deg = links.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("links"))
    comp = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))).select(F.col("node").alias("c"), "component")
    m = joined(joined(members, comp, "c", "left"), deg, "c", "left").withColumn("component", F.coalesce("component", "c"))
    low = m.groupBy("component").agg(F.min("id").alias("class"))
    return joined(m, low, "component").select("id", "class", F.coalesce("links", F.lit(0)).alias("links"))


def similarity(a: str, b: str, k: int) -> float:
    """Plain Jaccard of word runs; what the operator must agree with."""
    import re

    def runs(t):
        w = re.findall("[a-z0-9]+", t.lower())
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y) if x | y else math.nan


def p4_found(spark, sf):
    from lexgrain.session import load

    links, members = near_duplicates(load(spark, sf, "chunks"), "id", "text", threshold=0.6, k=3, min_words=30)
    return pairs_of_members(links, members).select(F.col("left").alias("left_id"), F.col("right").alias("right_id"))


def p4_classes(spark, sf):
    from lexgrain.session import load

    links, members = near_duplicates(load(spark, sf, "chunks"), "id", "text", threshold=0.6, k=3, min_words=30)
    return classes(cut(links), members)


QUERIES = {"p4_found": (p4_found, None), "p4_classes": (p4_classes, None)}
