"""Encoding of a corpus through a minimal acyclic transducer of frequent words.

The words of the corpus (by the tokenizer's own split) are counted over all
texts; the most frequent are encoded once and compiled into an automaton whose
states share equal suffixes. Arcs carry numbers, whose sum along a word's path is
the word's place in a table of id lists. The arrays are written into the shared
folder and memory-mapped by all workers of a machine; words outside of it are
merged exactly by the ranks.
"""

from __future__ import annotations

import base64
import heapq
import os
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrain.session import checkpoint_dir

#: where the public vocabulary files lie, unless a path is given
TOKENIZERS = "/opt/tokenizers"
#: fixed value: the split that belongs to the rank files
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the adjacent pair of lowest rank is joined, leftmost
    first, until no pair is in the vocabulary. A heap keeps it near linear."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    part: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, part[i] + part[i + 1]) for i in range(n - 1) if (r := ranks.get(part[i] + part[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = nxt[i]
        if part[i] is None or j >= n or part[i] + part[j] != joined:
            continue  # one of the two has been merged meanwhile
        part[i], part[j] = joined, None
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        for a, b in ((prv[i], i), (i, nxt[i])):
            if a >= 0 and b < n and (r := ranks.get(part[a] + part[b])) is not None:
                heapq.heappush(heap, (r, a, part[a] + part[b]))
    return [ranks[p] for p in part if p is not None]


class Transducer:
    """Word -> place in sorted order, as flat arrays.

    ``key`` (state * 256 + byte, sorted), ``to`` and ``out`` describe the arcs,
    ``final`` the states where a word may end; state 0 is the start.
    """

    FIELDS = ("key", "to", "out", "final", "offsets", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        for f in self.FIELDS:
            setattr(self, f, arrays[f])

    @classmethod
    def compile(cls, entries: dict[bytes, list[int]]) -> Transducer:
        words = sorted(entries)
        register: dict[tuple, int] = {}  # (final, arcs) -> state with that right language
        count: list[int] = []  # words below each registered state
        rows: list[tuple] = []

        def freeze(node) -> int:
            sig = (node[0], tuple(node[1]))
            if sig not in register:
                register[sig] = len(rows)
                rows.append(sig)
                count.append(int(node[0]) + sum(count[t] for _, t in node[1]))
            return register[sig]

        path = [[False, []]]  # unfrozen states along the last word: [final, arcs]
        last = b""
        for w in words:
            same = os.path.commonprefix([last, w])
            for i in range(len(last), len(same), -1):
                node = path.pop()
                path[-1][1].append((last[i - 1], freeze(node)))
            path += [[False, []] for _ in w[len(same) :]]
            path[-1][0] = True
            last = w
        for i in range(len(last), 0, -1):
            node = path.pop()
            path[-1][1].append((last[i - 1], freeze(node)))
        start = freeze(path[0])
        # the start becomes state 0
        number = {start: 0} | {s: i + 1 for i, s in enumerate(x for x in range(len(rows)) if x != start)}
        key, to, out = [], [], []
        final = np.zeros(len(rows), bool)
        for s, (end, arcs) in enumerate(rows):
            final[number[s]] = end
            seen = int(end)
            for byte, t in arcs:
                key.append(number[s] * 256 + byte)
                to.append(number[t])
                out.append(seen)
                seen += count[t]
        o = np.argsort(np.array(key, np.int64)) if key else np.zeros(0, np.int64)
        lens = [len(entries[w]) for w in words]
        return cls({
            "key": np.array(key, np.int64)[o], "to": np.array(to, np.int32)[o], "out": np.array(out, np.int32)[o], "final": final,
            "offsets": np.concatenate(([0], np.cumsum(lens))).astype(np.int64), "ids": np.array(list(chain.from_iterable(entries[w] for w in words)), np.int32),
        })

    def places(self, words: list[bytes]) -> np.ndarray:
        """Places of many words at once, -1 for words it lacks: all walk in step,
        one byte at a time."""
        n = len(words)
        at, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)
        lens = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(lens) - lens
        live = np.flatnonzero(lens > 0)
        dead = np.zeros(n, bool)
        step = 0
        while len(live) and len(self.key):
            k = at[live] * 256 + flat[begin[live] + step]
            pos = np.minimum(np.searchsorted(self.key, k), len(self.key) - 1)
            ok = self.key[pos] == k
            dead[live[~ok]] = True
            live, pos = live[ok], pos[ok]
            at[live] = self.to[pos]
            sums[live] += self.out[pos]
            step += 1
            live = live[lens[live] > step]
        bad = dead | ~self.final[at] | (lens == 0) | (len(self.key) == 0)
        return np.where(bad, -1, sums)

    def lookup(self, place: int) -> list[int]:
        return self.ids[self.offsets[place] : self.offsets[place + 1]].tolist()


def _shared_file(spark: SparkSession, t: Transducer):
    """Where workers find the automaton: a file in the shared checkpoint folder,
    if that is a mounted one, else a broadcast of the same bytes."""
    at = urlparse(checkpoint_dir(spark))
    arrays = {f: getattr(t, f) for f in Transducer.FIELDS}
    if at.scheme in ("", "file"):
        folder = os.path.join(at.path, f"lexicon-{uuid.uuid4().hex}")
        os.makedirs(folder)
        for f, a in arrays.items():
            np.save(os.path.join(folder, f"{f}.npy"), a)
        return lambda: Transducer({f: np.load(os.path.join(folder, f"{f}.npy"), mmap_mode="r") for f in Transducer.FIELDS})
    shared = spark.sparkContext.broadcast(arrays)
    return lambda: Transducer(shared.value)


def word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(word, n) over all texts; each task adds up its own words first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, c = regex.compile(SPLIT).findall, Counter()
        flush = lambda: pd.DataFrame({"word": list(c), "n": list(c.values())})
        for b in batches:
            for t in b["_t"]:
                c.update(find(t))
            if len(c) > 500_000:
                yield flush()
                c.clear()
        if c:
            yield flush()

    t = df.select(F.col(text_col).alias("_t")).where("_t is not null and _t <> ''")
    return t.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _encoder(df: DataFrame, text_col: str, ranks_path: str | None, lexicon_size: int):
    """A function for workers that gives ``ids(word list) -> dict``-like lookups."""
    spark = df.sparkSession
    ranks = read_ranks(ranks_path or os.path.join(TOKENIZERS, "byte_bpe_50k.tiktoken"))
    top = word_counts(df, text_col).where("n > 1").orderBy(F.desc("n"), "word").limit(lexicon_size).collect()
    words = [r["word"].encode() for r in top]
    open_lexicon = _shared_file(spark, Transducer.compile({w: merge(w, ranks) for w in words}))
    shared = spark.sparkContext.broadcast(ranks)

    class Memo(dict):
        """Ids of the words met in this task."""

        def __init__(self):
            self.lexicon = open_lexicon()

        def learn(self, words: set[str]) -> None:
            if len(self) > 1_000_000:
                self.clear()
            new = [w for w in words if w not in self]
            raw = [w.encode() for w in new]
            for w, b, p in zip(new, raw, self.lexicon.places(raw)):
                self[w] = self.lexicon.lookup(p) if p >= 0 else merge(b, shared.value)

    return Memo


def encode(df: DataFrame, id_col: str, text_col: str, ranks_path: str | None = None, lexicon_size: int = 50_000, count_only: bool = False) -> DataFrame:
    """(id, ids) or, with ``count_only``, (id, tokens) of every row.

    Texts are encoded as they stand: strings that look like special tokens are
    ordinary text. Null and empty texts both give an empty list (0 tokens). One
    row out per row in, ids of rows may be null or repeat; other columns aren't
    read. The lexicon changes speed only, never the result.
    """
    memo = _encoder(df, text_col, ranks_path, lexicon_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, known = regex.compile(SPLIT).findall, memo()
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                split = [find(t) if t else [] for t in b.column(1).to_pylist()]
                known.learn(set(chain.from_iterable(split)))
                if count_only:
                    col = pa.array([sum(map(len, map(known.__getitem__, s))) for s in split], pa.int32())
                else:
                    rows = [list(chain.from_iterable(map(known.__getitem__, s))) for s in split]
                    lens = np.fromiter(map(len, rows), np.int32, len(rows))
                    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(lens.sum()))
                    offsets = np.concatenate(([0], np.cumsum(lens))).astype(np.int32)
                    col = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b.column(0), col], ["id", "ids"])

    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids {'int' if count_only else 'array<int>'}")
    return out.select("id", F.col("ids").alias("tokens")) if count_only else out


def p8_ids(spark, sf):
    from lexgrain.session import load

    return encode(load(spark, sf, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id"), "ids")


QUERIES = {"p8_ids": (p8_ids, None)}
