"""Cutting oversized texts where their vocabulary changes.

Lexical cohesion: between any two sentences the word counts of the blocks
before and after are compared; where the similarity falls into a valley, the
topic changes. A piece ends at the deepest valley within its size window, and the
next piece starts with the last tokens of the one before.

Sizes follow the project rule of the data: tokens = characters div 4.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHARS = 4
#: sentence ends (full stop, question and exclamation mark, danda) and line ends
ENDS = re.compile(r"(?:[.!?।]['\")\]]*(?=\s)|\n)\s*|\f\s*")
WORDS = re.compile(r"\w+")


def _valleys(text: str, cuts: list[int], block: int) -> list[float]:
    """Depth of the cohesion valley at each cut: how far the similarity of the
    ``block`` sentences before and after rises again on either side."""
    bounds = [0, *cuts, len(text)]
    bags = [Counter(w for w in WORDS.findall(text[a:b].lower()) if len(w) > 3) for a, b in zip(bounds, bounds[1:])]
    left, right = Counter(), Counter()
    for b in bags[1 : 1 + block]:
        right.update(b)
    left.update(bags[0])
    sims = []
    for i in range(len(cuts)):
        dot = sum(v * right[w] for w, v in left.items() if w in right)
        norm = math.sqrt(sum(v * v for v in left.values()) * sum(v * v for v in right.values()))
        sims.append(dot / norm if norm else 0.0)
        left.update(bags[i + 1])
        if i + 1 - block >= 0:
            left.subtract(bags[i + 1 - block])
            left += Counter()
        right.subtract(bags[i + 1])
        right += Counter()
        if i + 1 + block < len(bags):
            right.update(bags[i + 1 + block])
    depth = []
    for i, s in enumerate(sims):
        up = s
        for j in range(i - 1, -1, -1):
            if sims[j] < up:
                break
            up = sims[j]
        down = s
        for j in range(i + 1, len(sims)):
            if sims[j] < down:
                break
            down = sims[j]
        depth.append(up - s + down - s)
    return depth


def pieces(text: str, limit: int = 1500, overlap: int = 150, block: int = 4) -> list[tuple[int, int]]:
    """Character spans of the pieces of ``text``.

    Every piece has at most ``limit`` tokens; each piece but the first starts
    ``overlap`` tokens before the end of the one before (a little more, to start
    with a whole word, if one starts within 40 characters); together they cover
    the text. A text within the limit is one piece, an empty one has none. Cuts
    lie at the deepest valley between sentences in the second half of the window,
    else at the last white space, else at the limit.
    """
    if overlap < 0 or limit < 2 * overlap + 20:
        raise ValueError("the limit must be more than twice the overlap")
    n, most, back = len(text), limit * CHARS + CHARS - 1, overlap * CHARS
    if not n:
        return []
    if n <= most:
        return [(0, n)]
    cuts = [m.end() for m in ENDS.finditer(text) if 0 < m.end() < n]
    depth = dict(zip(cuts, _valleys(text, cuts, block)))
    out, start, k = [], 0, 0
    while n - start > most:
        lo, hi = start + max(most // 2, back + 60), start + most
        while k < len(cuts) and cuts[k] < lo:
            k += 1
        j, best = k, None
        while j < len(cuts) and cuts[j] <= hi:
            # among equal valleys the later one; an end of paragraph counts as a little deeper
            d = depth[cuts[j]] + (0.1 if text[cuts[j] - 1] == "\n" else 0)
            if best is None or d >= best[0]:
                best = (d, cuts[j])
            j += 1
        if best:
            end = best[1]
        else:
            gap = max((text.rfind(c, lo, hi) for c in " \t\n "), default=-1)
            end = gap + 1 if gap >= lo else hi
        out.append((start, end))
        nxt = end - back
        if overlap:
            for p in range(nxt, max(nxt - 40, start + 1), -1):
                if not text[p].isspace() and text[p - 1].isspace():
                    nxt = p
                    break
        start = nxt
        k = 0 if k == 0 else k - 1
        while k > 0 and cuts[k - 1] > start:
            k -= 1
    out.append((start, n))
    return out


def split_oversized(df: DataFrame, id_cols: list[str], text_col: str, limit: int = 1500, overlap: int = 150) -> DataFrame:
    """id columns, piece (from 0), start, length, tokens, text of every row whose
    text exceeds the limit; see :func:`pieces`.

    The size test runs in the JVM on the text itself, never on a stored count;
    rows within the limit and null texts never reach Python. Repeated rows
    (equal ids and text) count once; null ids are kept; an empty table gives an
    empty result; other columns aren't read, whatever their names.
    """
    names = [f"_k{i}" for i in range(len(id_cols))]
    big = df.select(*[F.col(c).alias(n) for c, n in zip(id_cols, names)], F.col(text_col).alias("_t"))
    big = big.where(f"length(_t) div {CHARS} > {limit}")
    # few rows are left: spread them by content, and drop repeats on the way
    big = big.withColumn("_h", F.xxhash64("_t")).dropDuplicates([*names, "_h"]).drop("_h")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                *key, t = r
                rows += [(*key, i, a, e - a, (e - a) // CHARS, t[a:e]) for i, (a, e) in enumerate(pieces(t, limit, overlap))]
            if rows:
                yield pd.DataFrame(rows, columns=[*names, "piece", "start", "length", "tokens", "text"])

    kinds = dict(df.dtypes)
    schema = ", ".join(f"{n} {kinds[c]}" for n, c in zip(names, id_cols)) + ", piece int, start int, length int, tokens int, text string"
    out = big.mapInPandas(cut, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, id_cols)], "piece", "start", "length", "tokens", "text")


def _both(spark, sf):
    from lexgrain.session import load

    s = load(spark, sf, "sections").select(F.lit("section").alias("rec"), F.col("section_id").alias("rec_id"), "text")
    return s.unionByName(load(spark, sf, "chunks").select(F.lit("chunk").alias("rec"), F.col("id").alias("rec_id"), "text"))


def p5_found(spark, sf):
    return split_oversized(_both(spark, sf), ["rec", "rec_id"], "text").where("piece = 0").select("rec", "rec_id").distinct()


def p5_pieces(spark, sf):
    return split_oversized(_both(spark, sf), ["rec", "rec_id"], "text")


P5_SQL = """
SELECT DISTINCT rec, rec_id FROM (SELECT 'section' AS rec, section_id AS rec_id, text FROM sections
UNION ALL SELECT 'chunk', id, text FROM chunks) WHERE length(text) // 4 > 1500
"""

QUERIES = {"p5_found": (p5_found, P5_SQL), "p5_pieces": (p5_pieces, None)}
