"""Exact nearest vectors of a stated set of queries, block by block.

Rows and queries are dealt into blocks of bounded size; a task multiplies one block
of each as matrices and keeps the k best of its rows for each of its queries, so what
is shuffled afterwards is k rows per query and block, whatever the number of vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.operators.lexical import top


def _unit(col: pd.Series, dims: int | None) -> np.ndarray:
    m = np.stack(col.to_numpy()).astype(np.float64)[:, :dims]
    n = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def nearest(corpus: DataFrame, queries: DataFrame, k: int, dims: int | None = None, block_rows: int = 65_536, query_block: int = 8192) -> DataFrame:
    """(query, id, score, rank): of corpus(id, v) the k rows of the highest cosine
    (six digits, ties to the smaller id) for each of queries(query, qv); the first
    ``dims`` numbers only, if given. All vectors have one length; an all-zero one is
    like none. Empty tables give an empty result."""
    d, b = max(1, math.ceil(corpus.count() / block_rows)), max(1, math.ceil(queries.count() / query_block))
    deal = lambda c, n, other, m, seed: (F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(n)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))
    db, qx = deal("id", d, "qb", b, 1)
    qb, dx = deal("query", b, "db", d, 2)
    rows = corpus.select("id", "v", db.alias("db"), qx)
    ask = queries.select("query", "qv", qb.alias("qb"), dx)
    kinds = (dict(queries.dtypes)["query"], dict(corpus.dtypes)["id"])

    def best(r: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(r) and len(q):
            r = r.sort_values("id", kind="stable")
            ids, m = r["id"].to_numpy(), _unit(r["v"], dims)
            for at in range(0, len(q), 256):
                part = q.iloc[at : at + 256]
                score = np.round(_unit(part["qv"], dims) @ m.T, 6)
                for name, s in zip(part["query"], score):
                    # all that reach the k-th, then in order; ids are sorted, so a stable sort breaks ties
                    hit = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k]) if k < len(s) else np.arange(len(s))
                    hit = hit[np.argsort(-s[hit], kind="stable")[:k]]
                    out.append(pd.DataFrame({"query": name, "id": ids[hit], "score": s[hit]}))
        return pd.concat(out) if out else pd.DataFrame({"query": q["query"].iloc[:0].to_numpy(), "id": r["id"].iloc[:0].to_numpy(), "score": np.zeros(0)})

    found = rows.groupBy("db", "qb").cogroup(ask.groupBy("db", "qb")).applyInPandas(best, f"query {kinds[0]}, id {kinds[1]}, score double")
    return top(found, "query", "score", "id", k)
