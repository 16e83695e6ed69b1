"""Search channels, fusion and context expansion over plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.functions.text import tokens
from lexgrain.functions.vector import cosine
from lexgrain.operators import dense, lexical
from lexgrain.operators.lexical import saturation, top

# ------------------------------------------------------------------ BM25


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf, dl); null and empty texts have no postings."""
    d = docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("t")).where("size(t) > 0")
    return d.select("id", F.size("t").alias("dl"), F.explode("t").alias("term")).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))


def corpus_stats(docs: DataFrame, text_col: str) -> DataFrame:
    """One row (n, avgdl): texts with at least one token, and their mean length."""
    return docs.select(F.size(tokens(F.col(text_col))).alias("dl")).where("dl > 0").agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))


def term_stats(posts: DataFrame, stats: DataFrame) -> DataFrame:
    """(term, df, idf)."""
    df = posts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.crossJoin(F.broadcast(stats)).select("term", "df", lexical.idf(F.col("n"), F.col("df")).alias("idf"))


def bm25_weights(posts: DataFrame, terms: DataFrame, stats: DataFrame) -> DataFrame:
    """(id, term, weight) of every posting."""
    p = posts.join(terms, "term").crossJoin(F.broadcast(stats))
    return p.select("id", "term", (F.col("idf") * saturation(F.col("tf"), F.col("dl"), F.col("avgdl"))).alias("weight"))


def bm25_search(docs: DataFrame, id_col: str, text_col: str, queries: DataFrame, qid: str, qtext: str, k: int, common: float = 0.05, square_idf: bool = True) -> DataFrame:
    """:func:`lexgrain.operators.lexical.search` over an index made for the purpose."""
    return lexical.search(lexical.build(docs, id_col, text_col), queries, qid, qtext, k, common, square_idf)


# --------------------------------------------------------------- vectors


def dense_two_stage(corpus: DataFrame, id_col: str, vec_col: str, queries: DataFrame, qid: str, qvec: str, dims: int, first: int, k: int) -> DataFrame:
    """(query, id, score, rank): the ``first`` nearest by the leading ``dims``
    numbers, then the k nearest of these by the whole vectors."""
    q = queries.select(F.col(qid).alias("query"), F.col(qvec).alias("qv"))
    near = dense.nearest(corpus.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")), q, first, dims).select("query", "id")
    full = near.join(corpus.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")), "id").join(q.select("query", "qv"), "query")
    return top(full.select("query", "id", F.round(cosine(F.col("v"), F.col("qv")), 6).alias("score")), "query", "score", "id", k)


# ---------------------------------------------------------------- fusion


def rank_fusion(hits: DataFrame, k: int = 60, limit: int = 150) -> DataFrame:
    """Reciprocal rank fusion of (query, channel, id, score, rank).

    Every hit adds 1 / (k + rank), also repeated ones of a channel; ``channels``
    lists the channels of a document's hits, ``source`` the channel of its
    highest raw score (the first by name of equals). ``limit`` <= 0 gives nothing.
    """
    g = hits.groupBy("query", "id").agg(
        F.round(F.sum(1 / (F.lit(k) + F.col("rank"))), 9).alias("score"),
        F.array_sort(F.collect_list("channel")).alias("channels"),
        F.expr("min_by(channel, struct(-score, channel))").alias("source"),
    )
    return top(g, "query", "score", "id", limit) if limit > 0 else g.limit(0).withColumn("rank", F.lit(0))


def overlap_rerank(hits: DataFrame, queries: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """Offline stand-in for a cross encoder: share of the query's distinct tokens
    that the text has; ties keep the earlier rank. hits(query, id, rank),
    queries(query, qtext), docs(id, text)."""
    j = hits.select("query", "id", F.col("rank").alias("before")).join(queries, "query").join(docs, "id")
    q = F.array_distinct(tokens(F.col("qtext")))
    share = F.when(F.size(q) > 0, F.size(F.array_intersect(q, tokens(F.coalesce(F.col("text"), F.lit(""))))) / F.size(q)).otherwise(F.lit(0.0))
    j = j.select("query", "id", "before", F.round(share, 6).alias("score"))
    w = W.partitionBy("query").orderBy(F.desc("score"), F.asc("before"), F.asc("id"))
    return j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ------------------------------------------------------------- expansion


def expand_within_budget(hits: DataFrame, budget: int) -> DataFrame:
    """Keep or drop the surroundings of ranked hits under a token budget.

    hits(query, id, rank, own, extra): tokens of the text and of its parent and
    header. From the first hit on that has surroundings and would overflow with
    them, that hit and all later ones keep only their own text; the running total
    goes on. Result: (query, id, rank, keep, running). A fold over the ranked hits of
    a query, bounded by their number.
    """
    rows = F.array_sort(F.collect_list(F.struct("rank", "id", "own", "extra")))
    start = F.expr("named_struct('total', 0L, 'shut', false, 'out', cast(array() as array<struct<rank: int, id: string, keep: boolean, running: bigint>>))")

    def step(acc, x):
        whole = acc["total"] + x["own"] + x["extra"]
        shut = acc["shut"] | ((x["extra"] > 0) & (whole > budget))
        total = F.when(shut, acc["total"] + x["own"]).otherwise(whole)
        row = F.struct(x["rank"].cast("int").alias("rank"), x["id"].cast("string").alias("id"), (~shut & (x["extra"] > 0)).alias("keep"), total.cast("bigint").alias("running"))
        return F.struct(total.cast("bigint").alias("total"), shut.alias("shut"), F.concat(acc["out"], F.array(row)).alias("out"))

    g = hits.groupBy("query").agg(rows.alias("rows"))
    folded = g.select("query", F.explode(F.aggregate("rows", start, step, lambda a: a["out"])).alias("r"))
    return folded.select("query", "r.id", "r.rank", "r.keep", "r.running")


def unseen(candidates: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a further retrieval whose keys are new."""
    return candidates.join(seen.select(*keys).distinct(), keys, "left_anti")


# ----------------------------------------------------------------- cache


def cache_lookup(queries: DataFrame, cache: DataFrame, threshold: float, now: str) -> DataFrame:
    """Best live entry per query with cosine >= threshold.

    queries(query, v), cache(key, v, response, cached_at, ttl_seconds). An
    expired entry or one without a response is no hit.
    """
    live = cache.where(F.col("response").isNotNull() & (F.col("cached_at") + F.make_interval(secs=F.col("ttl_seconds")) > F.lit(now).cast("timestamp")))
    best = dense.nearest(live.select(F.col("key").alias("id"), "v"), queries.select("query", F.col("v").alias("qv")), 1)
    return best.where(F.col("score") >= threshold).select("query", F.col("id").alias("key"), "score")


def cache_set(cache: DataFrame, entries: DataFrame, now: str, ttl_seconds: int = 86_400) -> DataFrame:
    """The cache with new entries(key, v, response, acts_cited), a day to live; one of
    the same key is replaced, an entry without a response isn't stored."""
    new = entries.where("response is not null").select("key", "v", "response", F.lit(now).cast("timestamp").alias("cached_at"), F.lit(ttl_seconds).alias("ttl_seconds"), "acts_cited")
    return cache.select(*new.columns).join(new.select("key"), "key", "left_anti").unionByName(new)


def cache_invalidate(cache: DataFrame, act: str) -> DataFrame:
    """The cache without the entries that cite an act."""
    return cache.where(~F.coalesce(F.array_contains("acts_cited", act), F.lit(False)))
