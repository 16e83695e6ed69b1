"""Queries on the index: term statistics, search channels, fusion, expansion."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.functions.text import tokens
from lexgrain.functions.vector import cosine, head
from lexgrain.operators import dense as D
from lexgrain.operators import lexical as L
from lexgrain.operators import retrieval as R
from lexgrain.session import cut, load, stamp


def _chunks(spark, sf):
    """Each chunk once (a chunk delivered again has the same text)."""
    return load(spark, sf, "chunks").select("id", "text").where("text is not null").dropDuplicates(["id", "text"])


def _asked(spark, sf):
    """The stated query set: every query whose id is divisible by 100."""
    return load(spark, sf, "queries").where("query_id % 100 = 0 and text is not null").groupBy("query_id").agg(F.max("text").alias("qtext"))


_INDEXES: dict[tuple[str, ...], L.LexicalIndex] = {}


def text_index(spark, sf, column="text"):
    """The stored index of the chunks' texts, or contextualised texts: built once for
    a state of the table, then read by all searches of the session."""
    key = (spark.sparkContext.applicationId, column, sf, stamp(spark, f"{sf}/chunks.parquet"))
    if key not in _INDEXES:
        _INDEXES[key] = L.build(load(spark, sf, "chunks").select("id", F.col(column).alias("text")), "id", "text")
    return _INDEXES[key]


def found(spark, sf, k, column="text"):
    """The k best chunks of every stated query."""
    return L.search(text_index(spark, sf, column), _asked(spark, sf), "query_id", "qtext", k)


def texts_of(spark, sf, hits):
    """Each chunk of some hits(id) once; only their texts are moved."""
    return load(spark, sf, "chunks").select("id", "text").where("text is not null").join(L.small(hits.select("id").distinct()), "id", "left_semi").dropDuplicates(["id", "text"])


C = "c AS (SELECT DISTINCT id, text FROM chunks WHERE text IS NOT NULL)"
P = C + """, tok AS (SELECT id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM c),
d AS (SELECT id, len(t) AS dl, t FROM tok WHERE len(t) > 0),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM d),
p AS (SELECT id, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT id, dl, unnest(t) AS term FROM d) GROUP BY id, term),
ts AS (SELECT term, count(*) AS df, ln((n - count(*) + 0.5) / (count(*) + 0.5) + 1) AS idf, avgdl FROM p, st GROUP BY term, n, avgdl)"""
Q = "q AS (SELECT query_id, max(text) AS qtext FROM queries WHERE query_id % 100 = 0 AND text IS NOT NULL GROUP BY query_id)"


def bm25_term_stats(spark, sf):
    c = _chunks(spark, sf)
    return R.term_stats(R.postings(c, "id", "text"), R.corpus_stats(c, "text")).select("term", "df", F.round("idf", 6).alias("idf"))


def bm25_weights(spark, sf):
    w = L.weights(text_index(spark, sf))
    return w.select("id", "terms", F.round("total", 4).alias("total"), F.round("most", 4).alias("most"))


def bm25_topk(spark, sf):
    return found(spark, sf, 10).select("query", "id", "score", F.col("rank").cast("bigint").alias("rank"))


BM25_SQL = P + ", " + Q + """, qt AS (SELECT query_id, len(t) AS ql, unnest(t) AS term FROM (SELECT query_id, regexp_extract_all(lower(qtext), '[a-z0-9]+') AS t FROM q)),
qf AS (SELECT query_id, term, count(*) AS qtf, any_value(ql) AS ql FROM qt GROUP BY query_id, term),
sc AS (SELECT qf.query_id AS query, p.id, round(sum(ts.idf * qtf * 2.2 / (qtf + 1.2 * (0.25 + 0.75 * ql / greatest(avgdl, 1.0)))
  * ts.idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / greatest(avgdl, 1.0)))), 6) AS score
  FROM qf JOIN ts USING (term) JOIN p USING (term) GROUP BY ALL),
bm AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM sc WHERE score > 0)"""


def matryoshka_slice(spark, sf):
    e = load(spark, sf, "embeddings")
    return e.select("vec_id", F.transform(head(F.col("embedding"), 16), lambda x: F.round(x, 6)).alias("fast"))


def _query_vectors(spark, sf):
    ok = "query_id % 100 = 0 and size(query_embedding) = 64 and not exists(query_embedding, e -> e is null or isnan(e)) and exists(query_embedding, e -> e <> 0)"
    return load(spark, sf, "queries").where(ok).groupBy("query_id").agg(F.max("query_embedding").alias("qv"))


QV = """qv AS (SELECT query_id, max(query_embedding)::DOUBLE[] AS v FROM queries WHERE query_id % 100 = 0 AND len(query_embedding) = 64
  AND NOT list_bool_or(list_transform(query_embedding, lambda e: e IS NULL OR isnan(e))) AND list_bool_or(list_transform(query_embedding, lambda e: e <> 0)) GROUP BY query_id)"""


def dense_top_k(spark, sf):
    e, q = load(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")), _query_vectors(spark, sf).select(F.col("query_id").alias("query"), "qv")
    return D.nearest(e, q, 10).withColumn("rank", F.col("rank").cast("bigint"))


def dense_two_stage(spark, sf):
    out = R.dense_two_stage(load(spark, sf, "embeddings"), "vec_id", "embedding", _query_vectors(spark, sf), "query_id", "qv", 16, 200, 20)
    return out.select("query", "id", "score", F.col("rank").cast("bigint").alias("rank"))


def _channels(spark, sf):
    """Two rankings of chunks for the stated queries: term search over the text
    and over the contextualised text."""
    one = found(spark, sf, 50).withColumn("channel", F.lit("text"))
    two = found(spark, sf, 50, "contextualized_text").withColumn("channel", F.lit("context"))
    return one.unionByName(two)


def rrf_fusion(spark, sf):
    f = R.rank_fusion(_channels(spark, sf), 60, 20)
    return f.select("query", "id", "score", F.array_join("channels", ",").alias("channels"), "source", F.col("rank").cast("bigint").alias("rank"))


RRF_SQL = "WITH " + BM25_SQL + ", " + """c2 AS (SELECT DISTINCT id, contextualized_text AS text FROM chunks WHERE contextualized_text IS NOT NULL),
tok2 AS (SELECT id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM c2),
d2 AS (SELECT id, len(t) AS dl, t FROM tok2 WHERE len(t) > 0),
st2 AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM d2),
p2 AS (SELECT id, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT id, dl, unnest(t) AS term FROM d2) GROUP BY id, term),
ts2 AS (SELECT term, count(*) AS df, ln((n - count(*) + 0.5) / (count(*) + 0.5) + 1) AS idf, avgdl FROM p2, st2 GROUP BY term, n, avgdl),
sc2 AS (SELECT qf.query_id AS query, p2.id, round(sum(ts2.idf * qtf * 2.2 / (qtf + 1.2 * (0.25 + 0.75 * ql / greatest(avgdl, 1.0)))
  * ts2.idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / greatest(avgdl, 1.0)))), 6) AS score
  FROM qf JOIN ts2 USING (term) JOIN p2 USING (term) GROUP BY ALL),
bm2 AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM sc2 WHERE score > 0),
hits AS (SELECT query, id, score, rank, 'text' AS channel FROM bm WHERE rank <= 50 UNION ALL SELECT query, id, score, rank, 'context' FROM bm2 WHERE rank <= 50),
f AS (SELECT query, id, round(sum(1.0 / (60 + rank)), 9) AS score, string_agg(channel, ',' ORDER BY channel) AS channels,
  first(channel ORDER BY score DESC, channel) AS source FROM hits GROUP BY query, id),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM f)
SELECT query, id, score, channels, source, rank FROM r WHERE rank <= 20"""


def rerank_overlap(spark, sf):
    hits = found(spark, sf, 50)
    out = R.overlap_rerank(hits, _asked(spark, sf).withColumnRenamed("query_id", "query"), texts_of(spark, sf, hits), 20)
    return out.select("query", "id", "score", F.col("rank").cast("bigint").alias("rank"))


RERANK_SQL = "WITH " + BM25_SQL + """, j AS (SELECT bm.query, bm.id, bm.rank AS before,
  list_distinct(regexp_extract_all(lower(q.qtext), '[a-z0-9]+')) AS qt, regexp_extract_all(lower(c.text), '[a-z0-9]+') AS t
  FROM bm JOIN q ON q.query_id = bm.query JOIN c USING (id) WHERE bm.rank <= 50),
s AS (SELECT query, id, before, round(len(list_filter(qt, lambda x: list_contains(t, x))) * 1.0 / len(qt), 6) AS score FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, before, id) AS rank FROM s)
SELECT query, id, score, rank FROM r WHERE rank <= 20"""


def _once(spark, sf, ids):
    """The wanted chunks(id), each once: tokens, parent, header."""
    c = load(spark, sf, "chunks").select("id", F.expr("length(text) div 4").alias("tok"), "parent_info.parent_chunk_id", "parent_info.judgment_header_chunk_id")
    return c.join(L.small(ids.distinct()), "id", "left_semi").groupBy("id").agg(F.max("tok").alias("tok"), F.max("parent_chunk_id").alias("parent"), F.max("judgment_header_chunk_id").alias("header"))


def with_surroundings(spark, sf, hits):
    """(query, id, rank, own, extra): tokens of ranked hits, and of their parents and
    headers. Only these chunks are moved."""
    c = cut(_once(spark, sf, hits.select("id")))
    around = c.select(F.explode(F.array("parent", "header")).alias("id")).where("id is not null")
    size = cut(_once(spark, sf, around).select("id", F.coalesce("tok", F.lit(0)).alias("tok")))
    j = hits.join(c, "id").join(size.select(F.col("id").alias("parent"), F.col("tok").alias("pt")), "parent", "left")
    j = j.join(size.select(F.col("id").alias("header"), F.col("tok").alias("ht")), "header", "left")
    return j.select("query", "id", "rank", F.coalesce("tok", F.lit(0)).alias("own"), (F.coalesce("pt", F.lit(0)) + F.coalesce("ht", F.lit(0))).alias("extra"))


def context_expand_budget(spark, sf):
    """Ranked hits with parent and header, 2,500 tokens a query."""
    j = with_surroundings(spark, sf, found(spark, sf, 20))
    return R.expand_within_budget(j, 2500).select("query", "id", F.col("rank").cast("bigint").alias("rank"), "keep", "running")


EXPAND_SQL = "WITH RECURSIVE " + BM25_SQL + """, o AS (SELECT id, max(length(text) // 4) AS tok, max(parent_info.parent_chunk_id) AS parent, max(parent_info.judgment_header_chunk_id) AS header FROM chunks GROUP BY id),
h AS (SELECT bm.query, bm.id, bm.rank, coalesce(o.tok, 0) AS own, coalesce(pp.tok, 0) + coalesce(hh.tok, 0) AS extra
  FROM bm JOIN o USING (id) LEFT JOIN o pp ON pp.id = o.parent LEFT JOIN o hh ON hh.id = o.header WHERE bm.rank <= 20),
w AS (SELECT query, id, rank, (extra > 0 AND own + extra > 2500) AS shut, CASE WHEN extra > 0 AND own + extra > 2500 THEN own ELSE own + extra END AS running, extra FROM h WHERE rank = 1
  UNION ALL SELECT h.query, h.id, h.rank, w.shut OR (h.extra > 0 AND w.running + h.own + h.extra > 2500),
  CASE WHEN w.shut OR (h.extra > 0 AND w.running + h.own + h.extra > 2500) THEN w.running + h.own ELSE w.running + h.own + h.extra END, h.extra
  FROM w JOIN h ON h.query = w.query AND h.rank = w.rank + 1)
SELECT query, id, rank, (NOT shut AND extra > 0) AS keep, running::BIGINT AS running FROM w"""


def parent_store(spark, sf):
    """Chunks that others name as parent or header, as a key-value projection."""
    c = load(spark, sf, "chunks")
    wanted = c.select(F.explode(F.array("parent_info.parent_chunk_id", "parent_info.judgment_header_chunk_id")).alias("id")).where("id is not null").distinct()
    v = c.select("id", "document_id", "document_type", "chunk_type", F.col("statute.act_name").alias("act_name"), F.col("statute.section_number").alias("section_number"), F.col("judgment.case_citation").alias("case_citation"), F.col("judgment.court").alias("court"), F.col("ingestion.ingested_at").alias("at"))
    v = v.join(wanted, "id", "left_semi")
    last = W.partitionBy("id").orderBy(F.desc("at"), F.asc_nulls_last("document_id"))
    return v.withColumn("n", F.row_number().over(last)).where("n = 1").drop("n", "at")


PARENT_SQL = """SELECT id, document_id, document_type, chunk_type, act_name, section_number, case_citation, court FROM (
SELECT id, document_id, document_type, chunk_type, statute.act_name AS act_name, statute.section_number AS section_number, judgment.case_citation AS case_citation, judgment.court AS court,
  row_number() OVER (PARTITION BY id ORDER BY ingestion.ingested_at DESC NULLS LAST, document_id NULLS LAST) AS n FROM chunks
WHERE id IN (SELECT parent_info.parent_chunk_id FROM chunks WHERE parent_info.parent_chunk_id IS NOT NULL UNION SELECT parent_info.judgment_header_chunk_id FROM chunks WHERE parent_info.judgment_header_chunk_id IS NOT NULL)) WHERE n = 1"""


def late_chunk_mean_pool(spark, sf):
    """Mean vector per label, number by number."""
    e = load(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    m = e.groupBy("label", "pos").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    return m.select(F.col("label").cast("bigint").alias("label"), F.col("pos").cast("bigint").alias("pos"), "x")


def maxmin_breaks(spark, sf):
    """Neighbours' similarity within a label, its 25th percentile, and the groups
    between neighbours below it."""
    w = W.partitionBy("label").orderBy("vec_id")
    e = load(spark, sf, "embeddings").withColumn("prev", F.lag("embedding").over(w))
    e = e.select("label", "vec_id", F.when(F.col("prev").isNotNull(), F.round(cosine(F.col("embedding"), F.col("prev")), 6)).alias("sim"))
    low = e.groupBy("label").agg(F.expr("percentile(sim, 0.25)").alias("cut"))
    g = e.join(low, "label").withColumn("grp", F.sum(F.when(F.col("sim") < F.col("cut"), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return g.select(F.col("label").cast("bigint").alias("label"), "vec_id", F.col("grp").cast("bigint").alias("grp"))


def flare_segments(spark, sf):
    """Windows of 300 words of each text, with their number of words."""
    d = load(spark, sf, "documents").select("doc_id", F.split(F.trim(F.regexp_replace("text", "[ \\t\\r\\n\\f]+", " ")), " ").alias("w")).where("size(w) > 0 and w[0] <> ''")
    d = d.select("doc_id", F.size("w").alias("n"), F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 300).cast("int"))).alias("seg"))
    return d.select("doc_id", F.col("seg").cast("bigint").alias("seg"), F.least(F.lit(300), F.col("n") - F.col("seg") * 300).cast("bigint").alias("words"))


def flare_new_ids(spark, sf):
    """Hits of a second retrieval (contextualised text) that the first lacks."""
    h = _channels(spark, sf)
    return R.unseen(h.where("channel = 'context' and rank <= 20").select("query", "id"), h.where("channel = 'text'"), ["query", "id"])


FLARE_NEW_SQL = RRF_SQL.split(",\nf AS (")[0] + " SELECT query, id FROM hits WHERE channel = 'context' AND rank <= 20 AND (query, id) NOT IN (SELECT (query, id) FROM hits WHERE channel = 'text')"

NOW = "2025-03-01 00:00:00"


def _cache(spark, sf):
    """Queries with a generated answer as cache entries, a year to live."""
    ok = "generated and size(query_embedding) = 64 and not exists(query_embedding, e -> e is null or isnan(e)) and exists(query_embedding, e -> e <> 0)"
    q = load(spark, sf, "queries").where(ok).groupBy("query_id").agg(F.max("query_embedding").alias("v"), F.max("hyde_text").alias("response"), F.max("asked_at").alias("cached_at"), F.max("text").alias("text"))
    return q.select(F.col("query_id").alias("key"), "v", "response", "cached_at", F.lit(180 * 86400).alias("ttl_seconds"), F.regexp_extract_all("text", F.lit("([A-Z][a-z]+ Act)"), F.lit(1)).alias("acts_cited"))


CACHE = """cache AS (SELECT query_id AS key, max(query_embedding)::DOUBLE[] AS v, max(hyde_text) AS response, max(asked_at) AS cached_at, regexp_extract_all(max(text), '([A-Z][a-z]+ Act)', 1) AS acts_cited FROM queries
WHERE generated AND len(query_embedding) = 64 AND NOT list_bool_or(list_transform(query_embedding, lambda e: e IS NULL OR isnan(e))) AND list_bool_or(list_transform(query_embedding, lambda e: e <> 0)) GROUP BY query_id)"""


def cache_lookup(spark, sf):
    q = _query_vectors(spark, sf).select(F.col("query_id").alias("query"), F.col("qv").alias("v"))
    return R.cache_lookup(q, _cache(spark, sf), 0.92, NOW)


CACHE_SQL = "WITH " + QV + ", " + CACHE + f""", j AS (SELECT query_id AS query, key, round(list_cosine_similarity(qv.v, cache.v), 6) AS score FROM qv, cache
WHERE response IS NOT NULL AND cached_at + INTERVAL 180 DAY > TIMESTAMPTZ '{NOW}+00')
SELECT query, key, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS n FROM j WHERE score >= 0.92) WHERE n = 1"""


def cache_invalidate(spark, sf):
    return R.cache_invalidate(_cache(spark, sf), "Welfare Act").select("key", F.array_join("acts_cited", ",").alias("acts"))


def cache_ttl(spark, sf):
    c = _cache(spark, sf)
    return c.select("key", (F.col("cached_at") + F.make_interval(secs=F.col("ttl_seconds")) > F.lit(NOW).cast("timestamp")).alias("live"))


def query_tokens(spark, sf):
    return load(spark, sf, "queries").select("query_id", F.size(tokens(F.col("text"))).cast("bigint").alias("n")).where("n >= 0").distinct()


QUERIES = {
    "bm25_term_stats": (bm25_term_stats, "WITH " + P + " SELECT term, df, round(idf, 6) AS idf FROM ts"),
    "bm25_weights": (bm25_weights, "WITH " + P + ", w AS (SELECT p.id, idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / greatest(avgdl, 1.0))) AS weight FROM p JOIN ts USING (term)) SELECT id, count(*) AS terms, round(sum(weight), 4) AS total, round(max(weight), 4) AS most FROM w GROUP BY id"),
    "bm25_topk": (bm25_topk, "WITH " + BM25_SQL + " SELECT query, id, score, rank FROM bm WHERE rank <= 10"),
    "matryoshka_slice": (matryoshka_slice, "SELECT vec_id, list_transform(s, lambda x: round(x / sqrt(list_sum(list_transform(s, lambda y: y * y))), 6)) AS fast FROM (SELECT vec_id, embedding[1:16]::DOUBLE[] AS s FROM embeddings)"),
    "dense_top_k": (dense_top_k, "WITH " + QV + " SELECT query, id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM (SELECT query_id AS query, vec_id AS id, round(list_cosine_similarity(embedding::DOUBLE[], v), 6) AS score FROM embeddings, qv)) WHERE rank <= 10"),
    "dense_two_stage": (dense_two_stage, "WITH " + QV + """, a AS (SELECT query_id AS query, vec_id AS id, round(list_cosine_similarity(embedding[1:16]::DOUBLE[], v[1:16]), 6) AS s, round(list_cosine_similarity(embedding::DOUBLE[], v), 6) AS score FROM embeddings, qv),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, id) AS n FROM a) WHERE n <= 200)
SELECT query, id, score, rank FROM (SELECT query, id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM b) WHERE rank <= 20"""),
    "rrf_fusion": (rrf_fusion, RRF_SQL),
    "rerank_overlap": (rerank_overlap, RERANK_SQL),
    "context_expand_budget": (context_expand_budget, EXPAND_SQL),
    "parent_store": (parent_store, PARENT_SQL),
    "late_chunk_mean_pool": (late_chunk_mean_pool, "SELECT label::BIGINT AS label, pos - 1 AS pos, round(avg(embedding[pos]::DOUBLE), 6) AS x FROM embeddings, range(1, 65) r(pos) GROUP BY label, pos"),
    "maxmin_breaks": (maxmin_breaks, """WITH e AS (SELECT label, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], lag(embedding) OVER (PARTITION BY label ORDER BY vec_id)::DOUBLE[]), 6) AS sim FROM embeddings),
c AS (SELECT label, quantile_cont(sim, 0.25) AS cut FROM e GROUP BY label)
SELECT label::BIGINT AS label, vec_id, sum(CASE WHEN sim < cut THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY vec_id)::BIGINT AS grp FROM e JOIN c USING (label)"""),
    "flare_segments": (flare_segments, r"""WITH w AS (SELECT doc_id, len(string_split(trim(regexp_replace(text, '[ \t\r\n\f]+', ' ', 'g')), ' ')) AS n, trim(regexp_replace(text, '[ \t\r\n\f]+', ' ', 'g')) AS t FROM documents),
s AS (SELECT doc_id, n, unnest(range(0, (n - 1) // 300 + 1)) AS seg FROM w WHERE t <> '')
SELECT doc_id, seg, least(300, n - seg * 300) AS words FROM s"""),
    "flare_new_ids": (flare_new_ids, FLARE_NEW_SQL),
    "cache_lookup": (cache_lookup, CACHE_SQL),
    "cache_invalidate": (cache_invalidate, "WITH " + CACHE + " SELECT key, array_to_string(acts_cited, ',') AS acts FROM cache WHERE NOT list_contains(acts_cited, 'Welfare Act')"),
    "cache_ttl": (cache_ttl, "WITH " + CACHE + f" SELECT key, cached_at + INTERVAL 180 DAY > TIMESTAMPTZ '{NOW}+00' AS live FROM cache"),
    "query_tokens": (query_tokens, "SELECT DISTINCT query_id, len(regexp_extract_all(lower(text), '[a-z0-9]+')) AS n FROM queries WHERE text IS NOT NULL"),
}
