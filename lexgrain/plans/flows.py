"""Queries that put operators together, and smaller pieces of the flow."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.functions import legal as L
from lexgrain.functions.names import act_key, act_sql, citation_key, citation_sql
from lexgrain.operators import corpus as K
from lexgrain.operators import providers as P
from lexgrain.operators import retrieval as R
from lexgrain.plans.graph import ALL, edges_of
from lexgrain.plans.index import BM25_SQL, C, CACHE_SQL, RRF_SQL, _asked, _channels, _chunks, cache_lookup, texts_of, with_surroundings
from lexgrain.plans.verify import ROUTE, SREF, _queries
from lexgrain.session import cut, load


def channel_gate(spark, sf):
    """Channels that serve each query: the graph alone for simple ones, the graph
    besides for complex and analytical ones, vectors only where there is one."""
    v = load(spark, sf, "queries").where("text is not null").groupBy("query_id").agg(F.bool_or(F.coalesce(F.size("query_embedding") == 64, F.lit(False))).alias("vec"))
    r = _queries(spark, sf).select("query_id", L.route(F.col("text"))["route"].alias("route")).join(v, "query_id")
    simple = F.col("route") == "simple"
    c = F.array_compact(F.array(
        F.when(~simple & F.col("vec"), "dense"), F.when(~simple, "bm25"), F.when(~simple & F.col("vec"), "questions"),
        F.when(F.col("route").isin("simple", "complex", "analytical"), "graph"),
    ))
    return r.select("query_id", "route", F.array_join(c, ",").alias("channels"))


def query_vectors(spark, sf):
    """The vector a query searches with: the hypothetical answer's, where one was
    generated, else its own; which of the two, or none."""
    ok = lambda c: F.coalesce(F.size(c) == 64, F.lit(False))
    q = load(spark, sf, "queries")
    src = F.when(F.col("generated") & ok("hyde_embedding"), "hyde").when(ok("query_embedding"), "query").otherwise("none")
    return q.select("query_id", src.alias("source")).distinct()


def filtered_search(spark, sf):
    """Term search within in-force statutes and judgments decided by 2015."""
    c = load(spark, sf, "chunks").where("statute.is_in_force or judgment.date_decided < date'2015-01-01'").select("id", "text").where("text is not null").dropDuplicates(["id", "text"])
    return R.bm25_search(c, "id", "text", _asked(spark, sf), "query_id", "qtext", 10).select("query", "id", "score", F.col("rank").cast("bigint").alias("rank"))


#: what opens a channel of hits, in the words of channel_gate
GATES = {"text": "bm25", "context": "bm25", "questions": "questions", "graph": "graph"}


def fused_hits(spark, sf):
    """All channels that serve a stated query, fused. Chunks have no vectors in
    the tables, so there is no dense channel."""
    asked = question_lookup(spark, sf).select("query", F.col("chunk").alias("id"), "score", "rank", F.lit("questions").alias("channel"))
    named = _graph_hits(spark, sf).where("query_id % 100 = 0").select(F.col("query_id").alias("query"), "id", F.lit(1.0).alias("score"), "rank", F.lit("graph").alias("channel"))
    hits = _channels(spark, sf).unionByName(asked).unionByName(named)
    open_ = channel_gate(spark, sf).select(F.col("query_id").alias("query"), F.explode(F.split("channels", ",")).alias("gate"))
    gate = F.create_map(*[F.lit(x) for kv in GATES.items() for x in kv])[F.col("channel")]
    return R.rank_fusion(hits.withColumn("gate", gate).join(open_, ["query", "gate"], "left_semi"), 60, 150)


def full_retrieval(spark, sf):
    """Channels, fusion, reranking and expansion in one plan."""
    fused = cut(fused_hits(spark, sf).select("query", "id", "rank"))
    best = cut(R.overlap_rerank(fused, _asked(spark, sf).withColumnRenamed("query_id", "query"), texts_of(spark, sf, fused), 20))
    return R.expand_within_budget(with_surroundings(spark, sf, best), 2500).select("query", "id", F.col("rank").cast("bigint").alias("rank"), "keep", "running")


def question_lookup(spark, sf):
    """Stated queries against questions about chunks; a hit gives the chunk."""
    c = load(spark, sf, "chunks").select("id", "text").where("text is not null")  # the index drops what is delivered again
    q = P.questions(c, P.provider("template")).select(F.concat_ws("#", "id", F.col("q").cast("string")).alias("qid"), "question")
    h = R.bm25_search(q, "qid", "question", _asked(spark, sf), "query_id", "qtext", 10)
    return h.select("query", F.substring_index("id", "#", 1).alias("chunk"), "score", F.col("rank").cast("bigint").alias("rank"))


def document_spans(spark, sf):
    """Lines of a document under its headings: capitals or a numbered title."""
    g = K.line_sections(load(spark, sf, "documents"), "doc_id", "text", "^(THE [A-Z ]{8,}.*|[A-Z][A-Z ]{6,}|[0-9]+\\. [A-Z].{0,60})$")
    return g.select(F.col("id").alias("doc_id"), F.col("section").cast("bigint").alias("section"), "heading", "lines", F.col("chars").cast("bigint").alias("chars"))


def proposition_chunks(spark, sf):
    """Definitions as single statements, by the provider."""
    d = load(spark, sf, "sections").where("level = 'definition' and text is not null").select("section_id", "text").distinct()
    c = P.complete(d.select("section_id", F.concat(F.lit("claims\n"), "text").alias("prompt")), "prompt", "answer", P.provider("template"))
    return c.select("section_id", F.posexplode(F.filter(F.split("answer", "\n"), lambda x: F.trim(x) != "")).alias("n", "statement")).select("section_id", F.col("n").cast("bigint").alias("n"), "statement")


def version_ids(spark, sf):
    """Versions whose id isn't act:section:hash."""
    v = load(spark, sf, "section_versions")
    want = F.concat_ws(":", F.col("act_id").cast("string"), "section_number", F.substring("text_hash", 1, 8))
    return v.where(F.col("version_id") != want).select("version_id", want.alias("wanted")).distinct()


def payload_json(spark, sf):
    """A chunk's payload as JSON and back."""
    c = load(spark, sf, "chunks").select("id", F.to_json(F.struct("document_type", "chunk_type", "chunk_index")).alias("j")).distinct()
    return c.select("id", F.get_json_object("j", "$.document_type").alias("document_type"), F.get_json_object("j", "$.chunk_index").cast("bigint").alias("chunk_index"))


def _graph_hits(spark, sf):
    """Per section that a query names: the chunks of judgments that cite it, then the
    chunks of all sections of its act; each once, at its first place, at most 50."""
    q = _queries(spark, sf).select("query_id", F.explode(L.section_references(F.col("text"))).alias("r")).select("query_id", act_key(F.col("r.act")).alias("act"), "r.section").distinct()
    c = load(spark, sf, "chunks").select("id", act_key(F.col("statute.act_name")).alias("act"), citation_key(F.col("judgment.case_citation")).alias("cite"))
    citing = edges_of(spark, sf, "CITES_SECTION", "INTERPRETS").select(F.substring_index("to_key", "|", 1).alias("act"), F.substring_index("to_key", "|", -1).alias("section"), F.col("from_key").alias("cite")).distinct()
    judged = q.join(citing, ["act", "section"]).join(c.select("cite", "id"), "cite").select("query_id", "id", F.lit(0).alias("seq"))
    under = q.join(c.where("act is not null").select("act", "id"), "act").select("query_id", "id", F.lit(1).alias("seq"))
    first = judged.unionByName(under).groupBy("query_id", "id").agg(F.min("seq").alias("seq"))
    return first.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("seq", "id"))).where("rank <= 50")


def graph_search(spark, sf):
    return _graph_hits(spark, sf).select("query_id", "id", F.col("rank").cast("bigint").alias("rank"))


def hybrid_search(spark, sf):
    """The light search: text and contextualised text, 50 each, fused."""
    f = R.rank_fusion(_channels(spark, sf).where("rank <= 50"), 60, 150)
    return f.select("query", "id", "score", F.col("rank").cast("bigint").alias("rank"))


def query_flow(spark, sf):
    """What each query does next: answered from the cache, or routed and searched with
    its own vector or that of a hypothetical answer (complex and analytical ones)."""
    hit = cache_lookup(spark, sf).select(F.col("query").alias("query_id"), "key")
    r = _queries(spark, sf).where("query_id % 100 = 0").select("query_id", L.route(F.col("text"))["route"].alias("route"))
    v = query_vectors(spark, sf).groupBy("query_id").agg(F.min("source").alias("source"))
    j = r.join(hit, "query_id", "left").join(v, "query_id", "left")
    wants = F.col("route").isin("complex", "analytical") & (F.col("source") == "hyde")
    vector = F.when(F.col("key").isNotNull(), "none").when(wants, "hyde").when(F.col("source") != "none", "query").otherwise("none")
    return j.select("query_id", F.when(F.col("key").isNotNull(), "cache").otherwise(F.col("route")).alias("route"), "key", vector.alias("vector"))


def skewed_terms(spark, sf):
    """Terms in more than a twentieth of the chunks, for which search goes another way."""
    c = _chunks(spark, sf)
    p, n = R.postings(c, "id", "text"), R.corpus_stats(c, "text")
    df = p.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.crossJoin(n).where(F.col("df") > 0.05 * F.col("n")).select("term", "df")


QN = """qn0 AS (SELECT id, list_sort(list_transform(list_distinct(regexp_extract_all(text, '[A-Za-z]{5,}')), lambda w: struct_pack(n := -length(w), w := w))) AS ws FROM c),
qn1 AS (SELECT id, unnest(range(0, least(5, len(ws)))) AS k, ws FROM qn0), qn AS (SELECT id, k, 'What is said about ' || lower(ws[k + 1].w) || '?' AS question FROM qn1)"""
QUESTIONS_SQL = "WITH " + C + ", " + QN + ", " + BM25_SQL.replace(C, "c9 AS (SELECT id || '#' || k AS id, question AS text FROM qn)", 1).replace("FROM c),", "FROM c9),", 1) + " SELECT query, split_part(id, '#', 1) AS chunk, score, rank FROM bm WHERE rank <= 10"

QUERIES = {
    "channel_gate": (channel_gate, f"""WITH {ROUTE}, v AS (SELECT query_id, bool_or(coalesce(len(query_embedding) = 64, false)) AS vec FROM queries WHERE text IS NOT NULL GROUP BY 1)
SELECT query_id, route, concat_ws(',', CASE WHEN route <> 'simple' AND vec THEN 'dense' END, CASE WHEN route <> 'simple' THEN 'bm25' END, CASE WHEN route <> 'simple' AND vec THEN 'questions' END,
 CASE WHEN route IN ('simple', 'complex', 'analytical') THEN 'graph' END) AS channels FROM rt JOIN v USING (query_id)"""),
    "query_vectors": (query_vectors, "SELECT DISTINCT query_id, CASE WHEN generated AND len(hyde_embedding) = 64 THEN 'hyde' WHEN len(query_embedding) = 64 THEN 'query' ELSE 'none' END AS source FROM queries"),
    "filtered_search": (filtered_search, "WITH " + BM25_SQL.replace("FROM chunks WHERE text IS NOT NULL", "FROM chunks WHERE text IS NOT NULL AND (statute.is_in_force OR judgment.date_decided < DATE '2015-01-01')", 1) + " SELECT query, id, score, rank FROM bm WHERE rank <= 10"),
    "full_retrieval": (full_retrieval, None),
    "question_lookup": (question_lookup, QUESTIONS_SQL),
    "document_spans": (document_spans, r"""WITH l AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|\n|\r|\f') AS a FROM documents WHERE text IS NOT NULL), e AS (SELECT doc_id, unnest(a) AS line, generate_subscripts(a, 1) AS pos FROM l),
h AS (SELECT *, regexp_matches(line, '^(THE [A-Z ]{8,}.*|[A-Z][A-Z ]{6,}|[0-9]+\. [A-Z].{0,60})$') AS h FROM e), s AS (SELECT *, sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)::BIGINT AS section FROM h)
SELECT doc_id, section, max(CASE WHEN h THEN trim(line) END) AS heading, count(*) AS lines, sum(length(line))::BIGINT AS chars FROM s GROUP BY 1, 2"""),
    "proposition_chunks": (proposition_chunks, r"""WITH d AS (SELECT DISTINCT section_id, text FROM sections WHERE level = 'definition' AND text IS NOT NULL), l AS (SELECT section_id, list_filter(string_split(regexp_replace(trim(text, E' \t\n\r\f'), '([.!?])\s+', E'\\1\n', 'g'), E'\n'), lambda x: trim(x) <> '') AS a FROM d)
SELECT section_id, (generate_subscripts(a, 1) - 1)::BIGINT AS n, unnest(a) AS statement FROM l"""),
    "version_ids": (version_ids, "SELECT DISTINCT version_id, concat_ws(':', act_id::VARCHAR, section_number, substr(text_hash, 1, 8)) AS wanted FROM section_versions WHERE version_id <> concat_ws(':', act_id::VARCHAR, section_number, substr(text_hash, 1, 8))"),
    "graph_search": (graph_search, f"""{ALL}, {SREF}, g0 AS (SELECT DISTINCT query_id, {act_sql('act')} AS act, section FROM sref), ck AS (SELECT id, {act_sql('statute.act_name')} AS act, {citation_sql('judgment.case_citation')} AS cite FROM chunks),
g1 AS (SELECT query_id, ck.id, 0 AS seq FROM g0 JOIN e ON e.to_key = g0.act || '|' || section AND kind IN ('CITES_SECTION', 'INTERPRETS') JOIN ck ON ck.cite = e.from_key UNION ALL SELECT query_id, ck.id, 1 FROM g0 JOIN ck USING (act)),
g2 AS (SELECT query_id, id, min(seq) AS seq FROM g1 GROUP BY 1, 2), g3 AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY seq, id) AS rank FROM g2) SELECT * FROM g3 WHERE rank <= 50"""),
    "hybrid_search": (hybrid_search, RRF_SQL.split(",\nr AS (")[0] + ", r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM f) SELECT query, id, score, rank FROM r WHERE rank <= 150"),
    "query_flow": (query_flow, f"""WITH hit AS ({CACHE_SQL}), {ROUTE}, v AS (SELECT query_id, min(CASE WHEN generated AND len(hyde_embedding) = 64 THEN 'hyde' WHEN len(query_embedding) = 64 THEN 'query' ELSE 'none' END) AS source FROM queries GROUP BY 1)
SELECT rt.query_id, CASE WHEN key IS NOT NULL THEN 'cache' ELSE route END AS route, key, CASE WHEN key IS NOT NULL THEN 'none' WHEN route IN ('complex', 'analytical') AND source = 'hyde' THEN 'hyde' WHEN source <> 'none' THEN 'query' ELSE 'none' END AS vector
FROM rt LEFT JOIN hit ON hit.query = rt.query_id LEFT JOIN v ON v.query_id = rt.query_id WHERE rt.query_id % 100 = 0"""),
    "skewed_terms": (skewed_terms, "WITH " + BM25_SQL.split(", ts AS (")[0].split(",\nts AS (")[0] + ", g AS (SELECT term, count(*) AS df FROM p GROUP BY 1) SELECT term, df FROM g, st WHERE df > 0.05 * n"),
}
QUERIES["payload_json"] = (payload_json, "SELECT id, document_type, chunk_index FROM (SELECT DISTINCT id, document_type, chunk_type, chunk_index::BIGINT AS chunk_index FROM chunks)")
