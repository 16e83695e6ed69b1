"""Queries on routing, verification and evaluation."""

from pyspark.sql import functions as F

from lexgrain.functions import legal as L
from lexgrain.functions.names import act_key, act_sql, citation_key, citation_sql
from lexgrain.operators import lexical as LX
from lexgrain.operators import providers as P
from lexgrain.operators import retrieval as R
from lexgrain.operators import verification as V
from lexgrain.plans import graph as GP
from lexgrain.plans.graph import edges_of, kg_acts, kg_judgments, kg_sections
from lexgrain.plans.index import BM25_SQL, _asked, found, text_index, texts_of
from lexgrain.session import load

TODAY = "2025-06-30"


def _queries(spark, sf):
    return load(spark, sf, "queries").where("text is not null").groupBy("query_id").agg(F.max("text").alias("text"), F.max(F.lower("route")).alias("route"), F.max("hyde_text").alias("hyde_text"), F.max("reference_date").alias("reference_date"))


Q = "q AS (SELECT query_id, max(text) AS text, max(lower(route)) AS route, max(hyde_text) AS hyde_text, max(reference_date) AS reference_date FROM queries WHERE text IS NOT NULL GROUP BY query_id)"


def query_router(spark, sf):
    r = _queries(spark, sf).select("query_id", L.route(F.col("text")).alias("r"))
    return r.select("query_id", "r.route", F.col("r.confidence").cast("double").alias("confidence"), F.array_join("r.signals", ",").alias("signals"))


def act_refs(spark, sf):
    return _queries(spark, sf).select("query_id", F.array_join(F.array_sort(L.act_references(F.col("text"))), "|").alias("acts"))


def section_refs(spark, sf):
    r = _queries(spark, sf).select("query_id", F.explode(L.section_references(F.col("text"))).alias("r"))
    return r.select("query_id", "r.section", "r.act")


def hyde_gate(spark, sf):
    """Queries of the routes for which a hypothetical answer is made."""
    r = _queries(spark, sf).select("query_id", L.route(F.col("text"))["route"].alias("route"))
    return r.where(F.col("route").isin("complex", "analytical"))


def routing_accuracy(spark, sf):
    r = _queries(spark, sf).select("route", L.route(F.col("text"))["route"].alias("got"))
    return r.groupBy("route").agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg((F.col("route") == F.col("got")).cast("double")), 6).alias("accuracy"))


def citation_families(spark, sf):
    d = load(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", *[F.regexp_count("text", F.lit(L.FAMILIES[k])).cast("bigint").alias(k) for k in ("air", "scc", "scc_online", "gazette", "section")])


def citation_spans(spark, sf):
    s = V.citation_spans(load(spark, sf, "documents"), "doc_id", "text")
    return s.groupBy("id", "family").agg(F.count(F.lit(1)).alias("n"), F.min("start").cast("bigint").alias("first"))


def _case_nodes(spark, sf):
    """Keys of all known judgments: of the graph and of the register."""
    j = load(spark, sf, "judgments")
    typed = j.select("citation").unionByName(j.select(F.explode("alt_citations").alias("citation")))
    return typed.select(citation_key(F.col("citation")).alias("key")).unionByName(kg_judgments(spark, sf).select(F.col("cite").alias("key"))).where("key is not null").distinct()


def _section_nodes(spark, sf):
    return kg_sections(spark, sf).select(F.concat_ws("|", "act", "number").alias("key"))


def _cited(spark, sf):
    """(doc_id, family, citation, key) of the documents, each once a document. The key
    is the graph's: a case's citation, a section with its act, an article with the
    constitution; bare sections, notices and circulars have none."""
    d = load(spark, sf, "documents").where("text is not null")
    every = lambda p, i=1: F.regexp_extract_all("text", F.lit(p if i else f"({p})"), F.lit(i or 1))
    of = lambda family, found, key: F.transform(found, lambda x: F.struct(F.lit(family).alias("family"), x.alias("citation"), key(x).alias("key")))
    null = F.lit(None).cast("string")
    named = F.arrays_zip(F.regexp_extract_all("text", F.lit(f"({L.SECTION_OF_ACT})"), F.lit(1)).alias("c"), every(L.SECTION_OF_ACT, 1).alias("n"), every(L.SECTION_OF_ACT, 2).alias("a"))
    sections = F.transform(named, lambda x: F.struct(F.lit("section").alias("family"), x["c"].alias("citation"), F.concat(act_key(x["a"]), F.lit("|"), x["n"]).alias("key")))
    article = lambda x: F.concat(F.lit("constitution of india|"), F.regexp_extract(x, "(\\d+[A-Za-z]*)$", 1))
    cases = [of(k, every(L.FAMILIES[k], 0), citation_key) for k in ("air", "scc", "scc_online")]
    others = [of(k, every(L.FAMILIES[k], 0), lambda x: null) for k in ("gazette", "circular")]
    e = F.concat(*cases, sections, of("article", every(L.FAMILIES["article"], 0), article), *others)
    return d.select("doc_id", F.explode(e).alias("e")).select("doc_id", "e.family", "e.citation", "e.key").distinct()


def _verified(spark, sf):
    return V.verify_citations(_cited(spark, sf), _case_nodes(spark, sf).unionByName(_section_nodes(spark, sf)))


def citation_verify(spark, sf):
    """Each citation verified, not found, or of a kind that the graph doesn't hold."""
    return _verified(spark, sf).select("doc_id", "family", "citation", "status")


def verification_summary(spark, sf):
    """Counters of a verification run by source. ``not_found`` is all that isn't
    verified; ``missing`` and ``kg_unavailable`` are its parts."""
    v = _verified(spark, sf).join(load(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    n = lambda s: F.count_if(F.col("status") == s)
    g = v.groupBy("source").agg(F.count(F.lit(1)).alias("citations"), n("verified").alias("verified"), n("not_found").alias("missing"), n("kg_unavailable").alias("kg_unavailable"))
    return g.withColumn("not_found", F.col("citations") - F.col("verified")).withColumn("rate", F.round(V.ratio(F.col("verified"), F.col("citations"), 1.0), 6))


def _references(spark, sf):
    """(source, ref, section, act, key, day): provisions that documents, queries (at
    their own date) and chunks name."""
    d = load(spark, sf, "documents").where("text is not null")
    named = F.arrays_zip(F.regexp_extract_all("text", F.lit(L.SECTION_OF_ACT), F.lit(1)).alias("section"), F.regexp_extract_all("text", F.lit(L.SECTION_OF_ACT), F.lit(2)).alias("act"))
    today = F.lit(TODAY).cast("date")
    docs = d.select(F.lit("document").alias("source"), F.col("doc_id").cast("string").alias("ref"), F.explode(named).alias("r"), today.alias("day"))
    q = _queries(spark, sf).select(F.lit("query").alias("source"), F.col("query_id").cast("string").alias("ref"), F.explode(L.section_references(F.col("text"))).alias("r"), F.coalesce(F.col("reference_date").cast("date"), today).alias("day"))
    typed = docs.unionByName(q).select("source", "ref", "r.section", act_key(F.col("r.act")).alias("act"), "day")
    c = edges_of(spark, sf, "REFERENCES", "CITES_SECTION").select(F.lit("chunk").alias("source"), F.col("from_key").alias("ref"), F.substring_index("to_key", "|", -1).alias("section"), F.substring_index("to_key", "|", 1).alias("act"), today.alias("day"))
    return typed.unionByName(c).where("act is not null").distinct()


def temporal_warnings(spark, sf):
    """References to law that no longer holds at their date: the repealed codes first,
    then sections out of force, then sections of repealed acts; with the replacement."""
    return V.temporal_warnings(_references(spark, sf), kg_sections(spark, sf), kg_acts(spark, sf), edges_of(spark, sf, "REPLACES"))


def verification_layers(spark, sf):
    """All layers for each document: citations with their outcomes, warnings about
    law that no longer holds, and whether it gets a caveat."""
    n = lambda s: F.count_if(F.col("status") == s)
    v = _verified(spark, sf).groupBy("doc_id").agg(F.count(F.lit(1)).alias("citations"), n("verified").alias("verified"), n("not_found").alias("not_found"), n("kg_unavailable").alias("kg_unavailable"))
    w = temporal_warnings(spark, sf).where("source = 'document'").groupBy(F.col("ref").cast("bigint").alias("doc_id")).agg(F.count(F.lit(1)).alias("warnings"))
    d = load(spark, sf, "documents").where("text is not null").select("doc_id").join(v, "doc_id", "left").join(w, "doc_id", "left").fillna(0)
    return d.withColumn("caveat", F.col("not_found") > 0)


def acts_repealed_cited(spark, sf):
    """Acts that chunks cite, with the register's status."""
    c = load(spark, sf, "chunks").select(F.explode("content.acts_cited").alias("act"))
    a = load(spark, sf, "acts").groupBy(F.col("name").alias("act")).agg(F.max("status").alias("status"))
    return c.groupBy("act").agg(F.count(F.lit(1)).alias("n")).join(a, "act", "left")


def caveat_append(spark, sf):
    v = _verified(spark, sf).groupBy("doc_id").agg(F.count_if(F.col("status") == "not_found").alias("u"))
    d = load(spark, sf, "documents").where("text is not null").join(v, "doc_id", "left")
    t = V.caveat(F.col("text"), F.coalesce("u", F.lit(0)), F.lit(0))
    return d.select("doc_id", F.sha2(t, 256).alias("hash"))


def _hits(spark, sf, k):
    return found(spark, sf, k)


def _meta(spark, sf, hits):
    c = load(spark, sf, "chunks").select("id", "document_type", "judgment").join(LX.small(hits.select("id").distinct()), "id", "left_semi")
    return c.groupBy("id").agg(F.max("document_type").alias("kind"), F.max("judgment.court_level").alias("level"), F.max("judgment.date_decided").alias("day"))


def _answered(spark, sf):
    """Every query that has a generated answer."""
    q = load(spark, sf, "queries").where("text is not null").groupBy("query_id").agg(F.max("text").alias("qtext"), F.max("hyde_text").alias("answer"))
    return q.where("answer is not null")


def answer_hits(spark, sf):
    """The five best chunks of every query that has a generated answer."""
    return LX.search(text_index(spark, sf), _answered(spark, sf), "query_id", "qtext", 5)


def claims(spark, sf, hits, answers=None, most=None):
    """Statements of generated answers, of all by default and all of each, against the
    five best texts of hits(query, id, rank), with a finding each."""
    answers = _answered(spark, sf) if answers is None else answers
    best = hits.where("rank <= 5").select("query", "id")
    ev = best.join(texts_of(spark, sf, best), "id").select(F.col("query").alias("id"), F.col("id").alias("chunk"), "text")
    return P.align_claims(answers.select(F.col("query_id").alias("id"), F.col("answer").alias("text")), ev, P.provider("template"), most=most)


def confidence_score(spark, sf):
    """Six weighted factors of each stated query: relevance of its ten best hits after
    reranking, share of verified citations of its answer (1 without any), authority
    and recency of the hits, share of supported claims (1 without any), specificity."""
    asked = _asked(spark, sf).withColumnRenamed("query_id", "query")
    hits = _hits(spark, sf, 10)
    h = R.overlap_rerank(hits, asked, texts_of(spark, sf, hits), 10).select("query", "id", "score").join(_meta(spark, sf, hits), "id")
    g = h.groupBy("query").agg(
        F.coalesce(F.least(F.lit(1.0), F.avg(F.when(F.col("score") > 0, F.col("score")))), F.lit(0.0)).alias("relevance"),
        F.avg(V.authority(F.col("kind"), F.col("level"))).alias("authority"),
        F.avg(V.recency(F.col("day"), TODAY)).alias("recency"),
        F.count(F.lit(1)).alias("n"),
    )
    a = _queries(spark, sf).where("query_id % 100 = 0")
    cases = F.concat(*[F.regexp_extract_all("hyde_text", F.lit(f"({L.FAMILIES[k]})"), F.lit(1)) for k in ("air", "scc", "scc_online")])
    cited = a.select(F.col("query_id").alias("query"), F.explode(F.array_distinct(cases)).alias("citation")).withColumn("family", F.lit("case")).withColumn("key", citation_key(F.col("citation")))
    ok = V.verify_citations(cited, _case_nodes(spark, sf)).groupBy("query").agg(F.avg((F.col("status") == "verified").cast("double")).alias("citations"))
    # its statements are those of the stated queries, 50 an answer at most
    cl = claims(spark, sf, hits, _answered(spark, sf).where("query_id % 100 = 0"), 50).groupBy(F.col("id").alias("query")).agg(F.avg((F.col("finding") == "supported").cast("double")).alias("agreement"))
    r = a.select(F.col("query_id").alias("query"), L.route(F.col("text"))["route"].alias("route"))
    g = g.join(r, "query").join(ok, "query", "left").join(cl, "query", "left").fillna(1.0, ["citations", "agreement"])
    g = g.withColumn("specificity", V.specificity(F.col("route"), F.col("n"))).withColumn("confidence", V.weighted(V.WEIGHTS))
    level = F.when(F.col("confidence") < 0.3, "critical").when(F.col("confidence") < 0.6, "warning").otherwise("good")
    return g.select("query", "n", "confidence", level.alias("level"))


def section_completeness(spark, sf):
    """Sections that a stated query asks for and that its five best texts name."""
    hits = _hits(spark, sf, 5)
    h = hits.join(texts_of(spark, sf, hits), "id").groupBy("query").agg(F.collect_list("text").alias("texts"))
    q = _asked(spark, sf).select(F.col("query_id").alias("query"), F.array_distinct(F.regexp_extract_all("qtext", F.lit("section ([0-9]+[A-Z]?)"), F.lit(1))).alias("want"))
    j = q.join(h, "query", "left").withColumn("found", V.contained(F.col("want"), F.coalesce("texts", F.array().cast("array<string>"))))
    return j.select("query", F.size("want").cast("bigint").alias("expected"), F.col("found").cast("bigint").alias("found"), F.round(V.ratio(F.col("found"), F.size("want"), 1.0), 6).alias("score"))


def citation_accuracy(spark, sf):
    """Citations of generated answers that some chunk also has."""
    a = _queries(spark, sf).where("hyde_text is not null").select("query_id", F.explode(F.array_distinct(F.regexp_extract_all("hyde_text", F.lit("(" + L.FAMILIES["scc"] + ")"), F.lit(1)))).alias("citation"))
    k = load(spark, sf, "chunks").select(F.explode("content.cases_cited").alias("k"))
    v = V.verify_citations(a.withColumn("family", F.lit("case")).withColumn("key", F.col("citation")), k.select(F.col("k").alias("key")))
    return v.groupBy("query_id").agg(F.count(F.lit(1)).alias("citations"), F.round(F.avg((F.col("status") == "verified").cast("double")), 6).alias("accuracy"))


def eval_cube(spark, sf):
    e = load(spark, sf, "events").withColumn("day", F.dayofweek("ts").cast("bigint"))
    return e.rollup("event_type", "day").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


def _re(s):
    return s.replace("'", "''")


ALIAS_SQL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '(?i)\\b{a}\\b') THEN '{_re(n.lower())}' END" for a, n in L.ACT_ALIASES.items()) + "], lambda x: x IS NOT NULL)"
ACTS_SQL = f"list_distinct(list_concat({ALIAS_SQL}, list_transform(regexp_extract_all(text, '{L.FULL_ACT}', 1), lambda x: lower(trim(x)))))"
SEC_SQL = "(" + " + ".join(f"len(regexp_extract_all(text, '{_re(p)}'))" for p in [L.SECTION_OF, *L.SECTION_SHORT]) + ")"
SIMPLE_SQL = "coalesce(" + ", ".join(f"CASE WHEN regexp_matches(lower(trim(text)), '{_re(p)}') THEN '{s}' END" for p, s in L.SIMPLE) + ")"
ANA_SQL = "concat_ws(','," + ", ".join(f"CASE WHEN regexp_matches(lower(trim(text)), '{_re(p)}') THEN '{s}' END" for p, s in L.ANALYTICAL) + ")"
COMPLEX_SQL = f"""concat_ws(',', CASE WHEN a > 1 THEN 'heuristic:multi_act(' || a || ')' END, CASE WHEN n > 2 THEN 'heuristic:multi_section(' || n || ')' END,
 CASE WHEN regexp_matches(text, '{_re(L.CROSS)}') THEN 'heuristic:cross_jurisdictional' END, CASE WHEN regexp_matches(text, '{_re(L.MULTI_HOP)}') THEN 'heuristic:multi_hop' END)"""
ROUTE = f"""{Q}, r0 AS (SELECT *, len({ACTS_SQL}) AS a, {SEC_SQL} AS n FROM q), r1 AS (SELECT *, {SIMPLE_SQL} AS si, {ANA_SQL} AS an, {COMPLEX_SQL} AS co FROM r0),
rt AS (SELECT query_id, q_route, CASE WHEN si IS NOT NULL THEN 'simple' WHEN an <> '' THEN 'analytical' WHEN co <> '' THEN 'complex' ELSE 'standard' END AS route,
 CASE WHEN si IS NOT NULL THEN 1.0 WHEN an <> '' THEN 0.9 WHEN co <> '' THEN 0.8 ELSE 0.5 END::DOUBLE AS confidence,
 CASE WHEN si IS NOT NULL THEN si WHEN an <> '' THEN an WHEN co <> '' THEN co ELSE 'default:standard' END AS signals FROM (SELECT *, route AS q_route FROM r1))"""
SREF = f"""{Q}, sr AS (SELECT query_id, reference_date, unnest(regexp_extract_all(text, '{_re(L.SECTION_OF)}', 1)) AS section, unnest(regexp_extract_all(text, '{_re(L.SECTION_OF)}', 2)) AS act0 FROM q),
sf AS (SELECT query_id, reference_date, section, regexp_replace(trim(act0), '[?!,.;:]+$', '') AS act1 FROM sr),
sref AS (SELECT query_id, reference_date, section, CASE lower(act1) {' '.join(f"WHEN '{a}' THEN '{_re(n)}'" for a, n in L.ACT_ALIASES.items())} ELSE act1 END AS act FROM sf)"""
GRAPH = ", ".join([GP.S, GP.J, GP.ACTS, GP.SECS, GP.JUDS])
CASES_SQL = f"cases AS (SELECT {citation_sql('citation')} AS key FROM (SELECT citation FROM judgments UNION SELECT unnest(alt_citations) FROM judgments) UNION SELECT cite FROM juds)"
KNOWN = CASES_SQL + ", known AS (SELECT key FROM cases WHERE key IS NOT NULL UNION SELECT act || '|' || number FROM secs)"
_ONE = lambda k, key: f"SELECT doc_id, '{k}' AS family, citation, {key} AS key FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{L.FAMILIES[k]}')) AS citation FROM documents)"
CITED = f"""cited AS ({' UNION '.join(_ONE(k, citation_sql('citation')) for k in ('air', 'scc', 'scc_online'))} UNION {_ONE('article', "'constitution of india|' || regexp_extract(citation, '(\\d+[A-Za-z]*)$', 1)")} UNION {_ONE('gazette', 'NULL')} UNION {_ONE('circular', 'NULL')}
 UNION SELECT doc_id, 'section', c, {act_sql('a')} || '|' || n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{L.SECTION_OF_ACT}')) AS c, unnest(regexp_extract_all(text, '{L.SECTION_OF_ACT}', 1)) AS n, unnest(regexp_extract_all(text, '{L.SECTION_OF_ACT}', 2)) AS a FROM documents)),
{KNOWN}, ver AS (SELECT doc_id, family, citation, CASE WHEN family IN ('gazette', 'circular') THEN 'kg_unavailable' WHEN key IN (SELECT key FROM known) THEN 'verified' ELSE 'not_found' END AS status FROM cited)"""
_CODES = ", ".join(f"('{k.lower()}', '{v.lower()}')" for k, v in L.REPLACED_CODES.items())
TEMPORAL = f"""refs AS (SELECT DISTINCT * FROM (SELECT 'document' AS source, doc_id::VARCHAR AS ref, n AS section, {act_sql('a')} AS act, DATE '{TODAY}' AS day FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{L.SECTION_OF_ACT}', 1)) AS n, unnest(regexp_extract_all(text, '{L.SECTION_OF_ACT}', 2)) AS a FROM documents)
 UNION ALL SELECT 'query', query_id::VARCHAR, section, {act_sql('act')}, coalesce(reference_date::DATE, DATE '{TODAY}') FROM sref
 UNION ALL SELECT 'chunk', from_key, split_part(to_key, '|', 2), split_part(to_key, '|', 1), DATE '{TODAY}' FROM e WHERE kind IN ('REFERENCES', 'CITES_SECTION')) WHERE act IS NOT NULL),
codes AS (SELECT * FROM (VALUES {_CODES}) v(act, by_act)), rep AS (SELECT to_key AS act, min(from_key) AS by_act FROM e WHERE kind = 'REPLACES' GROUP BY 1),
w AS (SELECT source, ref, refs.section, refs.act, CASE WHEN codes.act IS NOT NULL AND day >= DATE '{L.REPEAL_DAY}' THEN 'code repealed' WHEN secs.act IS NOT NULL AND NOT is_in_force THEN 'not in force' WHEN secs.act IS NOT NULL AND status = 'repealed' THEN 'act repealed' END AS reason,
 coalesce(codes.by_act, rep.by_act) AS by_act, replaced_by AS by_section FROM refs LEFT JOIN codes USING (act) LEFT JOIN secs ON secs.act = refs.act AND secs.number = refs.section LEFT JOIN acts_n ON acts_n.act = refs.act LEFT JOIN rep ON rep.act = refs.act)"""
TOKENS_OF = lambda x: f"regexp_extract_all(lower({x}), '[a-z0-9]+')"
CLAIMS = f"""an AS (SELECT query_id, max(hyde_text) AS text FROM queries WHERE query_id % 100 = 0 AND text IS NOT NULL AND hyde_text IS NOT NULL GROUP BY 1),
cl0 AS (SELECT query_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]\\s+'), lambda x: trim(x)), lambda x: x <> '')[1:50] AS a FROM an), cl1 AS (SELECT query_id, unnest(a) AS claim, generate_subscripts(a, 1) - 1 AS claim_no FROM cl0),
ev AS (SELECT bm.query AS query_id, c.id AS chunk, {TOKENS_OF('c.text')} AS t FROM bm JOIN c USING (id) WHERE rank <= 5),
cl2 AS (SELECT query_id, claim_no, claim, chunk, CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: list_contains(coalesce(t, []), x)))::DOUBLE / len(w) ELSE 0.0 END::DOUBLE AS share FROM (SELECT *, list_distinct({TOKENS_OF('claim')}) AS w FROM cl1) LEFT JOIN ev USING (query_id)),
claims AS (SELECT query_id, claim_no, round(max(share), 6) AS share, first(chunk ORDER BY share DESC, chunk DESC NULLS LAST) AS best FROM cl2 GROUP BY 1, 2)"""
CLAIMS_OF_ALL = CLAIMS.replace("query_id % 100 = 0 AND ", "").replace("[1:50]", "")
Q_ANSWERED = "q AS (SELECT query_id, max(text) AS qtext FROM queries WHERE text IS NOT NULL GROUP BY query_id HAVING count(hyde_text) > 0)"

QUERIES = {
    "query_router": (query_router, f"WITH {ROUTE} SELECT query_id, route, confidence, signals FROM rt"),
    "act_refs": (act_refs, f"WITH {Q} SELECT query_id, array_to_string(list_sort({ACTS_SQL}), '|') AS acts FROM q"),
    "section_refs": (section_refs, f"WITH {SREF} SELECT query_id, section, act FROM sref"),
    "hyde_gate": (hyde_gate, f"WITH {ROUTE} SELECT query_id, route FROM rt WHERE route IN ('complex', 'analytical')"),
    "routing_accuracy": (routing_accuracy, f"WITH {ROUTE} SELECT q_route AS route, count(*) AS queries, round(avg((q_route = route)::INT), 6) AS accuracy FROM rt GROUP BY 1"),
    "citation_families": (citation_families, "SELECT doc_id, " + ", ".join(f"len(regexp_extract_all(text, '{L.FAMILIES[k]}')) AS {k}" for k in ("air", "scc", "scc_online", "gazette", "section")) + " FROM documents WHERE text IS NOT NULL"),
    "citation_spans": (citation_spans, None),
    "citation_verify": (citation_verify, f"WITH {GRAPH}, {CITED} SELECT * FROM ver"),
    "verification_summary": (verification_summary, f"WITH {GRAPH}, {CITED} SELECT source, count(*) AS citations, count(*) FILTER (status = 'verified') AS verified, count(*) FILTER (status = 'not_found') AS missing, count(*) FILTER (status = 'kg_unavailable') AS kg_unavailable, count(*) FILTER (status <> 'verified') AS not_found, round(count(*) FILTER (status = 'verified') * 1.0 / count(*), 6)::DOUBLE AS rate FROM ver JOIN documents USING (doc_id) GROUP BY 1"),
    "temporal_warnings": (temporal_warnings, f"{GP.ALL}, {SREF}, {TEMPORAL} SELECT * FROM w WHERE reason IS NOT NULL"),
    "acts_repealed_cited": (acts_repealed_cited, "WITH c AS (SELECT unnest(content.acts_cited) AS act FROM chunks), a AS (SELECT name AS act, max(status) AS status FROM acts GROUP BY 1) SELECT act, count(*) AS n, any_value(status) AS status FROM c LEFT JOIN a USING (act) WHERE act IS NOT NULL GROUP BY 1"),
    "verification_layers": (verification_layers, f"""{GP.ALL}, {SREF}, {TEMPORAL}, {CITED}, a AS (SELECT doc_id, count(*) AS citations, count(*) FILTER (status = 'verified') AS verified, count(*) FILTER (status = 'not_found') AS not_found, count(*) FILTER (status = 'kg_unavailable') AS kg_unavailable FROM ver GROUP BY 1),
b AS (SELECT ref::BIGINT AS doc_id, count(*) AS warnings FROM w WHERE source = 'document' AND reason IS NOT NULL GROUP BY 1)
SELECT documents.doc_id, coalesce(citations, 0) AS citations, coalesce(verified, 0) AS verified, coalesce(not_found, 0) AS not_found, coalesce(kg_unavailable, 0) AS kg_unavailable, coalesce(warnings, 0) AS warnings, coalesce(not_found, 0) > 0 AS caveat
FROM documents LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id) WHERE text IS NOT NULL"""),
    "caveat_append": (caveat_append, f"WITH {GRAPH}, {CITED}, u AS (SELECT doc_id, count(*) FILTER (status = 'not_found') AS u FROM ver GROUP BY 1) SELECT doc_id, sha256(CASE WHEN coalesce(u, 0) > 0 THEN text || chr(10) || chr(10) || 'Note: ' || u || ' unsupported, 0 partly supported.' ELSE text END) AS hash FROM documents LEFT JOIN u USING (doc_id) WHERE text IS NOT NULL"),
    "confidence_score": (confidence_score, f"WITH {GRAPH}, {ROUTE.replace('q AS (', 'qr AS (', 1).replace('FROM q)', 'FROM qr)')}, " + BM25_SQL + f""", {CASES_SQL}, {CLAIMS}, m AS (SELECT id, max(document_type) AS kind, max(judgment.court_level) AS level, max(judgment.date_decided) AS day FROM chunks GROUP BY 1),
rr AS (SELECT bm.query, bm.id, round(len(list_filter(list_distinct({TOKENS_OF('qtext')}), lambda x: list_contains({TOKENS_OF('c.text')}, x))) * 1.0::DOUBLE / len(list_distinct({TOKENS_OF('qtext')})), 6) AS score FROM bm JOIN q ON q.query_id = bm.query JOIN c USING (id) WHERE bm.rank <= 10),
h AS (SELECT rr.query, score, CASE WHEN kind = 'statute' THEN 0.8 WHEN level = 1 THEN 1.0 WHEN level = 2 THEN 0.7 WHEN level = 3 THEN 0.4 WHEN level = 4 THEN 0.2 ELSE 0.1 END::DOUBLE AS au,
 CASE WHEN day IS NULL THEN 0.5 WHEN DATE '{TODAY}' - day <= 0 THEN 1.0 WHEN DATE '{TODAY}' - day < 365 THEN 0.9 WHEN DATE '{TODAY}' - day < 730 THEN 0.7 WHEN DATE '{TODAY}' - day < 1825 THEN 0.5 ELSE 0.3 END::DOUBLE AS re FROM rr JOIN m USING (id)),
g AS (SELECT query, count(*) AS n, coalesce(least(1.0::DOUBLE, avg(score) FILTER (score > 0)), 0.0::DOUBLE) AS relevance, avg(au) AS authority, avg(re) AS recency FROM h GROUP BY 1),
ct AS (SELECT query_id, unnest(list_distinct(list_concat(regexp_extract_all(hyde_text, '{L.FAMILIES['air']}'), regexp_extract_all(hyde_text, '{L.FAMILIES['scc']}'), regexp_extract_all(hyde_text, '{L.FAMILIES['scc_online']}')))) AS citation FROM qr WHERE query_id % 100 = 0),
ok AS (SELECT query_id AS query, avg((coalesce({citation_sql('citation')}, '') IN (SELECT key FROM cases WHERE key IS NOT NULL))::INT) AS citations FROM ct GROUP BY 1), ag AS (SELECT query_id AS query, avg((share >= 0.6)::INT) AS agreement FROM claims GROUP BY 1),
z AS (SELECT g.query, n, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, relevance * 0.25::DOUBLE + coalesce(citations, 1.0::DOUBLE) * 0.2::DOUBLE + authority * 0.2::DOUBLE + coalesce(agreement, 1.0::DOUBLE) * 0.15::DOUBLE + recency * 0.1::DOUBLE
 + (CASE WHEN n <= 3 THEN least(1.0::DOUBLE, b + 0.2::DOUBLE) WHEN n <= 10 THEN b ELSE greatest(0.1::DOUBLE, b - 0.2::DOUBLE) END) * 0.1::DOUBLE)), 4) AS confidence
 FROM (SELECT g.*, citations, agreement, CASE route WHEN 'simple' THEN 0.9 WHEN 'standard' THEN 0.7 WHEN 'complex' THEN 0.5 WHEN 'analytical' THEN 0.3 ELSE 0.5 END::DOUBLE AS b FROM g JOIN rt ON rt.query_id = g.query LEFT JOIN ok ON ok.query = g.query LEFT JOIN ag ON ag.query = g.query) g)
SELECT query, n, confidence, CASE WHEN confidence < 0.3 THEN 'critical' WHEN confidence < 0.6 THEN 'warning' ELSE 'good' END AS level FROM z"""),
    "section_completeness": (section_completeness, "WITH " + BM25_SQL + r""", h AS (SELECT query, lower(string_agg(c.text, ' ')) AS t FROM bm JOIN c USING (id) WHERE rank <= 5 GROUP BY 1),
w AS (SELECT query_id AS query, list_distinct(regexp_extract_all(qtext, 'section ([0-9]+[A-Z]?)', 1)) AS want FROM q),
f AS (SELECT query, want, len(list_filter(want, lambda x: regexp_matches(coalesce(t, ''), '\b' || lower(x) || '\b'))) AS found FROM w LEFT JOIN h USING (query))
SELECT query, len(want) AS expected, found, CASE WHEN len(want) > 0 THEN round(found * 1.0 / len(want), 6) ELSE 1.0 END::DOUBLE AS score FROM f"""),
    "citation_accuracy": (citation_accuracy, f"WITH {Q}, a AS (SELECT query_id, unnest(list_distinct(regexp_extract_all(hyde_text, '{L.FAMILIES['scc']}'))) AS citation FROM q WHERE hyde_text IS NOT NULL), k AS (SELECT DISTINCT unnest(content.cases_cited) AS k FROM chunks), k2 AS (SELECT k FROM k WHERE k IS NOT NULL) SELECT query_id, count(*) AS citations, round(avg((citation IN (SELECT k FROM k2))::INT), 6) AS accuracy FROM a GROUP BY 1"),
    "eval_cube": (eval_cube, "SELECT event_type, (dayofweek(ts) + 1)::BIGINT AS day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ROLLUP (1, 2)"),
}
