"""Queries that cut documents into chunks, by the strategy of each."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.functions import structure as S
from lexgrain.operators import chunking as C
from lexgrain.operators import providers as P
from lexgrain.plans.corpus import DOCS, QUERIES as CORPUS, SECT, _docs, _sections, chunker_router
from lexgrain.session import load


def _of(spark, sf, strategy):
    d = chunker_router(spark, sf).where(F.col("strategy") == strategy).select("document_id")
    return _docs(spark, sf).join(d, "document_id", "left_semi")


def _statutes(spark, sf):
    acts = _of(spark, sf, "structure_boundary").select("document_id", F.coalesce("act_name", "title").alias("act"))
    return C.statute_chunks(_sections(spark, sf).select("document_id", "ord", "last_desc", "parent_ord", "level", "number", "title", "text"), acts)


def _judgments(spark, sf):
    return C.judgment_chunks(_sections(spark, sf).join(_of(spark, sf, "judgment_structural").select("document_id"), "document_id", "left_semi").select("document_id", "ord", "level", "text"))


def _shown(df, *ints):
    """The text by its hash and size, whole numbers as such."""
    cols = [F.col(c).cast("bigint").alias(c) if c in ints else F.col(c) for c in df.columns if c != "text"]
    return df.select(*cols, F.sha2("text", 256).alias("hash"), F.length("text").cast("bigint").alias("chars"))


def statute_chunks(spark, sf):
    """Chunks of the statutes that have the structure for it."""
    return _shown(_statutes(spark, sf), "ord", "piece", "part")


def judgment_chunks(spark, sf):
    return _shown(_judgments(spark, sf), "ord", "part")


def _whole(spark, sf, strategy):
    """(document_id, text): the sections' texts of a document in order."""
    s = _sections(spark, sf).where("text is not null").join(_of(spark, sf, strategy).select("document_id"), "document_id", "left_semi")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n\n")
    return s.groupBy("document_id").agg(text.alias("text"))


def routed_chunks(spark, sf):
    """Every document by its own strategy, all chunks numbered within their document,
    with their neighbours. Documents without any section have no text in the tables,
    so that the strategies for these give nothing here."""
    cols = ["document_id", "ord", "piece", "part", "strategy", "text"]
    a = _statutes(spark, sf).withColumn("strategy", F.lit("structure_boundary"))
    b = _judgments(spark, sf).withColumns({"strategy": F.lit("judgment_structural"), "piece": F.lit(0)})
    r = P.semantic_chunks(_whole(spark, sf, "recursive_semantic").withColumnRenamed("document_id", "id"), P.provider("hash"))
    r = r.select(F.col("id").alias("document_id"), F.lit(0).alias("ord"), "piece", F.lit(0).alias("part"), F.lit("recursive_semantic").alias("strategy"), "text")
    out = a.select(*cols).unionByName(b.select(*cols)).unionByName(r)
    out = out.withColumn("id", C.chunk_id(F.col("document_id"), F.col("ord"), F.col("piece"), F.col("part")))
    w = W.partitionBy("document_id").orderBy("ord", "piece", "part")
    near = F.concat(F.collect_list("id").over(w.rowsBetween(-2, -1)), F.collect_list("id").over(w.rowsBetween(1, 2)))
    out = out.withColumn("chunk_index", F.row_number().over(w) - 1).withColumn("siblings", F.array_join(near, ","))
    return _shown(out.select("id", "document_id", "strategy", "chunk_index", "siblings", "text"), "chunk_index")


def maxmin_chunks(spark, sf):
    """Texts cut where neighbouring sentences are least alike."""
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return P.maxmin_chunks(d, P.provider("hash")).select("id", F.col("piece").cast("bigint").alias("piece"), F.sha2("text", 256).alias("hash"), F.length("text").cast("bigint").alias("chars"))


def _lines(spark, sf):
    d = load(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", F.posexplode(F.split("text", "\r\n|\n|\r|\f")).alias("line", "t")).select("doc_id", F.col("line").cast("bigint").alias("line"), "t")


def statute_lines(spark, sf):
    """Units that open at lines, with the chapter and section that they stand in."""
    ln = _lines(spark, sf).withColumn("level", S.statute_level(F.col("t"))).where("level is not null").withColumn("number", S.statute_number(F.col("t")))
    w = W.partitionBy("doc_id").orderBy("line").rowsBetween(W.unboundedPreceding, 0)
    last = lambda x: F.last(F.when(F.col("level") == x, F.col("number")), ignorenulls=True).over(w)
    return ln.select("doc_id", "line", "level", "number", last("chapter").alias("chapter"), last("section").alias("section"))


def judgment_headings(spark, sf):
    """Titles of sections that are headings of a judgment's parts."""
    t = _sections(spark, sf).where("title is not null").withColumn("part", S.heading_class(S.without_marks(F.col("title"))))
    return t.where("part is not null").select("document_id", F.col("ord").cast("bigint").alias("ord"), "part")


_R = "(" + CORPUS["chunker_router"][1] + ")"
STATUTES = f"""{DOCS}, {SECT}, rt AS {_R}, sd AS (SELECT docs.document_id, coalesce(act_name, title) AS act FROM docs JOIN rt USING (document_id) WHERE strategy = 'structure_boundary'),
c0 AS (SELECT s.document_id, act, ord, parent_ord, level, coalesce(text, '') AS t, last_value(CASE WHEN level = 'section' THEN struct_pack(o := ord, l := last_desc, n := number, t := s.title) END IGNORE NULLS) OVER (PARTITION BY s.document_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS e FROM s JOIN sd USING (document_id)),
c1 AS (SELECT *, e.o AS sec, coalesce(act, 'Unknown act') || ', Section ' || coalesce(e.n, '?') || coalesce(' — ' || e.t, '') AS header FROM c0 WHERE ord <= e.l),
c2 AS (SELECT *, greatest(1500, 6003 - length(header) - 2) AS room, CASE WHEN parent_ord = sec AND (level NOT IN ('proviso', 'explanation') OR row_number() OVER (PARTITION BY document_id, sec ORDER BY ord) = 2) THEN 1 ELSE 0 END AS o, sum(length(t) + 2) OVER (PARTITION BY document_id, sec) AS a FROM c1),
c3 AS (SELECT *, CASE WHEN a - 2 <= room THEN 0 ELSE sum(o) OVER (PARTITION BY document_id, sec ORDER BY ord ROWS UNBOUNDED PRECEDING) END AS piece FROM c2),
c4 AS (SELECT document_id, sec AS ord, piece, header, room, string_agg(t, chr(10) || chr(10) ORDER BY ord) FILTER (t <> '') AS body FROM c3 GROUP BY document_id, sec, piece, header, room),
c5 AS (SELECT document_id, ord, piece, unnest(range(0, (length(body) + room - 1) // room)) AS part, header, body, room FROM c4 WHERE body <> ''),
c6 AS (SELECT document_id, ord, piece, part, 'section' AS kind, header, header || chr(10) || chr(10) || substr(body, part * room + 1, room) AS text FROM c5
UNION ALL SELECT document_id, ord, 0, 0, level, coalesce(act, 'Unknown act'), t FROM c0 WHERE NOT coalesce(ord <= e.l, false) AND trim(t) <> ''),
c7 AS (SELECT *, substr(sha256(concat_ws('|', document_id, ord::VARCHAR, piece::VARCHAR, part::VARCHAR)), 1, 16) AS id FROM c6),
c8 AS (SELECT *, first_value(id) OVER (PARTITION BY document_id, ord ORDER BY piece, part) AS f FROM c7)"""
JUDGMENTS = f"""{DOCS}, {SECT}, rt AS {_R}, j0 AS (SELECT document_id, ord, level AS kind, text FROM s JOIN rt USING (document_id) WHERE strategy = 'judgment_structural' AND trim(coalesce(text, '')) <> ''),
j1 AS (SELECT *, kind IN ('facts', 'issues', 'reasoning', 'order', 'dissent', 'obiter') AND length(text) > 6000 AS cut FROM j0),
j2 AS (SELECT *, CASE WHEN cut THEN string_split(list_reduce(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''), lambda a, x: a || CASE WHEN length(string_split(a, chr(30))[-1]) + 1 + length(x) <= 6000 THEN chr(10) ELSE chr(30) END || x), chr(30)) ELSE [text] END AS p FROM j1),
j3 AS (SELECT document_id, ord, kind, CASE WHEN cut THEN flatten(list_transform(p, lambda x: list_transform(range(0, (length(x) + 5999) // 6000), lambda i: substr(x, i * 6000 + 1, 6000)))) ELSE p END AS p FROM j2),
j4 AS (SELECT document_id, ord, kind, generate_subscripts(p, 1) - 1 AS part, unnest(p) AS text FROM j3),
j5 AS (SELECT *, substr(sha256(concat_ws('|', document_id, ord::VARCHAR, '0', part::VARCHAR)), 1, 16) AS id FROM j4),
j6 AS (SELECT *, first_value(id) OVER (PARTITION BY document_id, ord ORDER BY part) AS f, first_value(CASE WHEN kind = 'header' THEN id END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY ord, part ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS h FROM j5)"""
LINES = r"l0 AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|\n|\r|\f') AS a FROM documents WHERE text IS NOT NULL), ln AS (SELECT doc_id, (generate_subscripts(a, 1) - 1)::BIGINT AS line, unnest(a) AS t FROM l0)"
_LEVEL = "CASE " + " ".join(f"WHEN regexp_matches(t, '{f}') THEN '{k}'" for k, f in S.STATUTE_LINES) + " END"
_NUMBER = "CASE " + " ".join(f"WHEN regexp_matches(t, '{f}') THEN nullif(upper(regexp_extract(t, '{f}', 1)), '')" for _, f in S.STATUTE_LINES) + " END"
_HEAD = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(w, '{p}')" for p in ps) + f" THEN '{k}'" for k, ps in S.JUDGMENT_HEADINGS.items()) + " WHEN w = 'order' THEN 'order' END"

QUERIES = {
    "statute_chunks": (statute_chunks, f"WITH {STATUTES} SELECT document_id, ord::BIGINT AS ord, piece::BIGINT AS piece, part::BIGINT AS part, kind, header, id, CASE WHEN f <> id THEN f END AS parent_id, sha256(text) AS hash, length(text) AS chars FROM c8"),
    "judgment_chunks": (judgment_chunks, f"WITH {JUDGMENTS} SELECT document_id, ord::BIGINT AS ord, kind, part::BIGINT AS part, id, CASE WHEN h <> id THEN h END AS header_id, CASE WHEN f <> id THEN f END AS parent_id, sha256(text) AS hash, length(text) AS chars FROM j6"),
    "routed_chunks": (routed_chunks, None),
    "maxmin_chunks": (maxmin_chunks, None),
    "statute_lines": (statute_lines, f"WITH {LINES}, u AS (SELECT doc_id, line, {_LEVEL} AS level, {_NUMBER} AS number FROM ln) SELECT doc_id, line, level, number, last_value(CASE WHEN level = 'chapter' THEN number END IGNORE NULLS) OVER w AS chapter, last_value(CASE WHEN level = 'section' THEN number END IGNORE NULLS) OVER w AS section FROM u WHERE level IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY line ROWS UNBOUNDED PRECEDING)"),
    "judgment_headings": (judgment_headings, f"WITH {SECT}, u AS (SELECT document_id, ord, lower(trim(regexp_replace(title, '^#{{1,6}}[ \\t]+', ''))) AS w FROM s WHERE title IS NOT NULL), p AS (SELECT document_id, ord, {_HEAD} AS part FROM u) SELECT document_id, ord::BIGINT AS ord, part FROM p WHERE part IS NOT NULL"),
}
