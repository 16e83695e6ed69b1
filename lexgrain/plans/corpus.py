"""Queries on acquisition, parsing, quality and chunk structure."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.functions.text import any_date, first_match, last_segment, tokens
from lexgrain.operators import corpus as K
from lexgrain.session import load


def _docs(spark, sf):
    """Parsed documents, the latest parse of each."""
    p = load(spark, sf, "parsed_documents")
    return K.latest(p, ["document_id"], [F.desc("parsed_at"), F.asc_nulls_last("title"), F.asc_nulls_last("date")])


DOCS = "docs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY parsed_at DESC, title NULLS LAST, date NULLS LAST) AS n FROM parsed_documents) WHERE n = 1)"


def _sections(spark, sf):
    return load(spark, sf, "sections").dropDuplicates(["document_id", "ord"])


SECT = "s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id, ord ORDER BY section_id) AS n FROM sections) WHERE n = 1)"


def latest_parse(spark, sf):
    return _docs(spark, sf).select("document_id", "title", "parser_used", F.date_format("parsed_at", "yyyy-MM-dd HH:mm:ss").alias("parsed_at"))


def source_select(spark, sf):
    """Sources by name, spelled evenly."""
    n = F.regexp_replace(F.lower(F.trim("source.source_name")), "[ -]+", "_")
    return load(spark, sf, "chunks").select(F.coalesce(n, F.lit("(none)")).alias("source"), "id").groupBy("source").agg(F.countDistinct("id").alias("chunks"))


def document_ids_from_urls(spark, sf):
    c = load(spark, sf, "chunks").select(F.col("source.url").alias("url")).where("url is not null").distinct()
    return c.select("url", last_segment(F.col("url")).alias("doc"), F.nullif(F.regexp_extract("url", "^https?://([^/]+)", 1), F.lit("")).alias("host"))


def url_first_seen_cap(spark, sf):
    """Of each source the addresses in the order of their first sight, at most 200."""
    n = F.coalesce(F.regexp_replace(F.lower(F.trim("source.source_name")), "[ -]+", "_"), F.lit("(none)"))
    d = load(spark, sf, "chunks").select(n.alias("source"), F.col("source.url").alias("url"), F.unix_micros("source.scraped_at").alias("at"))
    return K.first_seen(d, "url", "at", 200, "source")


def _crawls(spark, sf):
    """Two crawls: chunks by their text's hash, odd indices known before with
    their text, every fourth with another."""
    c = load(spark, sf, "chunks").groupBy("id").agg(F.max("text").alias("text"), F.max("chunk_index").alias("i"))
    c = c.select("id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_hash"), "i")
    old = c.where("i % 2 = 1 or i % 4 = 0").select("id", F.when(F.col("i") % 4 == 0, F.lit("other")).otherwise(F.col("content_hash")).alias("content_hash"))
    return c, old


def change_detection(spark, sf):
    found, state = _crawls(spark, sf)
    return K.changed(found, state, "id", "content_hash").select("id", "content_hash", "reason")


def skip_existing_anti(spark, sf):
    """Documents without any chunk yet."""
    return K.skip_existing(_docs(spark, sf).select("document_id", "document_type"), load(spark, sf, "chunks"), "document_id")


def crawl_state_upsert(spark, sf):
    found, state = _crawls(spark, sf)
    return K.upsert_state(state, K.changed(found, state, "id", "content_hash"), "id", ["id", "content_hash"])


def content_hash_groups(spark, sf):
    """Texts that come under several ids."""
    d = load(spark, sf, "documents").where("text is not null")
    g = d.groupBy(F.sha2("text", 256).alias("hash")).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"))
    return g.where("copies > 1")


def review_flags(spark, sf):
    d = load(spark, sf, "documents")
    f = K.review_flags(F.col("text"), F.col("document_type"), F.col("source").endswith("gazette"))
    return d.select("doc_id", F.array_join(f, ",").alias("flags"))


def document_classifier(spark, sf):
    """First matching pattern of the opening of a text."""
    pairs = [("(?i)\\bact,? \\d{4}", "statute"), ("(?i)\\bschedule\\b", "schedule"), ("(?i)\\b(v|vs)\\. ", "judgment"), ("(?i)\\bgazette\\b", "notification"), ("(?i)\\bcircular\\b", "circular")]
    d = load(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", first_match(F.col("text"), pairs, "order").alias("kind"))


def metadata_extraction(spark, sf):
    """Year, act and parties told by the title of a parsed document."""
    t = F.coalesce("title", F.lit(""))
    d = _docs(spark, sf)
    return d.select(
        "document_id", F.expr("try_cast(nullif(regexp_extract(coalesce(title, ''), '([12][0-9]{3})', 1), '') as bigint)").alias("year"),
        F.nullif(F.trim(F.regexp_extract(t, "^(.*?) (?:v|vs|versus)\\.? ", 1)), F.lit("")).alias("petitioner"),
        F.nullif(F.trim(F.regexp_extract(t, " (?:v|vs|versus)\\.? (.*)$", 1)), F.lit("")).alias("respondent"),
        t.rlike("(?i)\\b(act|adhiniyam)\\b").alias("names_act"))


def metadata_merge(spark, sf):
    """The page's metadata win over the file's where they are present: the
    latest parse by the portal, filled from the latest by another parser."""
    p = load(spark, sf, "parsed_documents")
    order = [F.desc("parsed_at"), F.asc_nulls_last("title"), F.asc_nulls_last("date")]
    a = K.latest(p.where("content_format = 'html'"), ["document_id"], order).select("document_id", *[F.col(c).alias(f"a_{c}") for c in ("title", "act_name", "year", "court")])
    b = K.latest(p.where("content_format <> 'html'"), ["document_id"], order).select("document_id", "title", "act_name", "year", "court")
    j = a.join(b, "document_id", "full")
    return j.select("document_id", *[F.coalesce(f"a_{c}", c).alias(c) for c in ("title", "act_name", "court")], F.coalesce("a_year", "year").cast("bigint").alias("year"))


def dates_best_effort(spark, sf):
    d = _docs(spark, sf)
    return d.select("document_id", F.date_format(any_date(F.col("date")), "yyyy-MM-dd").alias("day"))


def parser_router(spark, sf):
    """First parser whose condition holds; others are unsupported."""
    d = _docs(spark, sf)
    r = F.when((F.col("content_format") == "html") & (F.col("source_type") == "judgment_portal"), "html_judgment").when((F.col("content_format") == "html") & (F.col("source_type") == "statute_portal"), "html_statute").when(F.col("content_format") == "pdf", "pdf").otherwise("unsupported")
    return d.groupBy(r.alias("parser")).agg(F.count(F.lit(1)).alias("documents"))


def chunker_router(spark, sf):
    """Strategy by the structure of a document; scans of low confidence without
    structure go by page."""
    s = _sections(spark, sf).groupBy("document_id").agg(F.count_if(F.col("level") == "section").alias("n"), F.count_if(F.col("level").isin("facts", "issues", "reasoning", "holding", "order", "dissent", "obiter")).alias("j"), F.count(F.lit(1)).alias("all"))
    d = _docs(spark, sf).join(s, "document_id", "left").fillna(0, ["n", "j", "all"])
    r = (
        F.when((F.col("document_type") == "statute") & (F.col("n") >= 3), "structure_boundary")
        .when((F.col("document_type") == "judgment") & (F.col("j") >= 2), "judgment_structural")
        .when((F.col("all") == 0) & (F.col("ocr_confidence") < 0.8), "page_level")
        .when(F.col("all") > 0, "recursive_semantic")
        .otherwise("semantic_maxmin")
    )
    return d.select("document_id", r.alias("strategy"))


def chunker_predicates(spark, sf):
    g = _sections(spark, sf).groupBy("document_id").agg(F.count_if(F.col("level") == "section").alias("sections"), F.count_if(F.col("level") == "definition").alias("definitions"), F.max("depth").cast("bigint").alias("depth"))
    return g.select("document_id", "sections", "definitions", "depth", (F.col("definitions") > 0).alias("has_definitions"))


def quality_report(spark, sf):
    """Mean of the checks' scores, all passed, flagged otherwise."""
    d = _docs(spark, sf).select("document_id", F.explode("quality.checks").alias("c"))
    g = d.groupBy("document_id").agg(F.round(F.avg("c.score"), 4).alias("overall"), F.bool_and("c.passed").alias("passed"))
    return g.withColumn("flagged", ~F.col("passed"))


def text_completeness(spark, sf):
    s = _sections(spark, sf).groupBy("document_id").agg(F.sum(F.length("text")).alias("chars"))
    d = _docs(spark, sf).join(s, "document_id", "left")
    c = K.text_completeness(F.coalesce("chars", F.lit(0)), F.col("page_count"), F.col("content_format") == "html")
    return d.select("document_id", F.round(c, 6).alias("score"))


def section_gap_check(spark, sf):
    s = _sections(spark, sf).where("level = 'section'")
    return K.sequence_score(s, "document_id", "number").select("document_id", "sections", "gaps", "score")


def ocr_check(spark, sf):
    d = _docs(spark, sf).where("ocr_applied")
    return d.select("document_id", F.coalesce("ocr_confidence", F.lit(0.0)).alias("score"), (F.coalesce("ocr_confidence", F.lit(0.0)) >= 0.8).alias("passed"))


def table_integrity(spark, sf):
    """Cells of piped table rows in texts: rows whose cells differ from the first
    row's."""
    s = load(spark, sf, "sections").select("section_id", "text").where("text like '%|%'").distinct()
    r = s.select("section_id", F.posexplode(F.filter(F.split("text", "\n"), lambda x: x.rlike("^\\|[^|].*\\|$"))).alias("pos", "row"))
    r = r.select("section_id", "pos", (F.length("row") - F.length(F.regexp_replace("row", "\\|", "")) - 1).alias("cells"))
    g = r.groupBy("section_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("cells").cast("bigint").alias("cells"), F.min_by("cells", "pos").cast("bigint").alias("width"))
    return g.withColumn("whole", F.col("cells") == F.col("rows") * F.col("width"))


def chunk_siblings(spark, sf):
    c = load(spark, sf, "chunks").groupBy("id").agg(F.max("document_id").alias("document_id"), F.max("chunk_index").alias("chunk_index"))
    s = K.siblings(c, "document_id", "chunk_index", "id")
    return s.select("id", F.array_join("siblings", ",").alias("siblings"))


def chunk_reindex(spark, sf):
    """A running index from 0 within each document."""
    c = load(spark, sf, "chunks").groupBy("id").agg(F.max("document_id").alias("document_id"), F.max("chunk_index").alias("i"))
    n = K.running_total(c.withColumn("one", F.lit(1)), "document_id", "i", "id", "one")
    return n.select("id", "document_id", F.col("start").alias("chunk_index"))


def chapter_carry_down(spark, sf):
    s = K.carry_down(_sections(spark, sf), "document_id", "ord", "level", "chapter", F.coalesce("number", "title"), "chapter")
    return s.where("level = 'section'").select("document_id", F.col("ord").cast("bigint").alias("ord"), "number", "chapter")


def proviso_groups(spark, sf):
    g = K.attached_groups(_sections(spark, sf), "document_id", "ord", "level", ["proviso", "explanation"])
    return g.select("document_id", F.col("ord").cast("bigint").alias("ord"), F.col("grp").cast("bigint").alias("grp"))


def section_subtrees(spark, sf):
    t = K.subtree(_sections(spark, sf), "document_id", "section")
    return t.select("document_id", F.col("ord").cast("bigint").alias("ord"), "parts", F.col("chars").cast("bigint").alias("chars"))


def child_numbering(spark, sf):
    """Running number of children of one kind under their parent."""
    w = W.partitionBy("document_id", "parent_ord", "level").orderBy("ord")
    s = _sections(spark, sf).where("parent_ord is not null")
    return s.select("document_id", F.col("ord").cast("bigint").alias("ord"), F.concat_ws("_", "level", F.row_number().over(w)).alias("label"))


def statute_pieces(spark, sf):
    """Sections with all below them without headers; beyond 1,500 tokens by groups of
    children, and what is still beyond is cut at the limit: no part exceeds it."""
    s = _sections(spark, sf)
    back = W.partitionBy("document_id").orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
    opened = F.last(F.when(F.col("level") == "section", F.struct("ord", "last_desc")), ignorenulls=True).over(back)
    j = s.withColumn("s", opened).where("ord <= s.last_desc").select("document_id", "ord", "parent_ord", "level", F.coalesce("text", F.lit("")).alias("t"), F.col("s.ord").alias("section"))
    w = W.partitionBy("document_id", "section").orderBy("ord")
    # pre-order: what is below a child follows it, and so falls into its group
    starts = (F.col("parent_ord") == F.col("section")) & (~F.col("level").isin("proviso", "explanation") | (F.row_number().over(w) == 2))
    j = j.withColumn("starts", F.coalesce(starts, F.lit(False)).cast("int")).withColumn("grp", F.sum("starts").over(w.rowsBetween(W.unboundedPreceding, 0)))
    j = j.withColumn("whole", F.sum(F.length("t")).over(W.partitionBy("document_id", "section")))
    j = j.withColumn("piece", F.when(F.expr("whole div 4 <= 1500"), 0).otherwise(F.col("grp")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "t"))), lambda x: x["t"]), "")
    g = j.groupBy("document_id", "section", "piece").agg(text.alias("text"))
    cut = F.when(F.expr("length(text) div 4 <= 1500"), F.array("text")).otherwise(K.fixed_pieces(F.col("text"), 6000))
    p = g.select("document_id", "section", "piece", F.posexplode(cut).alias("part", "text"))
    return p.select("document_id", F.col("section").cast("bigint").alias("section"), F.col("piece").cast("bigint").alias("piece"), F.col("part").cast("bigint").alias("part"), "text")


def judgment_headers(spark, sf):
    """The header's id on every other part of a judgment."""
    s = _sections(spark, sf)
    w = W.partitionBy("document_id").orderBy("ord")
    h = F.first(F.when(F.col("level") == "header", F.col("section_id")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return s.withColumn("header", h).where("header is not null and header <> section_id").select("document_id", F.col("ord").cast("bigint").alias("ord"), "header")


def page_level_chunks(spark, sf):
    """Pages of a text with form feeds, else pieces of 6,000 characters."""
    d = load(spark, sf, "documents").where("text is not null and text <> ''")
    pages = F.when(F.contains("text", F.lit("\f")), F.filter(F.split("text", "\f"), lambda x: F.trim(F.regexp_replace(x, "[\\r\\n\\t]", "")) != "")).otherwise(K.fixed_pieces(F.col("text"), 6000))
    p = d.select("doc_id", F.posexplode(pages).alias("page", "t"))
    return p.select("doc_id", F.col("page").cast("bigint").alias("page"), F.length("t").cast("bigint").alias("chars"))


def paragraph_packing(spark, sf):
    """Greedy packing of paragraphs into pieces of 2,000 characters."""
    d = load(spark, sf, "documents").where("text is not null")
    p = d.select("doc_id", F.posexplode(K.pack_paragraphs(F.col("text"), 2000)).alias("piece", "t"))
    return p.select("doc_id", F.col("piece").cast("bigint").alias("piece"), F.length("t").cast("bigint").alias("chars"))


def sentence_counts(spark, sf):
    d = load(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", F.size(F.filter(F.split("text", "[.!?]\\s+"), lambda x: F.trim(x) != "")).cast("bigint").alias("sentences"))


def _in_order(spark, sf):
    """Chunks once each, with their place and text."""
    c = load(spark, sf, "chunks").groupBy("id").agg(F.max("document_id").alias("document_id"), F.max("chunk_index").alias("chunk_index"), F.max("text").alias("text"))
    return c.where("document_id is not null")


def context_windows(spark, sf):
    """The window of its document's text that each chunk belongs to, and those that it
    stands in: windows of 180,000 tokens that share 500."""
    c = _in_order(spark, sf).select("id", "document_id", "chunk_index", F.expr("coalesce(length(text), 0) div 4").alias("tokens"))
    return K.token_windows(c).select("id", "start", "window", "other")


def enrichment_filter(spark, sf):
    c = load(spark, sf, "chunks").where("not ingestion.contextualized and not ingestion.requires_manual_review")
    return c.groupBy("document_type").agg(F.countDistinct("id").alias("chunks"))


def question_lines(spark, sf):
    """Lines that are questions or long enough, numbered; from the texts of
    generated answers."""
    q = load(spark, sf, "queries").where("hyde_text is not null").select("query_id", "hyde_text").distinct()
    lines = F.filter(F.transform(F.split("hyde_text", "\\. "), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit("?")) | (F.length(x) > 20))
    return q.select("query_id", F.posexplode(lines).alias("q", "question")).select("query_id", F.col("q").cast("bigint").alias("q"), "question")


def hindi_detection(spark, sf):
    d = load(spark, sf, "documents").where("text is not null")
    n = F.length("text") - F.length(F.regexp_replace("text", "[ऀ-ॿ]", ""))
    return d.select("doc_id", (n > 0).alias("has_hindi"), F.when(n > 20, "hi").otherwise("en").alias("language"))


def court_levels(spark, sf):
    """Level by keyword, district where none fits."""
    pairs = [("(?i)supreme court", "1"), ("(?i)high court", "2"), ("(?i)district court|sessions court", "3"), ("(?i)tribunal", "4"), ("(?i)commission|authority", "5")]
    d = load(spark, sf, "judgments").where("court is not null")
    return d.select("judgment_id", first_match(F.col("court"), pairs, "3").cast("bigint").alias("level"))


def citations_in_texts(spark, sf):
    """Sections, acts and cases that a text names, each once, in order."""
    d = load(spark, sf, "documents").where("text is not null")
    s = F.array_distinct(F.regexp_extract_all("text", F.lit("[Ss]ection ([0-9]+[A-Z]?)"), F.lit(1)))
    a = F.array_distinct(F.regexp_extract_all("text", F.lit("((?:[A-Z][a-z]+ ){1,6}Act, [0-9]{4})"), F.lit(1)))
    c = F.array_distinct(F.regexp_extract_all("text", F.lit("(AIR [0-9]{4} [A-Za-z]+ [0-9]+|\\([0-9]{4}\\) [0-9]+ SCC [0-9]+)"), F.lit(1)))
    return d.select("doc_id", *[F.array_join(x, "|").alias(n) for x, n in ((s, "sections"), (a, "acts"), (c, "cases"))])


def run_summary(spark, sf):
    c = load(spark, sf, "chunks")
    s = F.when(F.col("text").isNull(), "failed").when(F.col("ingestion.requires_manual_review"), "skipped").otherwise("processed")
    return K.run_summary(c.withColumn("status", s), "status")


def language_cube(spark, sf):
    """Texts by type and language with subtotals."""
    d = load(spark, sf, "documents").select(F.coalesce("document_type", F.lit("?")).alias("kind"), F.lower(F.coalesce("lang", F.lit("?"))).alias("language"), "n_chars")
    return d.cube("kind", "language").agg(F.count(F.lit(1)).alias("texts"), F.sum("n_chars").alias("chars"))


def vocabulary_by_type(spark, sf):
    d = load(spark, sf, "documents").where("text is not null")
    t = d.select("document_type", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    g = t.groupBy("document_type", "term").agg(F.count(F.lit(1)).alias("df"))
    w = W.partitionBy("document_type").orderBy(F.desc("df"), "term")
    return g.withColumn("rank", F.row_number().over(w)).where("rank <= 20").withColumn("rank", F.col("rank").cast("bigint"))


CRAWL = """c AS (SELECT id, sha256(coalesce(max(text), '')) AS content_hash, max(chunk_index) AS i FROM chunks GROUP BY id),
old AS (SELECT id, CASE WHEN i % 4 = 0 THEN 'other' ELSE content_hash END AS content_hash FROM c WHERE i % 2 = 1 OR i % 4 = 0)"""
QUERIES = {
    "latest_parse": (latest_parse, "WITH " + DOCS + " SELECT document_id, title, parser_used, strftime(parsed_at AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS parsed_at FROM docs"),
    "source_select": (source_select, "SELECT coalesce(regexp_replace(lower(trim(source.source_name)), '[ -]+', '_', 'g'), '(none)') AS source, count(DISTINCT id) AS chunks FROM chunks GROUP BY 1"),
    "document_ids_from_urls": (document_ids_from_urls, "SELECT DISTINCT source.url AS url, nullif(regexp_extract(regexp_replace(source.url, '/+$', ''), '([^/]+)$', 1), '') AS doc, nullif(regexp_extract(source.url, '^https?://([^/]+)', 1), '') AS host FROM chunks WHERE source.url IS NOT NULL"),
    "url_first_seen_cap": (url_first_seen_cap, "WITH u AS (SELECT coalesce(regexp_replace(lower(trim(source.source_name)), '[ -]+', '_', 'g'), '(none)') AS source, regexp_replace(source.url, '/+$', '') AS url, min(epoch_us(source.scraped_at)) AS seq FROM chunks WHERE source.url IS NOT NULL GROUP BY 1, 2) SELECT source, url, seq FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq NULLS FIRST, url) AS n FROM u) WHERE n <= 200"),
    "change_detection": (change_detection, "WITH " + CRAWL + " SELECT c.id, c.content_hash, CASE WHEN old.id IS NULL THEN 'new' ELSE 'changed' END AS reason FROM c LEFT JOIN old USING (id) WHERE old.id IS NULL OR old.content_hash <> c.content_hash"),
    "skip_existing_anti": (skip_existing_anti, "WITH " + DOCS + " SELECT document_id, document_type FROM docs WHERE document_id NOT IN (SELECT document_id FROM chunks WHERE document_id IS NOT NULL)"),
    "crawl_state_upsert": (crawl_state_upsert, "WITH " + CRAWL + " SELECT id, content_hash FROM c"),
    "content_hash_groups": (content_hash_groups, "SELECT sha256(text) AS hash, count(*) AS copies, min(doc_id) AS first FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1"),
    "review_flags": (review_flags, r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, document_type, source FROM documents),
f AS (SELECT doc_id, length(t) AS n, length(regexp_replace(t, '[^\x00-\x7F]', '', 'g')) AS a, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS l, document_type, source FROM d)
SELECT doc_id, concat_ws(',', CASE WHEN n < 500 THEN 'small_content' END, CASE WHEN n > 0 AND (n - a) * 1.0 / n > 0.3 THEN 'non_latin' END,
 CASE WHEN source LIKE '%gazette' AND n > 1000 AND l * 1.0 / n < 0.1 THEN 'likely_scan' END, CASE WHEN document_type IS NULL THEN 'missing_title' END) AS flags FROM f"""),
    "document_classifier": (document_classifier, r"""SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)\bact,? \d{4}') THEN 'statute' WHEN regexp_matches(text, '(?i)\bschedule\b') THEN 'schedule'
 WHEN regexp_matches(text, '(?i)\b(v|vs)\. ') THEN 'judgment' WHEN regexp_matches(text, '(?i)\bgazette\b') THEN 'notification' WHEN regexp_matches(text, '(?i)\bcircular\b') THEN 'circular' ELSE 'order' END AS kind FROM documents WHERE text IS NOT NULL"""),
    "metadata_extraction": (metadata_extraction, "WITH " + DOCS + r""" SELECT document_id, try_cast(nullif(regexp_extract(coalesce(title, ''), '([12][0-9]{3})', 1), '') AS BIGINT) AS year,
 nullif(trim(regexp_extract(coalesce(title, ''), '^(.*?) (?:v|vs|versus)\.? ', 1)), '') AS petitioner, nullif(trim(regexp_extract(coalesce(title, ''), ' (?:v|vs|versus)\.? (.*)$', 1)), '') AS respondent,
 regexp_matches(coalesce(title, ''), '(?i)\b(act|adhiniyam)\b') AS names_act FROM docs"""),
    "metadata_merge": (metadata_merge, """WITH r AS (SELECT *, content_format = 'html' AS h, row_number() OVER (PARTITION BY document_id, content_format = 'html' ORDER BY parsed_at DESC, title NULLS LAST, date NULLS LAST) AS n FROM parsed_documents WHERE content_format IS NOT NULL),
a AS (SELECT * FROM r WHERE n = 1 AND h), b AS (SELECT * FROM r WHERE n = 1 AND NOT h)
SELECT document_id, coalesce(a.title, b.title) AS title, coalesce(a.act_name, b.act_name) AS act_name, coalesce(a.court, b.court) AS court, coalesce(a.year, b.year)::BIGINT AS year FROM a FULL JOIN b USING (document_id)"""),
    "dates_best_effort": (dates_best_effort, "WITH " + DOCS + """ SELECT document_id, strftime(coalesce(try_strptime(trim(date), '%Y-%m-%d'), try_strptime(trim(date), '%d-%m-%Y'), try_strptime(trim(date), '%d/%m/%Y'), try_strptime(trim(date), '%d %B, %Y'), try_strptime(trim(date), '%d %B %Y')), '%Y-%m-%d') AS day FROM docs"""),
    "parser_router": (parser_router, "WITH " + DOCS + " SELECT CASE WHEN content_format = 'html' AND source_type = 'judgment_portal' THEN 'html_judgment' WHEN content_format = 'html' AND source_type = 'statute_portal' THEN 'html_statute' WHEN content_format = 'pdf' THEN 'pdf' ELSE 'unsupported' END AS parser, count(*) AS documents FROM docs GROUP BY 1"),
    "chunker_router": (chunker_router, "WITH " + DOCS + ", " + SECT + """, g AS (SELECT document_id, count(*) FILTER (level = 'section') AS n, count(*) FILTER (level IN ('facts','issues','reasoning','holding','order','dissent','obiter')) AS j, count(*) AS a FROM s GROUP BY 1)
SELECT document_id, CASE WHEN document_type = 'statute' AND coalesce(g.n, 0) >= 3 THEN 'structure_boundary' WHEN document_type = 'judgment' AND coalesce(j, 0) >= 2 THEN 'judgment_structural'
 WHEN coalesce(a, 0) = 0 AND ocr_confidence < 0.8 THEN 'page_level' WHEN coalesce(a, 0) > 0 THEN 'recursive_semantic' ELSE 'semantic_maxmin' END AS strategy FROM docs LEFT JOIN g USING (document_id)"""),
    "chunker_predicates": (chunker_predicates, "WITH " + SECT + " SELECT document_id, count(*) FILTER (level = 'section') AS sections, count(*) FILTER (level = 'definition') AS definitions, max(depth)::BIGINT AS depth, count(*) FILTER (level = 'definition') > 0 AS has_definitions FROM s GROUP BY 1"),
    "quality_report": (quality_report, "WITH " + DOCS + ", c AS (SELECT document_id, unnest(quality.checks) AS c FROM docs) SELECT document_id, round(avg(c.score), 4) AS overall, bool_and(c.passed) AS passed, NOT bool_and(c.passed) AS flagged FROM c GROUP BY 1"),
    "text_completeness": (text_completeness, "WITH " + DOCS + ", " + SECT + """, g AS (SELECT document_id, sum(length(text)) AS chars FROM s GROUP BY 1)
SELECT document_id, round(CASE WHEN content_format = 'html' OR page_count IS NULL OR page_count = 0 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, coalesce(chars, 0)::DOUBLE / (page_count * 2000)) END, 6) AS score FROM docs LEFT JOIN g USING (document_id)"""),
    "section_gap_check": (section_gap_check, "WITH " + SECT + """, n AS (SELECT document_id, try_cast(nullif(regexp_extract(number, '^([0-9]+)', 1), '') AS INT) AS n FROM s WHERE level = 'section'),
g AS (SELECT document_id, n, lag(n) OVER (PARTITION BY document_id ORDER BY n) AS p FROM n WHERE n IS NOT NULL)
SELECT document_id, count(*) AS sections, count(*) FILTER (n > p + 1) AS gaps, CASE WHEN count(*) < 2 THEN 1.0::DOUBLE ELSE round(greatest(0.0::DOUBLE, 1 - count(*) FILTER (n > p + 1)::DOUBLE / (count(*) - 1)), 6) END AS score FROM g GROUP BY 1"""),
    "ocr_check": (ocr_check, "WITH " + DOCS + " SELECT document_id, coalesce(ocr_confidence, 0.0::DOUBLE) AS score, coalesce(ocr_confidence, 0.0) >= 0.8 AS passed FROM docs WHERE ocr_applied"),
    "table_integrity": (table_integrity, r"""WITH s AS (SELECT DISTINCT section_id, text FROM sections WHERE text LIKE '%|%'),
r AS (SELECT section_id, unnest(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\|[^|].*\|$'))) AS row, generate_subscripts(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\|[^|].*\|$')), 1) AS pos FROM s),
k AS (SELECT section_id, pos, length(row) - length(replace(row, '|', '')) - 1 AS cells FROM r)
SELECT section_id, count(*) AS rows, sum(cells)::BIGINT AS cells, arg_min(cells, pos)::BIGINT AS width, sum(cells) = count(*) * arg_min(cells, pos) AS whole FROM k GROUP BY 1"""),
    "chunk_siblings": (chunk_siblings, """WITH c AS (SELECT id, max(document_id) AS d, max(chunk_index) AS i FROM chunks GROUP BY id)
SELECT id, array_to_string(list_concat(coalesce(list(id) OVER (PARTITION BY d ORDER BY i, id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), []), coalesce(list(id) OVER (PARTITION BY d ORDER BY i, id ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), [])), ',') AS siblings FROM c"""),
    "chunk_reindex": (chunk_reindex, "WITH c AS (SELECT id, max(document_id) AS document_id, max(chunk_index) AS i FROM chunks GROUP BY id) SELECT id, document_id, row_number() OVER (PARTITION BY document_id ORDER BY i NULLS FIRST, id) - 1 AS chunk_index FROM c"),
    "chapter_carry_down": (chapter_carry_down, "WITH " + SECT + ", w AS (SELECT *, last_value(CASE WHEN level = 'chapter' THEN coalesce(number, title) END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS chapter FROM s) SELECT document_id, ord::BIGINT AS ord, number, chapter FROM w WHERE level = 'section'"),
    "proviso_groups": (proviso_groups, "WITH " + SECT + ", o AS (SELECT document_id, ord, CASE WHEN level IN ('proviso', 'explanation') AND row_number() OVER (PARTITION BY document_id ORDER BY ord) > 1 THEN 0 ELSE 1 END AS o FROM s) SELECT document_id, ord::BIGINT AS ord, sum(o) OVER (PARTITION BY document_id ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS grp FROM o"),
    "section_subtrees": (section_subtrees, "WITH " + SECT + " SELECT a.document_id, a.ord::BIGINT AS ord, count(*) AS parts, sum(coalesce(length(b.text), 0))::BIGINT AS chars FROM s a JOIN s b ON a.document_id = b.document_id AND b.ord BETWEEN a.ord AND a.last_desc WHERE a.level = 'section' GROUP BY 1, 2"),
    "child_numbering": (child_numbering, "WITH " + SECT + " SELECT document_id, ord::BIGINT AS ord, concat_ws('_', level, row_number() OVER (PARTITION BY document_id, parent_ord, level ORDER BY ord)) AS label FROM s WHERE parent_ord IS NOT NULL"),
    "statute_pieces": (statute_pieces, None),
    "judgment_headers": (judgment_headers, "WITH " + SECT + ", h AS (SELECT document_id, arg_min(section_id, ord) AS header FROM s WHERE level = 'header' GROUP BY 1) SELECT document_id, ord::BIGINT AS ord, header FROM s JOIN h USING (document_id) WHERE section_id <> header"),
    "page_level_chunks": (page_level_chunks, r"""WITH d AS (SELECT doc_id, CASE WHEN contains(text, chr(12)) THEN list_filter(string_split(text, chr(12)), lambda x: trim(regexp_replace(x, '[\r\n\t]', '', 'g')) <> '') ELSE list_transform(range(0, (length(text) + 5999) // 6000), lambda i: substr(text, i * 6000 + 1, 6000)) END AS p FROM documents WHERE text IS NOT NULL AND text <> '')
SELECT doc_id, (generate_subscripts(p, 1) - 1)::BIGINT AS page, length(unnest(p)) AS chars FROM d"""),
    "paragraph_packing": (paragraph_packing, """WITH p AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS a FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, string_split(list_reduce(a, lambda s, x: s || CASE WHEN length(string_split(s, chr(30))[-1]) + 1 + length(x) <= 2000 THEN chr(10) ELSE chr(30) END || x), chr(30)) AS p FROM p WHERE len(a) > 0)
SELECT doc_id, (generate_subscripts(p, 1) - 1)::BIGINT AS piece, length(unnest(p)) AS chars FROM r"""),
    "sentence_counts": (sentence_counts, r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[.!?]\s+'), lambda x: trim(x) <> '')) AS sentences FROM documents WHERE text IS NOT NULL"),
    "context_windows": (context_windows, """WITH c AS (SELECT id, max(document_id) AS d, max(chunk_index) AS i, coalesce(length(max(text)), 0) // 4 AS t FROM chunks GROUP BY id HAVING max(document_id) IS NOT NULL),
s AS (SELECT id, t, (sum(t) OVER (PARTITION BY d ORDER BY i NULLS FIRST, id ROWS UNBOUNDED PRECEDING) - t)::BIGINT AS start FROM c)
SELECT id, start, start // 179500 AS window, CASE WHEN start >= 179500 AND start % 179500 < 500 THEN start // 179500 - 1 END AS other FROM s"""),
    "enrichment_filter": (enrichment_filter, "SELECT document_type, count(DISTINCT id) AS chunks FROM chunks WHERE NOT ingestion.contextualized AND NOT ingestion.requires_manual_review GROUP BY 1"),
    "question_lines": (question_lines, "WITH q AS (SELECT DISTINCT query_id, list_filter(list_transform(string_split(hyde_text, '. '), lambda x: trim(x)), lambda x: contains(x, '?') OR length(x) > 20) AS l FROM queries WHERE hyde_text IS NOT NULL) SELECT query_id, (generate_subscripts(l, 1) - 1)::BIGINT AS q, unnest(l) AS question FROM q"),
    "hindi_detection": (hindi_detection, "WITH d AS (SELECT doc_id, length(text) - length(regexp_replace(text, '[ऀ-ॿ]', '', 'g')) AS n FROM documents WHERE text IS NOT NULL) SELECT doc_id, n > 0 AS has_hindi, CASE WHEN n > 20 THEN 'hi' ELSE 'en' END AS language FROM d"),
    "court_levels": (court_levels, "SELECT judgment_id, CASE WHEN regexp_matches(court, '(?i)supreme court') THEN 1 WHEN regexp_matches(court, '(?i)high court') THEN 2 WHEN regexp_matches(court, '(?i)district court|sessions court') THEN 3 WHEN regexp_matches(court, '(?i)tribunal') THEN 4 WHEN regexp_matches(court, '(?i)commission|authority') THEN 5 ELSE 3 END::BIGINT AS level FROM judgments WHERE court IS NOT NULL"),
    "citations_in_texts": (citations_in_texts, None),
    "run_summary": (run_summary, "SELECT count(*) AS found, count(*) FILTER (text IS NOT NULL AND NOT coalesce(ingestion.requires_manual_review, false)) AS processed, count(*) FILTER (text IS NOT NULL AND ingestion.requires_manual_review) AS skipped, count(*) FILTER (text IS NULL) AS failed FROM chunks"),
    "language_cube": (language_cube, "SELECT coalesce(document_type, '?') AS kind, lower(coalesce(lang, '?')) AS language, count(*) AS texts, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY CUBE (1, 2)"),
    "vocabulary_by_type": (vocabulary_by_type, "WITH t AS (SELECT document_type, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM documents WHERE text IS NOT NULL), g AS (SELECT document_type, term, count(*) AS df FROM t GROUP BY 1, 2) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_type ORDER BY df DESC, term) AS rank FROM g) WHERE rank <= 20"),
}
QUERIES["citations_in_texts"] = (citations_in_texts, r"""WITH d AS (SELECT doc_id, regexp_extract_all(text, '[Ss]ection ([0-9]+[A-Z]?)', 1) AS s, regexp_extract_all(text, '((?:[A-Z][a-z]+ ){1,6}Act, [0-9]{4})', 1) AS a,
 regexp_extract_all(text, '(AIR [0-9]{4} [A-Za-z]+ [0-9]+|\([0-9]{4}\) [0-9]+ SCC [0-9]+)', 1) AS c FROM documents WHERE text IS NOT NULL)
SELECT doc_id, array_to_string(list_filter(s, lambda x, i: list_position(s, x) = i), '|') AS sections, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), '|') AS acts, array_to_string(list_filter(c, lambda x, i: list_position(c, x) = i), '|') AS cases FROM d""")
