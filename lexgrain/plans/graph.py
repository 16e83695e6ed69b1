"""Queries on the property graph: acts, sections, their versions, judgments,
amendments, legal concepts, courts and judges.

Acts and citations are keyed by canonical forms (:mod:`lexgrain.functions.names`), so
that an edge finds its ends however they were typed. A section is act|number, a
version act:number:hash, an amendment act|date|nature.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.functions import legal as L
from lexgrain.functions.names import act_key, act_sql, citation_key, citation_sql, plain_key, plain_sql
from lexgrain.operators import graph as G
from lexgrain.session import cut, load


def _seq():
    """Order of ingestion: time, then id."""
    return F.struct("ingestion.ingested_at", "id")


def _statute(spark, sf):
    return load(spark, sf, "chunks").withColumn("act", act_key(F.col("statute.act_name"))).where("act is not null")


def _judgment(spark, sf):
    return load(spark, sf, "chunks").withColumn("cite", citation_key(F.col("judgment.case_citation"))).where("cite is not null")


def kg_acts(spark, sf):
    c = lambda n: F.col(f"statute.{n}")
    return G.upsert_nodes(_statute(spark, sf), ["act"], _seq(), {"name": c("act_name"), "number": c("act_number"), "date_effective": c("date_effective"), "date_repealed": c("date_repealed")}, {"status": c("temporal_status")})


def kg_sections(spark, sf):
    c = lambda n: F.col(f"statute.{n}")
    return G.upsert_nodes(_statute(spark, sf).where("statute.section_number is not null"), ["act", c("section_number").alias("number")], _seq(), {"chapter": c("chapter"), "part": c("part"), "replaced_by": c("replaced_by_section")}, {"is_in_force": c("is_in_force")})


def kg_judgments(spark, sf):
    c = lambda n: F.col(f"judgment.{n}")
    return G.upsert_nodes(_judgment(spark, sf), ["cite"], _seq(), {"citation": c("case_citation"), "date_decided": c("date_decided"), "case_type": c("case_type"), "petitioner": c("parties_petitioner")}, {"court": c("court"), "court_level": c("court_level").cast("bigint"), "overruled": c("is_overruled")})


def kg_judges(spark, sf):
    j = _judgment(spark, sf).select(F.explode("judgment.judge_names").alias("name"), F.col("judgment.court").alias("court"))
    return j.groupBy("name").agg(F.array_join(F.array_sort(F.collect_set("court")), "|").alias("courts"))


def _all_edges(spark, sf):
    """(from_label, from_key, kind, to_label, to_key) of every chunk, in one pass."""
    c = load(spark, sf, "chunks")
    act, number = act_key(F.col("statute.act_name")), F.col("statute.section_number")
    c = c.select(
        "id", "chunk_type", "statute", "judgment", "content", act.alias("act"), F.concat(act, F.lit("|"), number).alias("sec"), citation_key(F.col("judgment.case_citation")).alias("cite"),
        F.concat_ws(":", F.concat(act, F.lit(":"), number), F.substring(F.sha2("text", 256), 1, 8)).alias("version"), F.col("text").isNotNull().alias("has_text"))
    # a reference that names no act means the statute's own, or the only act that a judgment cites
    own = F.coalesce(F.col("act"), F.when(F.size("content.acts_cited") == 1, act_key(F.col("content.acts_cited")[0])))
    long = F.create_map(*[F.lit(x) for kv in L.REF_ABBREVIATIONS.items() for x in kv])

    def e(from_label, from_key, kind, to_label, to_key):
        k = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(F.lit(from_label).alias("from_label"), from_key.alias("from_key"), k.alias("kind"), F.lit(to_label).alias("to_label"), to_key.alias("to_key"))

    def target(r):
        named = F.nullif(F.regexp_replace(F.trim(F.regexp_extract(r, L.REFERENCE, 2)), "[.]+$", ""), F.lit(""))
        return F.concat(F.coalesce(act_key(F.coalesce(F.try_element_at(long, named), named)), own), F.lit("|"), F.nullif(F.regexp_extract(r, L.REFERENCE, 1), F.lit("")))

    def amended(a):
        nature = F.lower(F.coalesce(a["nature"], F.lit("")))
        kind = F.when(F.contains(nature, F.lit("insert")), "INSERTS").when(nature.rlike("omis|omit|repeal"), "OMITS").otherwise("AMENDS")
        return e("amendment", F.concat_ws("|", plain_key(a["amending_act"]), a["date"].cast("string"), nature), kind, "section", F.when(a["amending_act"].isNotNull(), F.col("sec")))

    j, cite, sec = (lambda n: F.col(f"judgment.{n}")), F.col("cite"), F.col("sec")
    parts = [
        F.array(
            e("act", F.col("act"), "CONTAINS", "section", sec), e("section", sec, "HAS_VERSION", "version", F.when(F.col("has_text") & sec.isNotNull(), F.col("version"))),
            e("act", act_key(F.col("statute.repealed_by")), "REPEALS", "act", F.col("act")), e("act", F.when(F.col("statute.replaced_by_section").isNotNull(), act_key(F.col("statute.repealed_by"))), "REPLACES", "act", F.col("act")),
            e("judgment", cite, "FILED_IN", "court", j("court")), e("judgment", citation_key(j("overruled_by")), "OVERRULES", "judgment", cite),
        ),
        F.transform("statute.amendment_history", amended),
        F.transform("content.sections_cited", lambda r: e("section", sec, "REFERENCES", "section", F.when(target(r) != sec, target(r)))),
        F.transform("content.sections_cited", lambda r: e("judgment", cite, "CITES_SECTION", "section", target(r))),
        F.transform("content.sections_cited", lambda r: e("judgment", cite, "INTERPRETS", "section", target(r))),
        F.transform(F.when(F.col("chunk_type") == "definition", F.col("content.legal_concepts")), lambda x: e("section", sec, "DEFINES", "concept", F.lower(x))),
        F.transform(j("judge_names"), lambda x: e("judgment", cite, "DECIDED_BY", "judge", x)),
        F.transform("content.cases_cited", lambda x: e("judgment", cite, "CITES_CASE", "judgment", F.when(citation_key(x) != cite, citation_key(x)))),
        F.transform(j("followed_in"), lambda x: e("judgment", citation_key(x), "FOLLOWS", "judgment", cite)),
        F.transform(j("distinguished_in"), lambda x: e("judgment", citation_key(x), "DISTINGUISHES", "judgment", cite)),
    ]
    none = F.array().cast("array<struct<from_label:string,from_key:string,kind:string,to_label:string,to_key:string>>")
    found = c.select(F.explode(F.concat(*[F.coalesce(p, none) for p in parts])).alias("e"))
    return found.select("e.*").where("from_key is not null and to_key is not null").distinct()


def edges_of(spark, sf, *kinds):
    e = _all_edges(spark, sf)
    return e.where(F.col("kind").isin(*kinds)) if kinds else e


def _nodes(spark, sf, edges=None):
    """(label, key) of all eight labels, those of edges' own ends (versions,
    amendments, concepts) included; courts also from the list."""
    e = _all_edges(spark, sf) if edges is None else edges
    a = kg_acts(spark, sf).select(F.lit("act").alias("label"), F.col("act").alias("key"))
    s = kg_sections(spark, sf).select(F.lit("section").alias("label"), F.concat_ws("|", "act", "number").alias("key"))
    j = kg_judgments(spark, sf).select(F.lit("judgment").alias("label"), F.col("cite").alias("key"))
    c = load(spark, sf, "court_list").select(F.lit("court").alias("label"), F.col("name").alias("key"))
    g = kg_judges(spark, sf).select(F.lit("judge").alias("label"), F.col("name").alias("key"))
    v = e.where("to_label in ('version', 'concept', 'court')").select(F.col("to_label").alias("label"), F.col("to_key").alias("key"))
    m = e.where("from_label = 'amendment'").select(F.col("from_label").alias("label"), F.col("from_key").alias("key"))
    return a.unionByName(s).unionByName(j).unionByName(c).unionByName(g).unionByName(v).unionByName(m)


def kg_edges(spark, sf):
    return edges_of(spark, sf)


def edges_resolved(spark, sf):
    """Of each kind of edge how many there are and how many have both ends."""
    e = cut(edges_of(spark, sf))
    whole = G.resolve_edges(e, _nodes(spark, sf, e)).groupBy("kind").agg(F.count(F.lit(1)).alias("resolved"))
    return e.groupBy("kind").agg(F.count(F.lit(1)).alias("edges")).join(whole, "kind", "left").select("kind", "edges", F.coalesce("resolved", F.lit(0)).alias("resolved"))


def citation_traversal(spark, sf):
    """Judgments that cite or interpret each section (latest first in ``place``); one
    that does both appears once for each."""
    e = edges_of(spark, sf, "CITES_SECTION", "INTERPRETS").select("kind", F.col("to_key").alias("section"), F.col("from_key").alias("cite"))
    e = G.ends(e, kg_sections(spark, sf).select(F.concat_ws("|", "act", "number").alias("section")), "section")
    j = kg_judgments(spark, sf).select("cite", "citation", "court", "date_decided")
    w = W.partitionBy("section", "kind").orderBy(F.desc_nulls_last("date_decided"), "cite")
    out = e.join(j, "cite").withColumn("place", F.row_number().over(w).cast("bigint"))
    return out.select("section", "kind", "citation", "court", F.date_format("date_decided", "yyyy-MM-dd").alias("day"), "place")


def hierarchy_navigation(spark, sf):
    """Sections under each act and chapter, numbers in text order."""
    s = kg_sections(spark, sf)
    return s.groupBy("act", F.coalesce("chapter", F.lit("-")).alias("chapter")).agg(F.array_join(F.array_sort(F.collect_list("number")), ",").alias("sections"))


def _versions(spark, sf):
    return load(spark, sf, "section_versions").select("version_id", "act_id", "section_number", "effective_from", "effective_until").distinct()


def point_in_time(spark, sf):
    """The version in force at three dates, for every section."""
    v = _versions(spark, sf)
    p = v.select("act_id", "section_number").distinct().withColumn("day", F.explode(F.array(*[F.lit(d).cast("date") for d in ("1965-01-01", "1990-06-30", "2024-07-01")])))
    out = G.version_at(v, p, ["act_id", "section_number"], "day", "effective_from", "effective_until", "version_id")
    return out.select("act_id", "section_number", F.date_format("day", "yyyy-MM-dd").alias("day"), "version_id")


def amendment_cascade(spark, sf):
    """What each amending act touched, by kind of edge."""
    e = edges_of(spark, sf, "AMENDS", "INSERTS", "OMITS").select(F.substring_index("from_key", "|", 1).alias("act"), "kind", "to_key").distinct()
    return e.groupBy("act", "kind").agg(F.count(F.lit(1)).alias("sections"), F.array_join(F.array_sort(F.collect_set("to_key")), ";").alias("keys"))


def temporal_status(spark, sf):
    """Force of each section, status of its act, and its amending acts."""
    s, a = kg_sections(spark, sf), kg_acts(spark, sf)
    am = edges_of(spark, sf, "AMENDS", "INSERTS", "OMITS").groupBy("to_key").agg(F.array_join(F.array_sort(F.collect_set(F.substring_index("from_key", "|", 1))), ";").alias("amendments"))
    j = s.withColumn("to_key", F.concat("act", F.lit("|"), "number")).join(a.select("act", "status"), "act", "left").join(am, "to_key", "left")
    return j.select("act", "number", "is_in_force", "status", F.coalesce("amendments", F.lit("")).alias("amendments"))


def judgment_relationships(spark, sf):
    n = G.neighbours(edges_of(spark, sf), "judgment")
    return n.select("key", "relation", F.array_join("others", ";").alias("others"))


def find_replacement(spark, sf):
    """By the REPLACES edges: what replaces each section of a replaced act."""
    r = edges_of(spark, sf, "REPLACES").select(F.col("to_key").alias("act"), F.col("from_key").alias("by_act"))
    return r.join(kg_sections(spark, sf), "act", "left").select("act", "number", "by_act", F.col("replaced_by").alias("by_section"))


def node_exists(spark, sf):
    """Cited sections and cases that are nodes, and that aren't."""
    c = edges_of(spark, sf, "CITES_CASE", "CITES_SECTION", "REFERENCES").select(F.col("to_label").alias("label"), F.col("to_key").alias("key")).distinct()
    n = _nodes(spark, sf).where("label in ('judgment', 'section')").distinct().withColumn("known", F.lit(True))
    return c.join(n, ["label", "key"], "left").select("label", "key", F.coalesce("known", F.lit(False)).alias("known"))


def integrity_missing_version(spark, sf):
    """Sections without any version."""
    v = edges_of(spark, sf, "HAS_VERSION").select(F.col("from_key").alias("key"))
    s = kg_sections(spark, sf).select("act", "number", F.concat_ws("|", "act", "number").alias("key"))
    return s.join(v, "key", "left_anti").select("act", "number")


def integrity_repealed(spark, sf):
    """Sections in force under an act whose status is repealed."""
    return kg_sections(spark, sf).where("is_in_force").join(kg_acts(spark, sf).where("status = 'repealed'").select("act"), "act").select("act", "number")


def integrity_hierarchy(spark, sf):
    return G.lower_overrules(edges_of(spark, sf, "OVERRULES"), kg_judgments(spark, sf).select(F.col("cite").alias("key"), "court_level"))


def integrity_overlap(spark, sf):
    return G.overlaps(_versions(spark, sf), ["act_id", "section_number"], "version_id", "effective_from", "effective_until")


def recursive_hops(spark, sf):
    """How many sections lie within three references of each section."""
    e = edges_of(spark, sf, "REFERENCES").select(F.col("from_key").alias("src"), F.col("to_key").alias("dst"))
    start = e.select(F.col("src").alias("node")).distinct()
    return G.hops(e, start, 3).groupBy("origin").agg(F.count(F.lit(1)).alias("reached"), F.max("distance").cast("bigint").alias("far"))


def kg_run_counts(spark, sf):
    return _nodes(spark, sf).groupBy("label").agg(F.countDistinct("key").alias("nodes"))


SEQ = "struct_pack(t := ingestion.ingested_at, i := id) AS seq"
S = f"s AS (SELECT *, {SEQ}, {act_sql('statute.act_name')} AS act FROM chunks WHERE {act_sql('statute.act_name')} IS NOT NULL)"
J = f"j AS (SELECT *, {SEQ}, {citation_sql('judgment.case_citation')} AS cite FROM chunks WHERE {citation_sql('judgment.case_citation')} IS NOT NULL)"
ACTS = "acts_n AS (SELECT act, arg_max(statute.act_name, seq) AS name, arg_max(statute.act_number, seq) AS number, arg_max(statute.date_effective, seq) AS date_effective, arg_max(statute.date_repealed, seq) AS date_repealed, arg_max_null(statute.temporal_status, seq) AS status FROM s GROUP BY 1)"
SECS = "secs AS (SELECT act, statute.section_number AS number, arg_max(statute.chapter, seq) AS chapter, arg_max(statute.part, seq) AS part, arg_max(statute.replaced_by_section, seq) AS replaced_by, arg_max_null(statute.is_in_force, seq) AS is_in_force FROM s WHERE statute.section_number IS NOT NULL GROUP BY 1, 2)"
JUDS = "juds AS (SELECT cite, arg_max(judgment.case_citation, seq) AS citation, arg_max(judgment.date_decided, seq) AS date_decided, arg_max(judgment.case_type, seq) AS case_type, arg_max(judgment.parties_petitioner, seq) AS petitioner, arg_max_null(judgment.court, seq) AS court, arg_max_null(judgment.court_level, seq)::BIGINT AS court_level, arg_max_null(judgment.is_overruled, seq) AS overruled FROM j GROUP BY 1)"
LONG = "CASE named " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.REF_ABBREVIATIONS.items()) + " ELSE named END"
EDGES = f"""am AS (SELECT act || '|' || statute.section_number AS sec, unnest(statute.amendment_history) AS a FROM s),
ak AS (SELECT sec, concat_ws('|', {plain_sql('a.amending_act')}, a.date::VARCHAR, lower(coalesce(a.nature, ''))) AS k, CASE WHEN contains(lower(coalesce(a.nature, '')), 'insert') THEN 'INSERTS' WHEN regexp_matches(lower(coalesce(a.nature, '')), 'omis|omit|repeal') THEN 'OMITS' ELSE 'AMENDS' END AS kind FROM am WHERE a.amending_act IS NOT NULL),
r0 AS (SELECT {act_sql('statute.act_name')} AS act, {act_sql('statute.act_name')} || '|' || statute.section_number AS sec, {citation_sql('judgment.case_citation')} AS cite, CASE WHEN len(content.acts_cited) = 1 THEN content.acts_cited[1] END AS sole, unnest(content.sections_cited) AS r FROM chunks),
r1 AS (SELECT *, nullif(regexp_replace(trim(regexp_extract(r, '{L.REFERENCE}', 2)), '[.]+$', ''), '') AS named, nullif(regexp_extract(r, '{L.REFERENCE}', 1), '') AS n FROM r0),
rf AS (SELECT sec, cite, coalesce({act_sql('(' + LONG + ')')}, act, {act_sql('sole')}) || '|' || n AS t FROM r1),
e0 AS (SELECT 'act' AS from_label, act AS from_key, 'CONTAINS' AS kind, 'section' AS to_label, act || '|' || statute.section_number AS to_key FROM s
UNION SELECT 'section', act || '|' || statute.section_number, 'HAS_VERSION', 'version', act || ':' || statute.section_number || ':' || substr(sha256(text), 1, 8) FROM s
UNION SELECT 'amendment', k, kind, 'section', sec FROM ak
UNION SELECT 'act', {act_sql('statute.repealed_by')}, 'REPEALS', 'act', act FROM s
UNION SELECT 'act', {act_sql('statute.repealed_by')}, 'REPLACES', 'act', act FROM s WHERE statute.replaced_by_section IS NOT NULL
UNION SELECT 'section', sec, 'REFERENCES', 'section', t FROM rf WHERE sec <> t
UNION SELECT 'judgment', cite, 'CITES_SECTION', 'section', t FROM rf
UNION SELECT 'judgment', cite, 'INTERPRETS', 'section', t FROM rf
UNION SELECT 'section', act || '|' || statute.section_number, 'DEFINES', 'concept', lower(unnest(content.legal_concepts)) FROM s WHERE chunk_type = 'definition'
UNION SELECT 'judgment', cite, 'FILED_IN', 'court', judgment.court FROM j
UNION SELECT 'judgment', cite, 'DECIDED_BY', 'judge', unnest(judgment.judge_names) FROM j
UNION SELECT * FROM (SELECT 'judgment', cite AS c, 'CITES_CASE', 'judgment', {citation_sql('x')} AS n FROM (SELECT cite, unnest(content.cases_cited) AS x FROM j)) WHERE c <> n
UNION SELECT 'judgment', {citation_sql('x')}, 'FOLLOWS', 'judgment', cite FROM (SELECT cite, unnest(judgment.followed_in) AS x FROM j)
UNION SELECT 'judgment', {citation_sql('x')}, 'DISTINGUISHES', 'judgment', cite FROM (SELECT cite, unnest(judgment.distinguished_in) AS x FROM j)
UNION SELECT 'judgment', {citation_sql('judgment.overruled_by')}, 'OVERRULES', 'judgment', cite FROM j),
e AS (SELECT DISTINCT * FROM e0 WHERE from_key IS NOT NULL AND to_key IS NOT NULL)"""
V = "v AS (SELECT DISTINCT version_id, act_id, section_number, effective_from, effective_until FROM section_versions)"
NODES = """nodes AS (SELECT 'act' AS label, act AS key FROM acts_n UNION SELECT 'section', act || '|' || number FROM secs UNION SELECT 'judgment', cite FROM juds UNION SELECT 'court', name FROM court_list
UNION SELECT 'judge', unnest(judgment.judge_names) FROM j UNION SELECT to_label, to_key FROM e WHERE to_label IN ('version', 'concept', 'court') UNION SELECT from_label, from_key FROM e WHERE from_label = 'amendment')"""
ALL = "WITH " + ", ".join([S, J, ACTS, SECS, JUDS, EDGES])

QUERIES = {
    "kg_acts": (kg_acts, f"WITH {S}, {ACTS} SELECT * FROM acts_n"),
    "kg_sections": (kg_sections, f"WITH {S}, {SECS} SELECT * FROM secs"),
    "kg_judgments": (kg_judgments, f"WITH {J}, {JUDS} SELECT * FROM juds"),
    "kg_judges": (kg_judges, f"WITH {J}, x AS (SELECT unnest(judgment.judge_names) AS name, judgment.court AS court FROM j) SELECT name, coalesce(string_agg(DISTINCT court, '|' ORDER BY court), '') AS courts FROM x GROUP BY 1"),
    "kg_edges": (kg_edges, f"{ALL} SELECT * FROM e"),
    "edges_resolved": (edges_resolved, f"{ALL}, {NODES} SELECT kind, count(*) AS edges, count(*) FILTER ((from_label, from_key) IN (SELECT (label, key) FROM nodes) AND (to_label, to_key) IN (SELECT (label, key) FROM nodes)) AS resolved FROM e GROUP BY 1"),
    "citation_traversal": (citation_traversal, f"""{ALL}, k AS (SELECT act || '|' || number AS section FROM secs)
SELECT section, kind, citation, court, strftime(date_decided, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY section, kind ORDER BY date_decided DESC NULLS LAST, cite) AS place FROM e JOIN k ON section = to_key JOIN juds ON cite = from_key WHERE kind IN ('CITES_SECTION', 'INTERPRETS')"""),
    "hierarchy_navigation": (hierarchy_navigation, f"WITH {S}, {SECS} SELECT act, coalesce(chapter, '-') AS chapter, string_agg(number, ',' ORDER BY number) AS sections FROM secs GROUP BY 1, 2"),
    "point_in_time": (point_in_time, f"""WITH {V}, d AS (SELECT unnest([DATE '1965-01-01', DATE '1990-06-30', DATE '2024-07-01']) AS day),
r AS (SELECT act_id, section_number, day, version_id, row_number() OVER (PARTITION BY act_id, section_number, day ORDER BY effective_from DESC, version_id DESC) AS n FROM v, d WHERE effective_from <= day AND (effective_until IS NULL OR effective_until > day))
SELECT act_id, section_number, strftime(day, '%Y-%m-%d') AS day, version_id FROM r WHERE n = 1"""),
    "amendment_cascade": (amendment_cascade, f"{ALL}, a AS (SELECT DISTINCT split_part(from_key, '|', 1) AS act, kind, to_key FROM e WHERE kind IN ('AMENDS', 'INSERTS', 'OMITS')) SELECT act, kind, count(*) AS sections, string_agg(to_key, ';' ORDER BY to_key) AS keys FROM a GROUP BY 1, 2"),
    "temporal_status": (temporal_status, f"{ALL}, a AS (SELECT to_key, string_agg(DISTINCT split_part(from_key, '|', 1), ';' ORDER BY split_part(from_key, '|', 1)) AS amendments FROM e WHERE kind IN ('AMENDS', 'INSERTS', 'OMITS') GROUP BY 1) SELECT act, secs.number, is_in_force, status, coalesce(amendments, '') AS amendments FROM secs LEFT JOIN acts_n USING (act) LEFT JOIN a ON to_key = act || '|' || secs.number"),
    "judgment_relationships": (judgment_relationships, f"{ALL}, n AS (SELECT from_key AS key, 'out:' || kind AS relation, to_key AS other FROM e WHERE from_label = 'judgment' UNION SELECT to_key, 'in:' || kind, from_key FROM e WHERE to_label = 'judgment') SELECT key, relation, string_agg(other, ';' ORDER BY other) AS others FROM n GROUP BY 1, 2"),
    "find_replacement": (find_replacement, f"{ALL} SELECT e.to_key AS act, secs.number, e.from_key AS by_act, replaced_by AS by_section FROM e LEFT JOIN secs ON secs.act = e.to_key WHERE kind = 'REPLACES'"),
    "node_exists": (node_exists, f"{ALL}, {NODES}, c AS (SELECT DISTINCT to_label AS label, to_key AS key FROM e WHERE kind IN ('CITES_CASE', 'CITES_SECTION', 'REFERENCES')) SELECT label, key, (label, key) IN (SELECT (label, key) FROM nodes) AS known FROM c"),
    "integrity_missing_version": (integrity_missing_version, f"{ALL} SELECT act, number FROM secs WHERE act || '|' || number NOT IN (SELECT from_key FROM e WHERE kind = 'HAS_VERSION')"),
    "integrity_repealed": (integrity_repealed, f"WITH {S}, {ACTS}, {SECS} SELECT act, secs.number FROM secs JOIN acts_n USING (act) WHERE is_in_force AND status = 'repealed'"),
    "integrity_hierarchy": (integrity_hierarchy, f"{ALL} SELECT from_key AS overruler, to_key AS overruled FROM e JOIN juds a ON a.cite = from_key JOIN juds b ON b.cite = to_key WHERE kind = 'OVERRULES' AND a.court_level > b.court_level"),
    "integrity_overlap": (integrity_overlap, f"""WITH {V}, f AS (SELECT *, coalesce(effective_until, DATE '9999-12-31') AS far FROM v WHERE effective_from IS NOT NULL), g AS (SELECT * FROM f WHERE far > effective_from),
b AS (SELECT *, max(far) OVER (PARTITION BY act_id, section_number ORDER BY effective_from, version_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g)
SELECT act_id, section_number, version_id, date_diff('day', effective_from, least(before, far)) AS days FROM b WHERE before > effective_from"""),
    "recursive_hops": (recursive_hops, ALL.replace("WITH ", "WITH RECURSIVE ", 1) + """, r AS (SELECT DISTINCT from_key AS src, to_key AS dst FROM e WHERE kind = 'REFERENCES'),
h AS (SELECT DISTINCT src AS origin, src AS node, 0 AS d FROM r UNION SELECT h.origin, r.dst, h.d + 1 FROM h JOIN r ON r.src = h.node WHERE h.d < 3),
m AS (SELECT origin, node, min(d) AS d FROM h GROUP BY 1, 2) SELECT origin, count(*) AS reached, max(d)::BIGINT AS far FROM m GROUP BY 1"""),
    "kg_run_counts": (kg_run_counts, f"{ALL}, {NODES} SELECT label, count(DISTINCT key) AS nodes FROM nodes GROUP BY 1"),
}
