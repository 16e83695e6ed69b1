import datetime as dt

import pytest
from pyspark.sql import functions as F

from lexgrain.functions.names import act_key, citation_key
from lexgrain.operators import evaluation as E
from lexgrain.operators import graph as G
from lexgrain.operators import verification as V
from lexgrain.plans import evaluation as PE
from lexgrain.plans import flows, graph


def test_keys(spark):
    names = ["The Salt (Procedure) Act, 1990", "SALT  ACT", "Salt Adhiniyam '90", "the", None]
    assert [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(act_key(F.col("n"))).collect()] == ["salt act"] * 3 + ["the", None]
    cites = ["(1994) 5 SCC 3295", "[1994] 5 S.C.C. 3295", "SCC 1994 Vol. 5 p. 3295", "AIR 2009 Amb 3795", "A.I.R. (2009) Ambhorka 3795", "1996 SCC OnLine Kes 7183", "unreported", None]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in cites], "n string").select(citation_key(F.col("n"))).collect()]
    assert got == ["scc||1994|5|3295"] * 3 + ["air|amb|2009|3795"] * 2 + ["scconline|kes|1996|7183", None, None]


@pytest.fixture(scope="module")
def small(spark, data, tmp_path_factory):
    """Three handmade chunks in the tables' own schema: two sections and a judgment."""
    d = tmp_path_factory.mktemp("graph")
    schema = spark.read.parquet(f"{data}/chunks.parquet").schema
    content = lambda **k: {"sections_cited": [], "acts_cited": [], "cases_cited": [], "legal_concepts": [], "language": "en", "has_hindi": False} | k
    at = {"ingested_at": dt.datetime(2024, 1, 1)}
    day = dt.date(2001, 5, 1)
    law = lambda **k: {"act_name": "The Salt (Procedure) Act, 1990", "is_in_force": True, "temporal_status": "in_force", "amendment_history": []} | k
    rows = [
        {"id": "s1", "text": "one", "chunk_type": "definition", "statute": law(section_number="1", amendment_history=[{"amending_act": "Salt (Amendment) Act", "date": day, "nature": "Inserted"}], repealed_by="Sea Act", replaced_by_section="9"), "content": content(sections_cited=["Section 2", "Section 1"], legal_concepts=["Levy"]), "ingestion": at},
        {"id": "s2", "text": None, "chunk_type": "statutory_text", "statute": law(section_number="2", is_in_force=False), "content": content(sections_cited=["Section 9 of the Sea Act"]), "ingestion": at},
        {"id": "s9", "text": "nine", "chunk_type": "statutory_text", "statute": law(act_name="SEA ACT 2000", section_number="9", temporal_status="repealed"), "content": content(), "ingestion": at},
        {"id": "j1", "text": "held", "chunk_type": "holding", "judgment": {"case_citation": "AIR 2009 Amb 3795", "court": "High Court", "court_level": 2, "date_decided": day, "judge_names": ["A"], "followed_in": ["(1994) 5 SCC 3295"], "distinguished_in": []}, "content": content(sections_cited=["Section 1", "Section 2, Salt Act"], acts_cited=["Salt Act"], cases_cited=["[1994] 5 S.C.C. 3295", "A.I.R. 2009 Amb 3795"]), "ingestion": at},
        {"id": "j2", "text": "said", "chunk_type": "order", "judgment": {"case_citation": "(1994) 5 SCC 3295", "court": "District Court", "court_level": 3, "overruled_by": None, "judge_names": [], "followed_in": [], "distinguished_in": ["AIR 2009 Amb 3795"]}, "content": content(), "ingestion": at},
        {"id": "j3", "text": "so", "chunk_type": "order", "judgment": {"case_citation": "1996 SCC OnLine Kes 7183", "court": "Supreme Court", "court_level": 1, "overruled_by": "S.C.C. 1994 (5) 3295", "judge_names": [], "followed_in": [], "distinguished_in": []}, "content": content(), "ingestion": at},
    ]
    spark.createDataFrame(rows, schema).write.parquet(f"{d}/chunks.parquet")
    spark.read.parquet(f"{data}/court_list.parquet").write.parquet(f"{d}/court_list.parquet")
    q = spark.read.parquet(f"{data}/queries.parquet")
    spark.createDataFrame([{"query_id": 7, "text": "What is section 1 of the Salt Act?"}, {"query_id": 8, "text": "What is section 9 of the Sea Act, 2000?"}], q.schema).write.parquet(f"{d}/queries.parquet")
    return str(d)


def test_edges_of_handmade_chunks(spark, small):
    got = {(r["from_key"], r["kind"], r["to_key"]) for r in graph.kg_edges(spark, small).collect()}
    assert got == {
        ("salt act", "CONTAINS", "salt act|1"), ("salt act", "CONTAINS", "salt act|2"), ("sea act", "CONTAINS", "sea act|9"), ("salt act|1", "HAS_VERSION", "salt act:1:7692c3ad"), ("sea act|9", "HAS_VERSION", "sea act:9:edcd8e70"),
        ("salt amendment act|2001-05-01|inserted", "INSERTS", "salt act|1"), ("sea act", "REPEALS", "salt act"), ("sea act", "REPLACES", "salt act"), ("salt act|1", "REFERENCES", "salt act|2"), ("salt act|2", "REFERENCES", "sea act|9"), ("salt act|1", "DEFINES", "levy"),
        ("air|amb|2009|3795", "FILED_IN", "High Court"), ("scc||1994|5|3295", "FILED_IN", "District Court"), ("scconline|kes|1996|7183", "FILED_IN", "Supreme Court"), ("air|amb|2009|3795", "DECIDED_BY", "A"),
        *[("air|amb|2009|3795", k, f"salt act|{n}") for k in ("CITES_SECTION", "INTERPRETS") for n in (1, 2)], ("air|amb|2009|3795", "CITES_CASE", "scc||1994|5|3295"), ("scc||1994|5|3295", "FOLLOWS", "air|amb|2009|3795"),
        ("air|amb|2009|3795", "DISTINGUISHES", "scc||1994|5|3295"), ("scc||1994|5|3295", "OVERRULES", "scconline|kes|1996|7183"),
    }
    assert all(r["edges"] == r["resolved"] for r in graph.edges_resolved(spark, small).collect())


def test_lookups_on_handmade_chunks(spark, small):
    assert [(r["overruler"], r["overruled"]) for r in graph.integrity_hierarchy(spark, small).collect()] == [("scc||1994|5|3295", "scconline|kes|1996|7183")]
    assert [(r["act"], r["number"]) for r in graph.integrity_missing_version(spark, small).collect()] == [("salt act", "2")]
    assert {(r["act"], r["number"], r["by_act"], r["by_section"]) for r in graph.find_replacement(spark, small).collect()} == {("salt act", "1", "sea act", "9"), ("salt act", "2", "sea act", None)}
    t = {(r["section"], r["kind"], r["citation"], r["place"]) for r in graph.citation_traversal(spark, small).collect()}
    assert t == {(f"salt act|{n}", k, "AIR 2009 Amb 3795", 1) for n in (1, 2) for k in ("CITES_SECTION", "INTERPRETS")}
    assert [(r["query_id"], r["id"], r["rank"]) for r in flows.graph_search(spark, small).orderBy("query_id", "rank").collect()] == [(7, "j1", 1), (7, "s1", 2), (7, "s2", 3), (8, "s9", 1)]


def test_lower_court_rule(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c")], "from_key string, to_key string")
    n = spark.createDataFrame([("a", 3), ("b", 1), ("c", 3)], "key string, court_level int")
    assert [tuple(r) for r in G.lower_overrules(e, n).collect()] == [("a", "b")]


def test_temporal_rules_in_order(spark):
    d = dt.date
    refs = spark.createDataFrame([("q", "1", "420", "indian penal code", d(2024, 7, 1)), ("q", "2", "420", "indian penal code", d(2024, 6, 30)), ("q", "3", "1", "salt act", d(2020, 1, 1)), ("q", "4", "2", "salt act", d(2020, 1, 1)), ("q", "5", "5", "fee act", d(2020, 1, 1)), ("q", "6", "6", "fee act", d(2020, 1, 1))], "source string, ref string, section string, act string, day date")
    sec = spark.createDataFrame([("salt act", "1", False, "9"), ("salt act", "2", True, None), ("fee act", "5", True, None)], "act string, number string, is_in_force boolean, replaced_by string")
    acts = spark.createDataFrame([("salt act", "in_force"), ("fee act", "repealed")], "act string, status string")
    rep = spark.createDataFrame([("sea act", "salt act"), ("new act", "salt act")], "from_key string, to_key string")
    got = {r["ref"]: (r["reason"], r["by_act"], r["by_section"]) for r in V.temporal_warnings(refs, sec, acts, rep).collect()}
    assert got == {"1": ("code repealed", "bharatiya nyaya sanhita", None), "3": ("not in force", "new act", "9"), "5": ("act repealed", None, None)}


def test_outcomes_of_citations(spark):
    c = spark.createDataFrame([("scc", "k1"), ("scc", "k2"), ("section", None), ("gazette", None), ("circular", "k1")], "family string, key string")
    known = spark.createDataFrame([("k1",), (None,), ("k1",)], "key string")
    assert sorted((r["family"], str(r["key"]), r["status"]) for r in V.verify_citations(c, known).collect()) == [("circular", "k1", "kg_unavailable"), ("gazette", "None", "kg_unavailable"), ("scc", "k1", "verified"), ("scc", "k2", "not_found"), ("section", "None", "not_found")]


def test_weights_and_specificity(spark):
    assert sum(V.WEIGHTS.values()) == pytest.approx(1)
    df = spark.createDataFrame([("simple", 3), ("simple", 4), ("analytical", 11), ("complex", 20), ("odd", 10), (None, 2)], "r string, n int")
    assert [round(r[0], 2) for r in df.select(V.specificity(F.col("r"), F.col("n"))).collect()] == [1.0, 0.9, 0.1, 0.3, 0.5, 0.7]


def test_metrics_by_hand(spark):
    i = PE._inputs(spark)
    c = {r["query_id"]: (r["cited"], r["held"]) for r in E.citation_accuracy(i).collect()}
    assert c["t01"] == (1, 1) and c["t02"] == (2, 1) and c["t04"] == (2, 2) and c["t05"] == (0, 0) and c["t06"] == (0, 0)
    t = {r["query_id"]: (r["references"], r["right"]) for r in E.temporal_accuracy(i).collect()}
    assert t["t01"] == (1, 0) and t["t02"] == (1, 1) and t["t03"] == (1, 1) and t["t08"] == (3, 0) and t["t05"] == (0, 0)
    s = {r["query_id"]: r["score"] for r in E.sections_retrieved(i, F.col("cross_reference")).collect()}
    assert s["t02"] == 0.0 and s["t04"] == 0.5 and s["t05"] == 1.0 and s["t06"] == 1.0 and s["t07"] == 0.5
    lat = {r["query_id"]: (r["route"], r["passed"]) for r in E.latency(i).collect()}
    assert lat["t02"] == ("standard", True) and lat["t03"] == ("standard", False) and lat["t04"] == ("analytical", True) and lat["t05"] == ("standard", True) and lat["t08"] == ("fast", True)
    q = E.query_ratios(i).first()
    assert q["cache_hit_rate"] == 2 / 8 and q["routing_accuracy"] == 4 / 7 and q["claim_rate"] == (1 + 3 + 1 + 0 + 1 + 3 + 5) / (1 + 4 + 1 + 2 + 1 + 3 + 5) and q["parent_use"] == 5 / 8 and q["further_rate"] == 3 / 8
    assert {r["metric"] for r in E.targets(E.means(i, PE.JUDGED)).collect()} == set(PE.JUDGED)
