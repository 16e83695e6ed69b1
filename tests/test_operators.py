import json

import pytest
from pyspark.sql import functions as F

from lexgrain.functions import legal as L
from lexgrain.functions.text import any_date, last_segment
from lexgrain.functions.vector import cosine, head
from lexgrain.operators import corpus as K
from lexgrain.operators import graph as G
from lexgrain.operators import providers as P
from lexgrain.operators import retrieval as R
from lexgrain.operators import verification as V
from lexgrain.sources import pages, registry, tables
from lexgrain.streaming import events as E


def test_rank_fusion_by_hand(spark):
    hits = spark.createDataFrame([(1, "dense", "c1", 0.9, 1), (1, "dense", "c2", 0.8, 2), (1, "bm25", "c2", 5.0, 1), (1, "bm25", "c3", 4.0, 2)], "query int, channel string, id string, score double, rank int")
    got = {r["id"]: (r["score"], r["channels"], r["source"], r["rank"]) for r in R.rank_fusion(hits).collect()}
    assert got["c2"] == (round(1 / 62 + 1 / 61, 9), ["bm25", "dense"], "bm25", 1)
    assert got["c1"][0] == round(1 / 61, 9) and got["c3"][0] == round(1 / 62, 9)
    assert R.rank_fusion(hits, limit=0).count() == 0


def test_fusion_counts_repeats_within_a_channel(spark):
    hits = spark.createDataFrame([(1, "q", "c", 1.0, 1), (1, "q", "c", 0.5, 2)], "query int, channel string, id string, score double, rank int")
    r = R.rank_fusion(hits).first()
    assert r["channels"] == ["q", "q"] and r["score"] == round(1 / 61 + 1 / 62, 9)


@pytest.mark.parametrize("common", [0.0, 0.05, 0.4, 2.0])
def test_bm25_is_exact_whatever_counts_as_common(spark, common):
    docs = spark.createDataFrame([(i, " ".join(["the law of"] * (1 + i % 3) + [w for w in ("levy", "bail", "rent", "fee") if (i * 7 + len(w)) % 3 == 0])) for i in range(60)] + [(99, None), (98, "")], "id int, text string")
    q = spark.createDataFrame([(1, "the levy"), (2, "of the law"), (3, "bail rent fee of"), (4, ""), (5, None)], "q int, t string")
    base = R.bm25_search(docs, "id", "text", q, "q", "t", 7, common=2.0).orderBy("query", "rank").collect()
    assert R.bm25_search(docs, "id", "text", q, "q", "t", 7, common=common).orderBy("query", "rank").collect() == base
    assert {r["query"] for r in base} == {1, 2, 3}


def test_budget_latch(spark):
    rows = [(1, "a", 1, 10, 5), (1, "b", 2, 10, 0), (1, "c", 3, 10, 50), (1, "d", 4, 10, 1)]
    df = spark.createDataFrame(rows, "query int, id string, rank int, own int, extra int")
    got = [(r["id"], r["keep"], r["running"]) for r in R.expand_within_budget(df, 60).orderBy("rank").collect()]
    assert got == [("a", True, 15), ("b", False, 25), ("c", False, 35), ("d", False, 45)]


def test_cache(spark):
    c = spark.createDataFrame([("k1", [1.0, 0.0], "r", "2025-01-01 00:00:00", 86400, ["A"]), ("k2", [1.0, 0.0], None, "2025-01-01 00:00:00", 86400, ["B"]), ("k0", [1.0, 0.0], "old", "2024-01-01 00:00:00", 86400, None)], "key string, v array<double>, response string, at string, ttl_seconds int, acts_cited array<string>").withColumn("cached_at", F.to_timestamp("at"))
    q = spark.createDataFrame([(1, [1.0, 0.05]), (2, [0.0, 1.0])], "query int, v array<double>")
    assert [(r["query"], r["key"]) for r in R.cache_lookup(q, c, 0.92, "2025-01-01 12:00:00").collect()] == [(1, "k1")]
    assert {r["key"] for r in R.cache_invalidate(c, "A").collect()} == {"k2", "k0"}


def test_zero_vectors(spark):
    r = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>").select(cosine(F.col("a"), F.col("b")).alias("c"), head(F.col("a"), 1).alias("h")).first()
    assert r["c"] == 0.0 and r["h"] == [0.0]


@pytest.mark.parametrize(("text", "want"), [
    ("What is Section 420 of the Indian Penal Code?", "simple"), ("Compare bail and levy", "analytical"), ("bail in light of rent law", "complex"),
    ("IPC and CrPC on bail", "complex"), ("Supreme Court and High Court views", "complex"), ("limitation for levy", "standard"), ("", "standard"), (None, "standard"),
])
def test_routes(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(L.route(F.col("t"))["route"]).first()[0] == want


def test_section_references_drop_punctuation(spark):
    r = spark.createDataFrame([("What is Section 420 of IPC?",)], "t string").select(L.section_references(F.col("t")).alias("r")).first()["r"]
    assert [(x["section"], x["act"]) for x in r] == [("420", "Indian Penal Code")]


def test_dates_and_urls(spark):
    r = spark.createDataFrame([("2001-02-03", "https://a/b/"), ("3 May 2001", "https://a/doc/12"), ("31/31/2001", None)], "d string, u string").select(any_date(F.col("d")).cast("string").alias("d"), last_segment(F.col("u")).alias("u")).collect()
    assert [(x["d"], x["u"]) for x in r] == [("2001-02-03", "b"), ("2001-05-03", "12"), (None, None)]


def test_change_detection_modes(spark):
    a = spark.createDataFrame([("u1", "h1"), ("u2", "h2"), ("u3", None)], "url string, h string")
    s = spark.createDataFrame([("u1", "h1"), ("u2", "old"), ("u3", None)], "url string, h string")
    assert [(r["url"], r["reason"]) for r in K.changed(a, s, "url", "h").collect()] == [("u2", "changed")]
    assert K.changed(a, s, "url", "h", full=True).count() == 3
    assert {tuple(r) for r in K.upsert_state(s, a.where("url = 'u2'"), "url", ["url", "h"]).collect()} == {("u1", "h1"), ("u2", "h2"), ("u3", None)}


def test_packing_keeps_all_paragraphs(spark):
    t = "aa\nbbb\n\n" + "c" * 30 + "\nd"
    got = spark.createDataFrame([(t,)], "t string").select(K.pack_paragraphs(F.col("t"), 10).alias("p")).first()["p"]
    assert got == ["aa\nbbb", "c" * 30, "d"]


def test_upsert_and_edges(spark):
    rows = spark.createDataFrame([("a", 1, "x", "s1"), ("a", 2, None, None), ("b", 1, None, "s")], "k string, at int, keep string, over string")
    got = {r["k"]: (r["keep"], r["over"]) for r in G.upsert_nodes(rows, ["k"], F.col("at"), {"keep": F.col("keep")}, {"over": F.col("over")}).collect()}
    assert got == {"a": ("x", None), "b": (None, "s")}
    e = spark.createDataFrame([("n", "a", "T", "n", "b"), ("n", "a", "T", "n", "zz")], "from_label string, from_key string, kind string, to_label string, to_key string")
    n = spark.createDataFrame([("n", "a"), ("n", "b")], "label string, key string")
    assert [r["to_key"] for r in G.resolve_edges(e, n).collect()] == ["b"]


def test_version_at(spark):
    v = spark.sql("select * from values (1, 'v1', date'2000-01-01', date'2005-01-01'), (1, 'v2', date'2005-01-01', null), (1, 'v0', null, date'2009-01-01') as t(k, id, s, e)")
    p = spark.sql("select * from values (1, date'2004-12-31'), (1, date'2005-01-01'), (1, date'1999-01-01') as t(k, d)")
    assert {(str(r["d"]), r["id"]) for r in G.version_at(v, p, ["k"], "d", "s", "e", "id").collect()} == {("2004-12-31", "v1"), ("2005-01-01", "v2")}


def test_citation_spans(spark):
    df = spark.createDataFrame([(1, "AIR 2023 SC 1234, (2023) 5 SCC 678; Section 5 and RBI/2023-24/45"), (2, None), (3, "")], "id int, t string")
    got = [(r["family"], r["citation"]) for r in V.citation_spans(df, "id", "t").orderBy("start").collect()]
    assert got == [("air", "AIR 2023 SC 1234"), ("scc", "(2023) 5 SCC 678"), ("section", "Section 5"), ("circular", "RBI/2023-24/45")]


def test_report_lines():
    t = V.report({"recall": 0.95, "other": 0.1}, {"recall": 0.9})
    assert "PASS" in t and t.count("\n") == 2


def test_registry(spark, tmp_path):
    f = tmp_path / "s.yaml"
    f.write_text("sources:\n- {name: One, source_type: court, requests_per_second: 2}\n- {name: two, source_type: statute, enabled: false}\n")
    r = registry.load_registry(spark, str(f))
    assert r.count() == 2 and registry.select_sources(r, name=" one ").count() == 1 and registry.select_sources(r, source_type="statute").count() == 0
    f.write_text("sources: 5")
    with pytest.raises(registry.RegistryError):
        registry.load_registry(spark, str(f))
    with pytest.raises(registry.RegistryError):
        registry.load_registry(spark, str(tmp_path / "none.yaml"))


def test_replay_and_parsing(spark, tmp_path):
    (tmp_path / "a.html").write_text("<title>T</title><nav>x</nav><p>One<br>two<script>z</script><a href='/doc/1/'>d</a><a href='/doc/1'>e</a><a href='/x.pdf'>हिन्दी</a><a href='/y.pdf'>Text</a><table><tr><th>d</th></tr><tr><td>1 May</td><td>5</td><td>An Act</td><td>v</td></table>")
    spark.dataSource.register(pages.ReplaySource)
    raw = spark.read.format("replay").option("path", str(tmp_path)).load()
    p = pages.parse_pages(raw, "name", "html").cache()
    r = p.first()
    assert r["title"] == "T" and "One\ntwo" in r["text"] and "z" not in r["text"].split()
    assert [x["url"] for x in pages.listing_links(p, "^/doc/", 5).collect()] == ["/doc/1"]
    assert [tuple(x)[1:] for x in pages.browse_rows(p).collect()] == [("1 May", "5", "An Act")]
    assert p.select(pages.pdf_link(F.col("links"))).first()[0] == "/y.pdf"


def _get(url):
    if "bad" in url:
        raise TimeoutError("slow")
    return (429, "") if "busy" in url else (200, "body of " + url)


def test_fetch(spark):
    u = spark.createDataFrame([("https://h/1",), ("https://h/1",), ("https://h/busy",), ("https://g/bad",), (None,)], "url string")
    got = {r["url"]: (r["status"], r["error"], r["body"]) for r in pages.fetch(u, _get, rate=1000, wait=0.001).collect()}
    assert got["https://h/1"][2] == "body of https://h/1" and got["https://h/busy"][1] == "status 429" and got["https://g/bad"][1].startswith("TimeoutError")
    with pytest.raises(ValueError):
        pages.fetch(u, _get, rate=0)


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("court", "a", 1), ("statute", "b", 2)], "source_type string, id string, n int")
    tables.write_raw(df, str(tmp_path / "raw"))
    assert tables.read_raw(spark, str(tmp_path / "raw"), "court").count() == 1
    p = str(tmp_path / "t")
    tables.upsert(spark, p, df, "id")
    tables.upsert(spark, p, df.where("id = 'b'").withColumn("n", F.lit(9)), "id")
    assert {(r["id"], r["n"]) for r in tables.latest_version(spark, p).collect()} == {("a", 1), ("b", 9)}
    tables.compact(spark, p, "id")
    assert {(r["id"], r["n"]) for r in tables.latest_version(spark, p).collect()} == {("a", 1), ("b", 9)} and len(tables._folders(spark, p)) == 1
    for body in (["one", {"text": "two"}, ""], {"queries": ["one", "two"]}):
        f = tmp_path / "q.json"
        f.write_text(json.dumps(body))
        assert [r["text"] for r in tables.read_queries(spark, str(f)).collect()] == ["one", "two"]


def test_scoresheets(spark, tmp_path):
    w = spark.createDataFrame([("q1", "t", "r")], "query_id string, query_text string, response_text string")
    tables.write_worksheets(w, str(tmp_path / "w"))
    assert "accuracy" in spark.read.json(str(tmp_path / "w")).columns
    (tmp_path / "s.json").write_text('{"query_id":"q1","accuracy":4,"completeness":5,"recency":3,"usefulness":2}\n{broken\n{"query_id":"q2","accuracy":9,"completeness":5,"recency":3,"usefulness":2}\n')
    ok, bad = tables.read_scoresheets(spark, str(tmp_path / "s.json"))
    assert [r["query_id"] for r in ok.collect()] == ["q1"] and {r["reason"] for r in bad.collect()} == {"not JSON", "accuracy outside 1..5"}


class Failing:
    def complete(self, prompt):
        raise RuntimeError("no")


def test_providers(spark):
    with pytest.raises(KeyError):
        P.provider("none")
    c = spark.createDataFrame([("a", "d", 0, "Bail is granted. Rent is due."), ("b", "d", 1, None)], "id string, document_id string, chunk_index int, text string")
    r = {x["id"]: x["contextualized"] for x in P.contexts(c, P.provider("template")).collect()}
    assert r["a"] == "Bail is granted.\n\nBail is granted. Rent is due." and r["b"] is None
    bad = {x["id"]: x for x in P.contexts(c, Failing).collect()}
    assert all(x["contextualized"] is None for x in bad.values()) and "no" in bad["a"]["error"] and bad["b"]["error"] is None  # nothing is asked for a chunk without text
    q = P.questions(c, P.provider("template"))
    assert q.where("id = 'a'").first()["question"] == "What is said about granted?"


def test_semantic_pieces_keep_limits():
    e = P.HashEmbedder()
    t = ("One two three. " * 30 + "\n\n") * 3 + "x" * 500
    parts = P.semantic_pieces(t, e, 200)
    assert parts and all(len(p) <= 200 for p in parts)
    assert sorted("".join(parts).replace("\n", "").replace(" ", "").replace(".", "")) == sorted(t.replace("\n", "").replace(" ", "").replace(".", ""))
    assert P.semantic_pieces("  ", e, 50) == []


def test_ingest_twice_adds_nothing(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int").write.parquet(src)
    for _ in range(2):
        E.ingest_new(spark, spark.readStream.schema("k string, n int").parquet(src), out, "k", state)
    spark.createDataFrame([("b", 3), ("c", 4)], "k string, n int").write.mode("append").parquet(src)
    E.ingest_new(spark, spark.readStream.schema("k string, n int").parquet(src), out, "k", state)
    assert {(r["k"], r["n"]) for r in spark.read.parquet(out).collect()} == {("a", 1), ("b", 2), ("c", 4)}
