import numpy as np
import pytest
from pyspark.sql import functions as F

from lexgrain.functions import register
from lexgrain.operators import dense, lexical
from lexgrain.operators import providers as P
from lexgrain.operators import retrieval as R
from lexgrain.plans import index
from lexgrain.sources import index as stored
from lexgrain.streaming import events as E


def test_nearest_by_blocks_is_brute_force(spark):
    r = np.random.default_rng(3)
    x = r.standard_normal((120, 8)).round(1)
    x[7] = x[9] = x[11]
    x[5] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    q = df.where("id < 13").select(F.col("id").alias("query"), F.col("v").alias("qv"))
    n = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, n, out=np.zeros_like(x), where=n > 0)
    c = np.round(u @ u.T, 6)
    want = {(i, int(j), k + 1) for i in range(13) for k, j in enumerate(np.lexsort((np.arange(120), -c[i]))[:6])}
    for rows, asked in ((1000, 1000), (17, 5)):
        assert {(a["query"], a["id"], a["rank"]) for a in dense.nearest(df, q, 6, block_rows=rows, query_block=asked).collect()} == want
    assert dense.nearest(df.limit(0), q, 3).count() == 0 and dense.nearest(df, q.limit(0), 3).count() == 0


def test_index_is_read_back(spark, tmp_path):
    docs = spark.createDataFrame([("a", "levy and bail", None, None, None), ("b", "bail", "levy levy fee", "a", None), ("c", None, None, None, "zz"), ("a", "levy and bail", None, None, None)], "id string, text string, contextualized_text string, parent_id string, header_id string")
    stored.write(docs, str(tmp_path), P.provider("hash"), P.provider("template"))
    terms, tables = stored.read(spark, str(tmp_path))
    assert {r["term"]: r["df"] for r in terms.terms().collect()} == {"levy": 2, "and": 1, "bail": 1, "fee": 1} and terms.stats()[:2] == (2, 3.0)
    q = spark.createDataFrame([(1, "levy"), (2, "fee"), (3, "none"), (4, None)], "q int, t string")
    assert {(r["query"], r["id"], r["rank"]) for r in lexical.search(terms, q, "q", "t", 5).collect()} == {(1, "b", 1), (1, "a", 2), (2, "b", 1)}
    assert {r["id"] for r in tables["vectors"].collect()} == {"a", "b"} and {len(r["fast"]) for r in tables["vectors"].collect()} == {16}
    assert [r["id"] for r in tables["parents"].collect()] == ["a"] and tables["questions"].select("id", "q").distinct().count() == tables["questions"].count()
    assert {r["id"] for r in stored.missing(docs, spark, str(tmp_path)).collect()} == {"c"}
    with pytest.raises(Exception, match="(?i)path"):
        stored.read(spark, str(tmp_path / "no"))[1]["vectors"].count()


def test_search_reads_only_buckets_of_its_terms(spark, data):
    i = index.text_index(spark, data)
    assert index.text_index(spark, data) is i  # built once for a state of the table
    plan = i.postings().where(F.col("bucket").isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_all_null_and_empty_texts(spark):
    d = spark.createDataFrame([("a", None), ("b", "")], "id string, text string")
    q = spark.createDataFrame([(1, "levy")], "q int, t string")
    assert R.bm25_search(d, "id", "text", q, "q", "t", 5).count() == 0


def test_sql_names_agree_with_columns(spark):
    register.register(spark)
    from lexgrain.functions.names import act_key

    df = spark.createDataFrame([("The Salt (Fees) Act, 1990",), ("x Adhiniyam",), (None,)], "x string")
    df.createOrReplaceTempView("names_t")
    assert [r[0] for r in spark.sql("SELECT lex_act_key(x) FROM names_t").collect()] == [r[0] for r in df.select(act_key(F.col("x"))).collect()]
    r = spark.sql("SELECT lex_tokens('A b-2'), lex_token_estimate('123456789'), lex_sigmoid('0'), lex_fenced_json('```json\n{\"a\": 1}\n```'), lex_fenced_json('{}')").first()
    assert list(r) == [["a", "b", "2"], 2, 0.5, '{"a": 1}', "{}"]
    got = spark.sql("SELECT c.* FROM VALUES ('See (1994) 5 SCC 32 and Section 4.'), (NULL) t(x), LATERAL lex_citations(x) c").collect()
    assert [(g["family"], g["citation"], g["start"]) for g in got] == [("scc", "(1994) 5 SCC 32", 4), ("section", "Section 4", 24)]


def test_cache_set_replaces_and_expires(spark):
    empty = spark.createDataFrame([], "key string, v array<double>, response string, cached_at timestamp, ttl_seconds int, acts_cited array<string>")
    new = spark.createDataFrame([("k", [1.0, 0.0], "r1", ["A"]), ("n", [0.0, 1.0], None, None)], "key string, v array<double>, response string, acts_cited array<string>")
    c = R.cache_set(empty, new, "2025-01-01 00:00:00")
    c = R.cache_set(c, new.withColumn("response", F.lit("r2")), "2025-01-01 06:00:00")
    assert {(r["key"], r["response"]) for r in c.collect()} == {("k", "r2"), ("n", "r2")}
    q = spark.createDataFrame([(1, [1.0, 0.01])], "query int, v array<double>")
    assert R.cache_lookup(q, c, 0.92, "2025-01-02 05:00:00").count() == 1 and R.cache_lookup(q, c, 0.92, "2025-01-02 06:00:00").count() == 0


def test_providers_by_component():
    assert P.for_component("judge", {"judge": "template"}) is P.REGISTRY["template"] and P.for_component("x", {"default": "hash"}) is P.REGISTRY["hash"]
    for component, config in (("x", {}), ("x", {"x": "none such"})):
        with pytest.raises(KeyError):
            P.for_component(component, config)


def test_low_confidence_alone_is_searched_again(spark):
    seg = spark.createDataFrame([(1, 0, "low", 0.2), (1, 1, "high", 0.9), (1, 2, "unknown", None), (2, 0, "edge", 0.5)], "query int, seg int, text string, confidence double")
    asked = []

    def search(q):
        asked.extend(r["text"] for r in q.collect())
        return q.select("query", F.explode(F.array(F.lit("old"), F.lit("new"))).alias("id"), F.lit(1).alias("rank"))

    have = spark.createDataFrame([(1, "old")], "query int, id string")
    assert [(r["query"], r["id"]) for r in P.flare(seg, search, have).collect()] == [(1, "new")] and asked == ["low"]


def test_changes_are_counted_in_order_of_time(spark, tmp_path):
    rows = [("a", "h2", 2), ("a", "h1", 1), ("a", "h1", 3), ("b", "h", 1), ("b", "h", 2)]
    spark.createDataFrame(rows, "k string, h string, t int").coalesce(1).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("k string, h string, t int").parquet(str(tmp_path / "in"))
    got = E.drain(E.content_changes(s, "k", "h", "t"), "update")
    assert {(r["key"], r["seen"], r["changes"]) for r in got.collect()} == {("a", 3, 2), ("b", 2, 0)}
