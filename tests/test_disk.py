"""What a query shuffles and stores stays within a share of the tables it reads."""

import os

import pytest
from pyspark.sql import functions as F

from lexgrain.operators import lexical
from lexgrain.operators import retrieval as R
from lexgrain.plans import catalog, index


@pytest.fixture(scope="module")
def larger(spark, data, tmp_path_factory):
    """The small chunks thirty times, with keys of their own; every query is asked."""
    d = tmp_path_factory.mktemp("larger")
    for t in os.listdir(data):
        if t not in ("chunks.parquet", "queries.parquet"):
            os.symlink(f"{data}/{t}", d / t)
    c = spark.read.parquet(f"{data}/chunks.parquet").crossJoin(spark.range(30).withColumnRenamed("id", "copy"))
    c = c.withColumn("id", F.concat("id", F.lit("."), "copy")).withColumn("parent_info", F.col("parent_info").withField("parent_chunk_id", F.concat("parent_info.parent_chunk_id", F.lit("."), "copy")))
    c.drop("copy").repartition(4).write.parquet(str(d / "chunks.parquet"))
    q = spark.read.parquet(f"{data}/queries.parquet")
    q.withColumn("query_id", (F.col("query_id") * 100).cast(q.schema["query_id"].dataType)).write.parquet(str(d / "queries.parquet"))
    return str(d)


def shuffled(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return spark.sparkContext._jsc.sc().statusStore().executorList(False).head().totalShuffleWrite()


def characters(spark, folder):
    return spark.read.parquet(f"{folder}/chunks.parquet").agg(F.sum(F.length("text"))).first()[0]


@pytest.mark.parametrize("name", ["bm25_topk", "filtered_search", "hybrid_search", "flare_new_ids", "rrf_fusion", "section_completeness", "rerank_overlap", "full_retrieval", "context_expand_budget", "bm25_weights", "question_lookup", "confidence_score", "flare_retrieval", "claims_alignment"])
def test_shuffles_less_than_the_texts(spark, larger, name, monkeypatch):
    monkeypatch.setattr(index, "_INDEXES", {})
    before = shuffled(spark)
    catalog.all_queries()[name][0](spark, larger).count()
    assert shuffled(spark) - before < 1.5 * characters(spark, larger)


def test_index_takes_less_than_the_texts(spark, larger, tmp_path):
    lexical.build(spark.read.parquet(f"{larger}/chunks.parquet"), "id", "text", str(tmp_path))
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert size < 0.6 * characters(spark, larger)


def test_rows_delivered_again_and_texts_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 2)
    rows = [("b", "levy fee"), ("a", "bail"), ("b", "levy fee"), ("b", "levy levy bail"), (None, "fee"), ("c", ""), ("d", None)]
    rows += [(f"x{i}", "other words") for i in range(9)]
    i = lexical.build(spark.createDataFrame(rows, "id string, text string"), "id", "text")
    got = {(r["id"], r["term"]): r["tf"] for r in i.postings().where("term <> 'other' and term <> 'words'").collect()}
    assert got == {("b", "levy"): 3, ("b", "fee"): 1, ("b", "bail"): 1, ("a", "bail"): 1, (None, "fee"): 1} and i.stats()[:2] == (13, 25 / 13)


def test_counts_beyond_a_byte(spark):
    d = spark.createDataFrame([(1, "levy " * 300 + "fee"), (2, "levy"), (3, "fee " * 256)], "id int, text string")
    i = lexical.build(d, "id", "text")
    assert {(r["id"], r["term"]): r["tf"] for r in i.postings().collect()} == {(1, "levy"): 300, (1, "fee"): 1, (2, "levy"): 1, (3, "fee"): 256}
    q = spark.createDataFrame([(1, "levy")], "q int, t string")
    assert [r["id"] for r in lexical.search(i, q, "q", "t", 5).orderBy("rank").collect()] == [1, 2]


def test_equal_scores_go_by_id_over_all_parts(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    d = spark.createDataFrame([(i, "levy of fee" if i % 3 else "of fee") for i in range(60)], "id int, text string")
    q = spark.createDataFrame([(1, "levy of"), (2, "of of"), (3, "levy of"), (4, "none")], "q int, t string")
    got = {}
    for r in R.bm25_search(d, "id", "text", q, "q", "t", 7).orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r["id"])
    assert got == {1: [1, 2, 4, 5, 7, 8, 10], 2: [0, 3, 6, 9, 12, 15, 18], 3: [1, 2, 4, 5, 7, 8, 10]}
