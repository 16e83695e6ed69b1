import os

import pytest
from pyspark.sql import functions as F

from lexgrain.plans import flows


@pytest.fixture(scope="module")
def asked(spark, data, tmp_path_factory):
    """The small tables, with every query in the stated set."""
    d = tmp_path_factory.mktemp("asked")
    os.symlink(f"{data}/chunks.parquet", d / "chunks.parquet")
    q = spark.read.parquet(f"{data}/queries.parquet").withColumn("query_id", F.col("query_id") * 100)
    name = F.regexp_extract("statute.act_name", "^The ([A-Za-z ]+ Act), [0-9]{4}$", 1)
    act = spark.read.parquet(f"{data}/chunks.parquet").select(name.alias("a")).where("a <> ''").agg(F.min("a")).first()[0]
    named = q.where("text is not null").limit(1).withColumn("query_id", F.lit(-100).cast("long")).withColumn("text", F.lit(f"What is section 3 of the {act}?"))
    q.unionByName(named.withColumn("query_id", F.col("query_id").cast(q.schema["query_id"].dataType))).write.parquet(str(d / "queries.parquet"))
    return str(d)


def test_all_channels_are_fused_within_their_gates(spark, asked):
    f = flows.fused_hits(spark, asked).select("query", F.explode("channels").alias("channel")).groupBy("query").agg(F.collect_set("channel").alias("c"))
    got = {r["query"]: set(r["c"]) for r in f.collect()}
    gates = {r["query_id"]: set(r["channels"].split(",")) for r in flows.channel_gate(spark, asked).collect()}
    looked = {r["query"] for r in flows.question_lookup(spark, asked).collect() if "questions" in gates[r["query"]]}
    named = {r["query_id"] for r in flows.graph_search(spark, asked).collect() if "graph" in gates[r["query_id"]]}
    assert looked and named
    assert {q for q, c in got.items() if "questions" in c} == looked and {q for q, c in got.items() if "graph" in c} == named
    assert all(flows.GATES[x] in gates[q] for q, c in got.items() for x in c)


def test_reranked_and_expanded_hits_are_those_of_the_fused_list(spark, asked):
    fused = {(r["query"], r["id"]) for r in flows.fused_hits(spark, asked).collect()}
    got = flows.full_retrieval(spark, asked).collect()
    assert got and all((r["query"], r["id"]) in fused for r in got) and all(r["rank"] <= 20 for r in got)


def test_statements_with_little_support_bring_new_chunks(spark, asked):
    from lexgrain.plans import enrich, index

    got = {(r["query"], r["id"]) for r in enrich.flare_retrieval(spark, asked).collect()}
    have = {(r["query"], r["id"]) for r in index.found(spark, asked, 3).collect()}
    assert got and not got & have
