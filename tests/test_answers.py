"""Queries on generated answers take all answers, and all of each."""

import os

from pyspark.sql import functions as F

from lexgrain.plans import enrich


def answered(spark, folder):
    q = spark.read.parquet(f"{folder}/queries.parquet").where("text is not null").groupBy("query_id").agg(F.max("hyde_text").alias("a"))
    return {r["query_id"] for r in q.where("trim(a) <> ''").collect()}


def test_statements_of_every_answer(spark, data):
    want = answered(spark, data)
    assert any(i % 100 for i in want) and {r["id"] for r in enrich.claims_alignment(spark, data).collect()} == want


def test_every_statement_of_a_long_answer(spark, data, tmp_path):
    os.symlink(f"{data}/chunks.parquet", tmp_path / "chunks.parquet")
    q = spark.read.parquet(f"{data}/queries.parquet").where("text is not null").limit(1)
    q.withColumn("hyde_text", F.lit(" ".join(f"Statement {i} is here." for i in range(60)))).write.parquet(str(tmp_path / "queries.parquet"))
    assert sorted(r["claim_no"] for r in enrich.claims_alignment(spark, str(tmp_path)).collect()) == list(range(60))


def test_further_retrieval_for_every_answer(spark, data):
    got = {r["query"] for r in enrich.flare_retrieval(spark, data).collect()}
    assert any(i % 100 for i in got) and got <= answered(spark, data)
