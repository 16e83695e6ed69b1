"""Queries on model-backed stages, with the deterministic stand-ins."""

from pyspark.sql import functions as F

from lexgrain.operators import providers as P
from lexgrain.operators import lexical as LX
from lexgrain.plans.corpus import _in_order
from lexgrain.plans.flows import QN
from lexgrain.plans.index import BM25_SQL, C, Q, _chunks, text_index
from lexgrain.plans.verify import CLAIMS_OF_ALL, Q_ANSWERED, answer_hits, claims
from lexgrain.session import load


def chunk_contexts(spark, sf):
    c = P.contexts(_in_order(spark, sf), P.provider("template"))
    return c.select("id", F.length("contextualized").cast("bigint").alias("chars"), "error")


def chunk_questions(spark, sf):
    return P.questions(_chunks(spark, sf), P.provider("template")).select("id", F.col("q").cast("bigint").alias("q"), "question")


def text_embeddings(spark, sf):
    e = P.embed(load(spark, sf, "queries").select("query_id", "text").distinct(), "query_id", "text", P.provider("hash"))
    return e.select("id", F.transform("v", lambda x: F.round(x.cast("double"), 6)).alias("v"))


def late_chunking(spark, sf):
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return P.late_chunks(d, P.provider("hash")).select("id", F.col("piece").cast("bigint").alias("piece"), F.transform("v", lambda x: F.round(x.cast("double"), 6)).alias("v"))


def semantic_chunks(spark, sf):
    d = load(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return P.semantic_chunks(d, P.provider("hash")).select("id", F.col("piece").cast("bigint").alias("piece"), F.length("text").cast("bigint").alias("chars"))


def claims_alignment(spark, sf):
    """Statements of all generated answers against the five best texts of their queries."""
    return claims(spark, sf, answer_hits(spark, sf)).select("id", F.col("claim_no").cast("bigint").alias("claim_no"), "finding", "best", "share")


def flare_retrieval(spark, sf):
    """New chunks for the statements of all generated answers that their queries' texts
    support too little: of each the share of supported words is its confidence."""
    best = answer_hits(spark, sf)
    asked = claims(spark, sf, best).select(F.col("id").alias("query"), F.col("claim_no").alias("seg"), F.col("claim").alias("text"), F.col("share").alias("confidence"))
    have = best.where("rank <= 3")
    return P.flare(asked, lambda q: LX.search(text_index(spark, sf, "contextualized_text"), q, "query", "text", 5), have)


QUERIES = {
    "chunk_contexts": (chunk_contexts, None),
    "chunk_questions": (chunk_questions, f"WITH {C}, {QN} SELECT id, k AS q, question FROM qn"),
    "text_embeddings": (text_embeddings, None),
    "late_chunking": (late_chunking, None),
    "semantic_chunks": (semantic_chunks, None),
    "claims_alignment": (claims_alignment, "WITH " + BM25_SQL.replace(Q, Q_ANSWERED) + f", {CLAIMS_OF_ALL} SELECT query_id AS id, claim_no, CASE WHEN share >= 0.6 THEN 'supported' WHEN share >= 0.3 THEN 'partial' ELSE 'unsupported' END AS finding, best, share FROM claims"),
    "flare_retrieval": (flare_retrieval, None),
}
