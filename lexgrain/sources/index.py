"""The whole index of a set of chunks in a folder: terms, vectors, questions, parents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexgrain.functions.vector import head
from lexgrain.operators import lexical, providers
from lexgrain.session import joined

TABLES = ("vectors", "questions", "parents")


def write(chunks: DataFrame, path: str, embedder: Callable[[], object], completer: Callable[[], object], fast: int = 16) -> None:
    """Index chunks(id, text, contextualized_text, parent_id, header_id).

    Terms are those of the contextualised text where there is one; vectors are of the
    text, whole and cut to their first ``fast`` numbers; questions are keyed by chunk
    and number; parents are the chunks that others name as parent or header.
    """
    c = chunks.dropDuplicates(["id"])
    lexical.build(c.select("id", F.coalesce("contextualized_text", "text").alias("text")).where("text is not null"), "id", "text", f"{path}/terms")
    v = providers.embed(c, "id", "text", embedder)
    v.select("id", "v", head(F.col("v"), fast).alias("fast")).write.mode("overwrite").parquet(f"{path}/vectors")
    providers.questions(c.where("text is not null"), completer).write.mode("overwrite").parquet(f"{path}/questions")
    named = c.select(F.explode(F.array_compact(F.array("parent_id", "header_id"))).alias("id")).distinct()
    joined(c.select("id", "text"), named, "id", "left_semi").write.mode("overwrite").parquet(f"{path}/parents")


def read(spark: SparkSession, path: str) -> tuple[lexical.LexicalIndex, dict[str, DataFrame]]:
    """The stored term index and the tables; a missing part is an error of Spark."""
    return lexical.LexicalIndex(spark, f"{path}/terms"), {t: spark.read.parquet(f"{path}/{t}") for t in TABLES}


def missing(chunks: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Chunks that the stored vectors lack."""
    return chunks.join(spark.read.parquet(f"{path}/vectors").select("id"), "id", "left_anti")
