"""Table sinks and sources: partitioned raw documents, keyed upserts, worksheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORES = "query_id string, evaluator_id string, accuracy int, completeness int, recency int, usefulness int, notes string"


def write_raw(df: DataFrame, path: str) -> None:
    """Raw documents by source type, so that a source is one folder to prune to."""
    df.write.mode("append").partitionBy("source_type").parquet(path)


def read_raw(spark: SparkSession, path: str, source_type: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("source_type") == source_type) if source_type else df


def upsert(spark: SparkSession, path: str, rows: DataFrame, key: str) -> str:
    """Replace rows by key: a version of the table is what was written then, so that a
    small batch is a small write and readers are never disturbed; gives its path.
    Keys must be unique within ``rows``; null keys aren't stored."""
    versions = sorted(int(p.rsplit("=", 1)[1]) for p in _folders(spark, path))
    new = f"{path}/version={(versions[-1] + 1) if versions else 0}"
    rows.where(F.col(key).isNotNull()).withColumn("_key", F.col(key).cast("string")).write.mode("overwrite").parquet(new)
    return new


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """The table: of each key the row of its last version, by a partial aggregate."""
    t = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*_folders(spark, path))
    cols = [c for c in t.columns if c not in ("_key", "version")]
    return t.groupBy("_key").agg(F.max_by(F.struct(*cols), "version").alias("r")).select("r.*")


def compact(spark: SparkSession, path: str, key: str) -> str:
    """All versions as one more, from which on a reader needs no other."""
    new = upsert(spark, path, latest_version(spark, path), key)
    jvm = spark.sparkContext._jvm
    for p in _folders(spark, path):
        if int(p.rsplit("=", 1)[1]) < int(new.rsplit("=", 1)[1]):
            old = jvm.org.apache.hadoop.fs.Path(p)
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return new


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().toString() for s in fs.listStatus(p)]
    done = [n for n in names if "/version=" in n and fs.exists(jvm.org.apache.hadoop.fs.Path(n + "/_SUCCESS"))]
    return done


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """Query texts of a JSON file: a list, or ``{"queries": [...]}``; items are
    texts or objects with a text."""
    raw = spark.read.text(path, wholetext=True)
    v = F.try_parse_json("value")
    items = F.coalesce(F.try_variant_get(v, "$.queries", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"))
    e = raw.select(F.posexplode(items).alias("pos", "q"))
    text = F.coalesce(F.try_variant_get("q", "$.text", "string"), F.try_variant_get("q", "$", "string"))
    return e.select(F.col("pos").alias("query_id"), text.alias("text")).where("text is not null and trim(text) <> ''")


def write_worksheets(df: DataFrame, path: str) -> None:
    """Blank score sheets for evaluators, one JSON line a query."""
    blank = [F.lit(None).cast("int").alias(c) for c in ("accuracy", "completeness", "recency", "usefulness")]
    df.select("query_id", "query_text", "response_text", *blank, F.lit("").alias("notes")).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_scoresheets(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(scores, rejects): JSON lines; broken lines and scores outside 1..5 go to
    the rejects with a reason."""
    schema = T.StructType.fromDDL(SCORES).add("_corrupt", "string")
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    marks = ("accuracy", "completeness", "recency", "usefulness")
    bad = F.when(F.col("_corrupt").isNotNull(), "not JSON").when(F.col("query_id").isNull(), "no query")
    for c in marks:
        bad = bad.when(~F.coalesce(F.col(c).between(1, 5), F.lit(False)), f"{c} outside 1..5")
    marked = raw.withColumn("reason", bad)
    cols = [f.name for f in T.StructType.fromDDL(SCORES)]
    return marked.where("reason is null").select(*cols), marked.where("reason is not null").select(*cols, "reason")


EVAL = (
    "query_id string, query_text string, practice_area string, query_type string, expected_route string, expected_citations array<string>, expected_sections array<string>, "
    "reference_answer string, temporal_test boolean, cross_reference_test boolean"
)


def read_eval_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Test queries of a JSON array; a file that isn't one is an error."""
    return spark.read.schema(EVAL).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def eval_inputs(tests: DataFrame, results: DataFrame) -> DataFrame:
    """Test queries with the results of a run; tests without a result keep nulls,
    and ``judged`` tells those with a response that isn't blank."""
    j = tests.join(results, "query_id", "left")
    return j.withColumn("judged", F.coalesce(F.trim("response_text") != "", F.lit(False)))
