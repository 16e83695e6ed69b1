"""Structured Streaming forms: windows, sessions, de-duplication, change state."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lexgrain.session import checkpoint_dir


def read_table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder as a file stream, be it one file or a folder.
    Times without a zone are taken in the session's, since watermarks need
    instants."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    if os.path.isfile(path):
        df = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    else:
        df = spark.readStream.schema(schema).parquet(path)
    naive = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive})


def drain(df: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what is there now and give its result as a table.

    Results are written in the shared checkpoint folder. In complete mode each
    batch replaces the result, in append mode each batch is a folder of its own,
    so a batch that is run again after a failure replaces itself.
    """
    spark = df.sparkSession
    at = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out" if mode == "complete" else f"{at}/out/batch={number}")

    q = df.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    out = spark.read.schema(df.schema).parquet(f"{at}/out")
    return out.select(*df.columns)


def tumbling(events: DataFrame, ts: str, key: str, size: str, late: str = "1 hour") -> DataFrame:
    w = events.withWatermark(ts, late).groupBy(F.window(ts, size), key)
    return w.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.col("window.start").alias("start"), key, "n", "total")


def sessions(events: DataFrame, ts: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    s = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap), key)
    return s.agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def first_only(events: DataFrame, ts: str, keys: list[str], late: str = "40 days") -> DataFrame:
    """Each key once within the watermark's reach."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def content_changes(rows: DataFrame, key: str, content_hash: str, at: str) -> DataFrame:
    """(key, seen, changes): per key the number of deliveries and of changes of content
    from one delivery to the next by time, kept as state between batches. Equal times
    are ordered by content."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, changes, last = state.get if state.exists else (0, 0, "")
        for _, h in sorted(x for b in batches for x in zip(b[at], b[content_hash])):
            changes += int(seen > 0 and h != last)
            seen, last = seen + 1, h
        state.update((seen, changes, last))
        yield pd.DataFrame({"key": [k[0]], "seen": [seen], "changes": [changes]})

    return rows.groupBy(key).applyInPandasWithState(step, "key string, seen long, changes long", "seen long, changes long, last string", "update", GroupStateTimeout.NoTimeout)


def ingest_new(spark: SparkSession, source: DataFrame, target: str, key: str, state: str, buckets: int = 64) -> None:
    """Incremental ingest: rows of a stream whose key the target table lacks are
    appended; a batch that is run again finds its own rows and adds none. The table is
    partitioned by ``key_bucket``, and a batch reads the buckets of its keys alone."""

    def write(batch: DataFrame, _: int) -> None:
        new = batch.dropDuplicates([key]).withColumn("key_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        if _exists(spark, target):
            met = [r[0] for r in new.select("key_bucket").distinct().collect()]  # at most ``buckets``
            have = spark.read.parquet(target).where(F.col("key_bucket").isin(met)).select("key_bucket", key)
            new = new.join(have, ["key_bucket", key], "left_anti")
        new.write.mode("append").partitionBy("key_bucket").parquet(target)

    q = source.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0
