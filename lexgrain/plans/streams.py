"""Queries that run as streams over what is there, and their batch SQL."""

from pyspark.sql import functions as F

from lexgrain.streaming import events as E


#: what counts as the content of a parsed document
CONTENT = ("title", "act_name", "act_number", "year", "date", "court", "case_citation", "parties", "page_count", "parser_used")


def stream_tumbling(spark, sf):
    s = E.tumbling(E.read_table_stream(spark, sf, "events"), "ts", "event_type", "1 hour")
    return E.drain(s, "complete").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", "total")


def stream_sessions(spark, sf):
    s = E.sessions(E.read_table_stream(spark, sf, "events"), "ts", "user_id", "30 minutes")
    return E.drain(s, "complete").select(F.unix_micros("start").alias("start"), "user_id", "n")


def stream_dedup(spark, sf):
    s = E.first_only(E.read_table_stream(spark, sf, "events"), "ts", ["user_id", "event_type"])
    return E.drain(s.select("user_id", "event_type"), "append")


def stream_changes(spark, sf):
    """Deliveries of each parsed document and changes of its content between them."""
    p = E.read_table_stream(spark, sf, "parsed_documents")
    content = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CONTENT]), 256)
    d = p.select(F.col("document_id").alias("key"), content.alias("content_hash"), F.col("parsed_at").alias("at"))
    return E.drain(E.content_changes(d, "key", "content_hash", "at"), "update").groupBy("key").agg(F.max("seen").alias("seen"), F.max("changes").alias("changes"))


QUERIES = {
    "stream_tumbling": (stream_tumbling, "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2"),
    "stream_sessions": (stream_sessions, """WITH l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events), s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM l)
SELECT epoch_us(min(ts)) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, g"""),
    "stream_dedup": (stream_dedup, "SELECT DISTINCT user_id, event_type FROM events"),
    "stream_changes": (stream_changes, "WITH d AS (SELECT document_id AS key, parsed_at AS t, sha256(" + " || '|' || ".join(f"coalesce({c}::VARCHAR, '')" for c in CONTENT) + """) AS h FROM parsed_documents), l AS (SELECT *, lag(h) OVER (PARTITION BY key ORDER BY t, h) AS p FROM d)
SELECT key, count(*) AS seen, count(*) FILTER (p IS NOT NULL AND p <> h) AS changes FROM l GROUP BY 1"""),
}
