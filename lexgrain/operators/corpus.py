"""Corpus dataflow: change detection, quality, structure windows, run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.functions.text import letters_ratio, non_ascii_ratio


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the given order (which must be total)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def changed(found: DataFrame, state: DataFrame, key: str, content_hash: str, full: bool = False) -> DataFrame:
    """Rows of a crawl that are new or whose content differs from the state, with
    ``reason``; in full mode everything counts as new."""
    old = state.select(F.col(key).alias("_k"), F.col(content_hash).alias("_h")).where(F.lit(not full))
    j = found.join(old, F.col(key) == F.col("_k"), "left")
    reason = F.when(F.col("_k").isNull(), "new").when(~F.col("_h").eqNullSafe(F.col(content_hash)), "changed")
    return j.withColumn("reason", reason).where("reason is not null").drop("_k", "_h")


def upsert_state(state: DataFrame, found: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The crawl state after a run: records found replace those of the same key."""
    new = found.select(*cols)
    return state.select(*cols).join(new.select(key), key, "left_anti").unionByName(new)


def skip_existing(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key).distinct(), key, "left_anti")


def first_seen(df: DataFrame, url: str, order: str, cap: int, source: str) -> DataFrame:
    """Addresses of each source without a trailing slash, each at its first place, at
    most ``cap`` a source (the limit of documents that it may give)."""
    u = df.select(source, F.regexp_replace(F.col(url), "/+$", "").alias("url"), F.col(order).alias("seq")).where("url is not null")
    g = u.groupBy(source, "url").agg(F.min("seq").alias("seq"))
    return g.withColumn("_n", F.row_number().over(W.partitionBy(source).orderBy("seq", "url"))).where(F.col("_n") <= cap).drop("_n")


def review_flags(text: Column, title: Column, is_pdf: Column) -> Column:
    """Flags of a first look at a text; each type once."""
    n = F.length(F.coalesce(text, F.lit("")))
    return F.array_compact(F.array(
        F.when(n < 500, F.lit("small_content")),
        F.when(non_ascii_ratio(F.coalesce(text, F.lit(""))) > 0.3, F.lit("non_latin")),
        F.when(is_pdf & (n > 1000) & (letters_ratio(F.coalesce(text, F.lit(""))) < 0.1), F.lit("likely_scan")),
        F.when(title.isNull(), F.lit("missing_title")),
    ))


def text_completeness(chars: Column, pages: Column, is_html: Column, chars_a_page: int = 2000) -> Column:
    """Share of the characters that so many pages should hold, at most 1."""
    return F.when(is_html | pages.isNull() | (pages == 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), chars / (pages * chars_a_page)))


def sequence_score(df: DataFrame, key: str, number: str) -> DataFrame:
    """(key, sections, gaps, score): section numbers in order, a gap wherever the
    next is more than one higher; below two numbers the score is 1."""
    n = df.select(key, F.expr(f"try_cast(nullif(regexp_extract({number}, '^([0-9]+)', 1), '') as int)").alias("n")).where("n is not null")
    w = W.partitionBy(key).orderBy("n")
    g = n.withColumn("gap", F.when(F.col("n") > F.lag("n").over(w) + 1, 1).otherwise(0))
    g = g.groupBy(key).agg(F.count(F.lit(1)).alias("sections"), F.sum("gap").alias("gaps"))
    return g.withColumn("score", F.when(F.col("sections") < 2, 1.0).otherwise(F.round(F.greatest(F.lit(0.0), 1 - F.col("gaps") / (F.col("sections") - 1)), 6)))


def siblings(df: DataFrame, doc: str, order: str, id_col: str, reach: int = 2, size: int = 4096) -> DataFrame:
    """Adds ``index`` (from 0) and ``siblings``: ids of the neighbours within ``reach``,
    in order. Rows are numbered by blocks, and each block gets the ends of its
    neighbours, so that no document is one task."""
    n = running_total(df.withColumn("_one", F.lit(1)), doc, order, id_col, "_one", size).drop("_one").withColumnRenamed("start", "index")
    at = lambda x: F.floor(x / size).cast("bigint")
    n = n.withColumn("_b", F.explode(F.array_distinct(F.array(at(F.col("index")), at(F.col("index") - reach), at(F.col("index") + reach)))))
    w = W.partitionBy(doc, "_b").orderBy("index")
    near = F.concat(F.collect_list(id_col).over(w.rowsBetween(-reach, -1)), F.collect_list(id_col).over(w.rowsBetween(1, reach)))
    return n.withColumn("siblings", near).where(F.col("_b") == at(F.col("index"))).drop("_b")


def running_total(df: DataFrame, doc: str, order: str, id_col: str, value: str, size: int = 4096) -> DataFrame:
    """Adds ``start``: the sum of ``value`` over all rows of the document before the
    row. Rows are summed by blocks of ``size`` places first and the blocks are added
    up, so that a document with a third of all rows is many small tasks."""
    b = df.withColumn("_b", F.coalesce(F.floor(F.col(order) / size), F.lit(-1)).cast("bigint"))
    sums = b.groupBy(doc, "_b").agg(F.sum(value).alias("_v"))
    before = sums.select(doc, "_b", F.coalesce(F.sum("_v").over(W.partitionBy(doc).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_p"))
    w = W.partitionBy(doc, "_b").orderBy(F.asc_nulls_first(order), id_col).rowsBetween(W.unboundedPreceding, -1)
    own = b.withColumn("_o", F.coalesce(F.sum(value).over(w), F.lit(0)))
    return own.join(before, [doc, "_b"]).withColumn("start", (F.col("_p") + F.col("_o")).cast("bigint")).drop("_b", "_p", "_o")


def token_windows(chunks: DataFrame, size: int = 180_000, overlap: int = 500) -> DataFrame:
    """Adds ``start``, ``window`` and ``other`` to chunks(id, document_id, chunk_index,
    tokens): the window in which the chunk begins, and the one before where it begins
    in the share of both."""
    step = size - overlap
    c = running_total(chunks, "document_id", "chunk_index", "id", "tokens")
    c = c.withColumn("window", F.expr(f"start div {step}"))
    return c.withColumn("other", F.when((F.col("window") > 0) & (F.col("start") % step < overlap), F.col("window") - 1))


def carry_down(df: DataFrame, doc: str, order: str, level: str, wanted: str, value: Column, name: str) -> DataFrame:
    """Adds the value of the last row of level ``wanted`` at or before each row."""
    w = W.partitionBy(doc).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.last(F.when(F.col(level) == wanted, value), ignorenulls=True).over(w))


def attached_groups(df: DataFrame, doc: str, order: str, level: str, attached: list[str]) -> DataFrame:
    """Adds ``grp``: provisos and explanations belong to the row before them."""
    w = W.partitionBy(doc).orderBy(order)
    opens = F.when(F.col(level).isin(attached) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("_o", opens).withColumn("grp", F.sum("_o").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_o")


def subtree(df: DataFrame, doc: str, wanted: str) -> DataFrame:
    """(doc, ord, parts, tokens): size of the subtree of each row of the level
    ``wanted``, over the pre-order interval [ord, last_desc] (whose end must be a row):
    a difference of running sums."""
    w = W.partitionBy(doc).orderBy("ord")
    t = df.withColumn("_c", F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).withColumn("_n", F.row_number().over(w)).withColumn("_t", F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, 0)))
    # the total up to the last row below, less that before the row itself
    end = t.select(doc, F.col("ord").alias("last_desc"), F.col("_n").alias("_n2"), F.col("_t").alias("_t2"))
    j = t.where(F.col("level") == wanted).join(end, [doc, "last_desc"])
    return j.select(doc, "ord", (F.col("_n2") - F.col("_n") + 1).cast("bigint").alias("parts"), (F.col("_t2") - F.col("_t") + F.col("_c")).alias("chars"))


def pack_paragraphs(text: Column, limit: int) -> Column:
    """Greedy packing of paragraphs into pieces of at most ``limit`` characters
    (a larger paragraph is a piece of its own); a fold inside Catalyst."""
    paras = F.filter(F.split(text, "\n"), lambda p: F.trim(p) != "")
    start = F.expr("cast(array() as array<string>)")

    def step(acc, p):
        last = F.element_at(acc, -1)
        fits = (F.size(acc) > 0) & (F.length(last) + 1 + F.length(p) <= limit)
        return F.when(fits, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat(last, F.lit("\n"), p)))).otherwise(F.concat(acc, F.array(p)))

    return F.aggregate(paras, start, step)


def fixed_pieces(text: Column, size: int) -> Column:
    """The text in pieces of ``size`` characters."""
    n = F.ceil(F.length(text) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def run_summary(df: DataFrame, status: str) -> DataFrame:
    """One row of counters of a run."""
    c = lambda s: F.count_if(F.col(status) == s)
    return df.agg(F.count(F.lit(1)).alias("found"), c("processed").alias("processed"), c("skipped").alias("skipped"), c("failed").alias("failed"))


def line_sections(df: DataFrame, id_col: str, text_col: str, heading: str) -> DataFrame:
    """(id, section, heading, lines, chars): lines of a text grouped under the last
    line that matches ``heading``; section 0 is what stands before the first."""
    ln = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.posexplode(F.split(text_col, "\r\n|\n|\r|\f")).alias("pos", "line"))
    w = W.partitionBy("id").orderBy("pos")
    ln = ln.withColumn("h", F.col("line").rlike(heading)).withColumn("section", F.sum(F.when(F.col("h"), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    g = ln.groupBy("id", "section").agg(F.max(F.when(F.col("h"), F.trim("line"))).alias("heading"), F.count(F.lit(1)).alias("lines"), F.sum(F.length("line")).alias("chars"))
    return g
