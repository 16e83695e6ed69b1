"""Chunks of structured documents: text, ids, headers, parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.operators.corpus import fixed_pieces, pack_paragraphs

#: characters that count as one token
CHARS = 4
JUDGMENT_PARTS = ("facts", "issues", "reasoning", "holding", "order", "dissent", "obiter")


def chunk_id(*parts: Column) -> Column:
    """An id that follows from what it names."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, 16)


def with_parents(chunks: DataFrame, unit: list[str], order: list[str]) -> DataFrame:
    """Adds ``parent_id``: the first chunk of the same unit, null for that one."""
    first = F.first("id").over(W.partitionBy(*unit).orderBy(*order))
    return chunks.withColumn("_f", first).withColumn("parent_id", F.when(F.col("_f") != F.col("id"), F.col("_f"))).drop("_f")


def statute_chunks(sections: DataFrame, acts: DataFrame, limit: int = 1500) -> DataFrame:
    """(id, parent_id, document_id, ord, piece, part, kind, header, text) of statutes.

    sections(document_id, ord, last_desc, parent_ord, level, number, title, text) in
    pre-order, acts(document_id, act). A section with all below it is one chunk under
    the header "Act, Section n — title"; one beyond ``limit`` tokens is its own text
    and one chunk for each group of children (a proviso or explanation stays with what
    it follows), and a group beyond the limit is cut. The first chunk of a section is
    the parent of its others. Outside of sections every row with a text is a chunk of
    any size. One pass in order per document: rows look back to the last section that
    still encloses them, nothing is joined with itself.
    """
    w = W.partitionBy("document_id").orderBy("ord")
    opened = F.last(F.when(F.col("level") == "section", F.struct("ord", "last_desc", "number", "title")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    s = sections.join(acts, "document_id").withColumn("_t", F.coalesce("text", F.lit(""))).withColumn("_s", opened)
    s = s.withColumn("_in", F.coalesce(F.col("ord") <= F.col("_s.last_desc"), F.lit(False)))
    act = F.coalesce("act", F.lit("Unknown act"))
    header = F.concat(act, F.lit(", Section "), F.coalesce("_s.number", F.lit("?")), F.coalesce(F.concat(F.lit(" — "), F.col("_s.title")), F.lit("")))
    inside = s.where("_in").withColumn("sec", F.col("_s.ord")).withColumn("header", header)
    v = W.partitionBy("document_id", "sec").orderBy("ord")
    # in pre-order what is below a child follows it, and so falls into its group
    starts = (F.col("parent_ord") == F.col("sec")) & (~F.col("level").isin("proviso", "explanation") | (F.row_number().over(v) == 2))
    inside = inside.withColumn("_o", F.coalesce(starts, F.lit(False)).cast("int")).withColumn("_g", F.sum("_o").over(v.rowsBetween(W.unboundedPreceding, 0)))
    inside = inside.withColumn("_all", F.sum(F.length("_t") + 2).over(W.partitionBy("document_id", "sec")))
    room = F.greatest(F.lit(limit * CHARS // 4), F.lit(limit * CHARS + CHARS - 1) - F.length("header") - 2)
    inside = inside.withColumn("piece", F.when(F.col("_all") - 2 <= room, 0).otherwise(F.col("_g")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_t") != "", F.struct("ord", "_t")))), lambda x: x["_t"]), "\n\n")
    g = inside.groupBy("document_id", "sec", "piece", "header").agg(text.alias("body")).where("body <> ''").withColumn("room", room)
    n = F.ceil(F.length("body") / F.col("room")).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("body"), i * F.col("room") + 1, F.col("room")))
    g = g.select("document_id", F.col("sec").alias("ord"), "piece", "header", F.posexplode(parts).alias("part", "body"))
    one = g.select("document_id", "ord", "piece", "part", F.lit("section").alias("kind"), "header", F.concat("header", F.lit("\n\n"), "body").alias("text"))
    rest = s.where("not _in and trim(_t) <> ''").select("document_id", "ord", F.lit(0).alias("piece"), F.lit(0).alias("part"), F.col("level").alias("kind"), act.alias("header"), F.col("_t").alias("text"))
    out = one.unionByName(rest)
    out = out.withColumn("id", chunk_id(F.col("document_id"), F.col("ord"), F.col("piece"), F.col("part")))
    return with_parents(out, ["document_id", "ord"], ["piece", "part"])


def judgment_chunks(sections: DataFrame, limit: int = 1500) -> DataFrame:
    """(id, parent_id, header_id, document_id, ord, part, kind, text) of judgments.

    The header's chunk is named by every other chunk of its document; a holding is
    never cut; other parts of a judgment are packed by paragraphs and then cut at the
    limit; paragraphs and all else stay whole. Pieces name the first piece of their
    section as parent. Rows without text give no chunk.
    """
    s = sections.where("trim(coalesce(text, '')) <> ''")
    packed = F.flatten(F.transform(pack_paragraphs(F.col("text"), limit * CHARS), lambda p: F.when(F.length(p) <= limit * CHARS, F.array(p)).otherwise(fixed_pieces(p, limit * CHARS))))
    cut = F.col("level").isin(*[p for p in JUDGMENT_PARTS if p != "holding"]) & (F.length("text") > limit * CHARS)
    p = s.select("document_id", "ord", F.col("level").alias("kind"), F.posexplode(F.when(cut, packed).otherwise(F.array("text"))).alias("part", "text"))
    p = p.withColumn("id", chunk_id(F.col("document_id"), F.col("ord"), F.lit(0), F.col("part")))
    head = F.first(F.when(F.col("kind") == "header", F.col("id")), ignorenulls=True).over(W.partitionBy("document_id").orderBy("ord", "part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    p = p.withColumn("_h", head).withColumn("header_id", F.when(F.col("_h") != F.col("id"), F.col("_h"))).drop("_h")
    return with_parents(p, ["document_id", "ord"], ["part"])


def page_chunks(docs: DataFrame, size: int = 6000, least_ocr: float = 0.8) -> DataFrame:
    """(document_id, page, text, manual_review): pages of a text with form feeds, else
    pieces of ``size``; a scan read with less confidence is marked for review.
    docs(document_id, text, ocr_confidence)."""
    blank = lambda x: F.trim(F.regexp_replace(x, "[\\r\\n\\t]", "")) == ""
    pages = F.when(F.contains("text", F.lit("\f")), F.filter(F.split("text", "\f"), lambda x: ~blank(x))).otherwise(fixed_pieces(F.col("text"), size))
    p = docs.where("text is not null and text <> ''").select("document_id", F.coalesce(F.col("ocr_confidence") < least_ocr, F.lit(False)).alias("manual_review"), F.posexplode(pages).alias("page", "text"))
    return p.select("document_id", "page", "text", "manual_review")
