from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexgrain.functions import structure as S
from lexgrain.operators import chunking as C
from lexgrain.operators import corpus as K
from lexgrain.operators import providers as P

SECTION = "document_id string, ord int, last_desc int, parent_ord int, level string, number string, title string, text string"


def test_statute_chunks_by_hand(spark):
    rows = [
        ("d", 0, 0, None, "preamble", None, None, "p" * 9000), ("d", 1, 1, None, "chapter", "I", "Start", None), ("d", 2, 3, None, "section", "1", "Name", "own"), ("d", 3, 3, 2, "clause", "a", None, "below"),
        ("d", 4, 8, None, "section", "2", None, "o" * 100), ("d", 5, 6, 4, "sub_section", "1", None, "a" * 4000), ("d", 6, 6, 5, "clause", "a", None, "b" * 1000), ("d", 7, 7, 4, "proviso", None, None, "q" * 50), ("d", 8, 8, 4, "sub_section", "2", None, "c" * 9000),
        ("d", 9, 9, None, "part", "II", None, "part text"), ("d", 10, 10, None, "paragraph", None, None, " "),
    ]
    acts = spark.createDataFrame([("d", "The Salt Act")], "document_id string, act string")
    got = sorted(C.statute_chunks(spark.createDataFrame(rows, SECTION), acts).collect(), key=lambda r: (r["ord"], r["piece"], r["part"]))
    keys = [(r["ord"], r["piece"], r["part"], r["kind"]) for r in got]
    assert keys == [(0, 0, 0, "preamble"), (2, 0, 0, "section"), (4, 0, 0, "section"), (4, 1, 0, "section"), (4, 2, 0, "section"), (4, 2, 1, "section"), (9, 0, 0, "part")]
    by = {k[:3]: r for k, r in zip(keys, got)}
    assert by[2, 0, 0]["text"] == "The Salt Act, Section 1 — Name\n\nown\n\nbelow" and len(by[0, 0, 0]["text"]) == 9000
    assert by[4, 1, 0]["text"].endswith("a" * 10 + "\n\n" + "b" * 1000 + "\n\n" + "q" * 50)  # the proviso stays with what it follows
    assert all(len(r["text"]) // 4 <= 1500 for r in got if r["kind"] == "section")
    first = by[4, 0, 0]["id"]
    assert by[4, 0, 0]["parent_id"] is None and {by[k]["parent_id"] for k in by if k[0] == 4 and k != (4, 0, 0)} == {first}
    assert len({r["id"] for r in got}) == len(got)
    assert C.statute_chunks(spark.createDataFrame([], SECTION), acts).count() == 0


def test_judgment_chunks_by_hand(spark):
    rows = [("j", 0, "header", "Court, parties"), ("j", 1, "facts", "\n".join(["f" * 2500] * 5)), ("j", 2, "holding", "h" * 9000), ("j", 3, "reasoning", "r" * 13000), ("j", 4, "paragraph", "x" * 8000), ("j", 5, "order", None), ("k", 0, "facts", "no header here")]
    got = sorted(C.judgment_chunks(spark.createDataFrame(rows, "document_id string, ord int, level string, text string")).collect(), key=lambda r: (r["document_id"], r["ord"], r["part"]))
    assert [(r["document_id"], r["ord"], r["part"], len(r["text"])) for r in got] == [("j", 0, 0, 14), ("j", 1, 0, 5001), ("j", 1, 1, 5001), ("j", 1, 2, 2500), ("j", 2, 0, 9000), ("j", 3, 0, 6000), ("j", 3, 1, 6000), ("j", 3, 2, 1000), ("j", 4, 0, 8000), ("k", 0, 0, 14)]
    head = got[0]["id"]
    assert got[0]["header_id"] is None and {r["header_id"] for r in got[1:9]} == {head} and got[9]["header_id"] is None
    assert got[2]["parent_id"] == got[1]["id"] and got[1]["parent_id"] is None  # the parent is a chunk that exists


def test_pages(spark):
    d = spark.createDataFrame([("a", "one\ftwo\f \n", 0.5), ("b", "x" * 7000, None), ("c", None, 0.1)], "document_id string, text string, ocr_confidence double")
    assert [tuple(r)[:2] + (len(r["text"]), r["manual_review"]) for r in C.page_chunks(d).orderBy("document_id", "page").collect()] == [("a", 0, 3, True), ("a", 1, 3, True), ("b", 0, 6000, False), ("b", 1, 1000, False)]


def test_lines(spark):
    lines = ["CHAPTER IV — Levy", "Section 12A. Fees", "Sec. 3 x", "(1) The fee", "(a) one", "Provided that no", "Explanation. - a", "THE FIRST SCHEDULE", "PART II", "plain sections 5", "## Brief facts", "ORDER", "Order of the day", "We hold that it is", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t string")
    got = [(r["l"], r["n"], r["h"]) for r in df.select("i", S.statute_level(F.col("t")).alias("l"), S.statute_number(F.col("t")).alias("n"), S.heading_class(S.without_marks(F.col("t"))).alias("h")).orderBy("i").collect()]
    assert got == [("chapter", "IV", None), ("section", "12A", None), ("section", "3", None), ("sub_section", "1", None), ("clause", "A", None), ("proviso", None, None), ("explanation", None, None), ("schedule", None, None), ("part", "II", None), (None, None, None), (None, None, "facts"), (None, None, "order"), (None, None, None), (None, None, "holding"), (None, None, None)]


def test_maxmin_breaks_where_sentences_differ():
    text = "Rent is due. Rent is due now. Rent was due. Bail was granted. Bail was refused. Bail was granted again."
    got = P.maxmin_pieces(text, P.HashEmbedder(), 200, 5)
    assert "".join(got).replace(" ", "") == text.replace(" ", "") and any(p.startswith("Bail was granted.") for p in got)
    assert P.maxmin_pieces("", P.HashEmbedder()) == [] and [len(p) for p in P.maxmin_pieces("x" * 950, P.HashEmbedder(), 400)] == [400, 400, 150]


def test_recursive_pieces_go_by_ever_finer_separators():
    text = "a" * 30 + "\n\n" + "b" * 30 + "\n" + "c" * 30 + ". " + "d" * 30
    assert P.semantic_pieces(text, P.HashEmbedder(), 40) == ["a" * 30, "b" * 30, "c" * 30, "d" * 30]


def test_positions_by_blocks_equal_plain_windows(spark):
    rows = [(f"i{n:03}", "hot" if n % 3 else f"d{n % 7}", (n * 37) % 500 if n % 11 else None, n % 5) for n in range(300)]
    df = spark.createDataFrame(rows, "id string, document_id string, chunk_index int, tokens int")
    w = W.partitionBy("document_id").orderBy(F.asc_nulls_first("chunk_index"), "id")
    want = {r["id"]: r["s"] for r in df.withColumn("s", F.coalesce(F.sum("tokens").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).collect()}
    assert {r["id"]: r["start"] for r in K.running_total(df, "document_id", "chunk_index", "id", "tokens", 16).collect()} == want
    near = F.concat(F.collect_list("id").over(w.rowsBetween(-2, -1)), F.collect_list("id").over(w.rowsBetween(1, 2)))
    want = {r["id"]: r["n"] for r in df.withColumn("n", near).collect()}
    assert {r["id"]: r["siblings"] for r in K.siblings(df, "document_id", "chunk_index", "id", size=8).collect()} == want


def test_context_is_made_from_the_window(spark):
    rows = [("a", "d", 0, "First of all. x" + "y" * 185), ("b", "d", 1, "z" * 200), ("c", "d", 2, "Third one. " + "w" * 189), ("n", "d", 3, None), ("o", "e", 0, "Other text. End.")]
    df = spark.createDataFrame(rows, "id string, document_id string, chunk_index int, text string")
    got = {r["id"]: (r["contextualized"], r["error"]) for r in P.contexts(df, P.provider("template"), size=110, overlap=10).collect()}
    assert got["a"][0].startswith("First of all.\n\n") and got["b"][0].startswith("First of all.\n\n") and got["c"][0].startswith("Third one.\n\n") and got["n"] == (None, None) and got["o"][0].startswith("Other text.")


def test_windows_share_their_edges(spark):
    df = spark.createDataFrame([(str(i), "d", i, 5) for i in range(45)], "id string, document_id string, chunk_index int, tokens int")
    got = {r["id"]: (r["window"], r["other"]) for r in K.token_windows(df, 110, 10).collect()}
    assert got["0"] == (0, None) and got["19"] == (0, None) and got["20"] == (1, 0) and got["21"] == (1, 0) and got["22"] == (1, None) and got["40"] == (2, 1)
