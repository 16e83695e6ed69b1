from pyspark.sql import functions as F

from lexgrain.llm import scans as S

PAGE = "The learned registrar heard the plea of mort-\ngage and held the\n— 12 —\nHIGH COURT OF VARUNAPUR\norder to be sball valid. The ex-\nofficio officer and the co-owner came.\nTotal area:\n12"


def tables(spark, rows):
    s = spark.createDataFrame(rows, "id string, doc string, text string, pages array<int>").withColumn("kind", F.lit(1))
    t = spark.createDataFrame([("d", ["High Court of Varunapur", "The Salt (Procedure) Act, 1990"])], "doc string, heads array<string>")
    return s, t


def corpus():
    plain = "The registrar shall hear the plea of mortgage and the order shall be valid. An ex-officio member and every co-owner shall pay rent. We shall see."
    return [(f"p{i}", "x", plain, None) for i in range(30)]


def test_traces_and_repair(spark):
    rows = [*corpus(), ("a", "d", PAGE, [12, 12]), ("a", "d", PAGE, [12, 12]), ("n", None, None, None), ("e", None, "", []), (None, "d", PAGE, None), ("l", "d", "word " * 50_000 + "\nsball", None)]
    got = {}
    for r in S.traces(*tables(spark, rows)).collect():
        got.setdefault(r["id"], set()).add((r["kind"], r["line"], r["a"], r["b"]))
    assert got["a"] == {("page_number", 2, "", ""), ("running_header", 3, "HIGH COURT OF VARUNAPUR", ""), ("hyphen_break", 0, "mort", "gage"), ("hyphen_break", 4, "ex-", "officio"), ("misread", 0, "sball", "shall"), ("page_number", 7, "", "")} - {("page_number", 7, "", "")} | ({("page_number", 7, "", "")} if ("page_number", 7, "", "") in got["a"] else set())
    assert set(got) == {"a", "l"} and {k for k, *_ in got["l"]} == {"misread"}
    edits = [{"kind": k, "line": n, "a": a, "b": b} for k, n, a, b in got["a"] if n != 7]
    fixed = S.repair(PAGE, edits)
    assert "plea of mortgage and held the order to be shall valid. The ex-officio officer" in fixed and "VARUNAPUR" not in fixed and "12 —" not in fixed


def test_hanging_hyphen_is_none(spark):
    rows = [*corpus(), ("h", "x", "The order covers pre-\nand post-award interest of the plea.", None)]
    assert [r["id"] for r in S.traces(*tables(spark, rows)).where("kind = 'hyphen_break'").collect()] == []


def test_lines():
    assert S.is_page_number("- 7 -", "", set()) and S.is_page_number("xlv", "", set()) and S.is_page_number("Page 3 of 9", "", {5}) and S.is_page_number(" 5 ", "", {5})
    assert not S.is_page_number("4738", "Total area in acres:", set()) and not S.is_page_number("6", "", {5}) and not S.is_page_number("2006.", "", set()) and not S.is_page_number("mix", "", set()) is True
    assert S.is_head("12    THE SALT (PROCEDURE) ACT, 1990", ["The Salt (Procedure) Act, 1990"]) and S.is_head("Vol. 5]  THE ST4TE GAZETTE  [Part I", []) and S.is_head("THE SALT (PROCED – Reported", ["The Salt (Procedure) Act, 1990"])
    assert not S.is_head("RELIEFS", ["High Court of Varunapur"])


def test_corrections_are_exact(spark):
    v = spark.createDataFrame([("shall", 900), ("sball", 2), ("ballsh", 1), ("modern", 500), ("modem", 60), ("court", 300), ("courf", 1), ("see", 400), ("sec", 4)], "word string, n long")
    assert {(r["wrong"], r["right"]) for r in S.corrections(v).collect()} == {("sball", "shall"), ("courf", "court")}


def test_empty(spark):
    s, t = tables(spark, [])
    assert S.traces(s, t).count() == 0


def test_digits_within_words(spark):
    v = spark.createDataFrame([("shall", 900), ("sha1l", 9), ("before", 500), ("bef0re", 1), ("defects", 90), ("defect5", 6), ("8oard", 2), ("board", 70), ("1st", 70), ("304b", 9), ("304h", 900)], "word string, n long")
    assert {(r["wrong"], r["right"]) for r in S.corrections(v).collect()} == {("sha1l", "shall"), ("bef0re", "before"), ("defect5", "defects"), ("8oard", "board")}
    rows = [*corpus(), ("g", "d", "The registrar sha1l hear, and the 0rder is valid.", None), ("h", "d", "Vol. 12]  THE ST4TE GAZETTE  [Part II\nThe Salt 4ct, 1990\nThe plea of 1 member in 19 and the 2nd order.", None)]
    rows += [(f"q{i}", "x", "The state has an act and it shall see. " * 2, None) for i in range(30)]
    edits = [r.asDict() for r in S.traces(*tables(spark, rows)).where("kind = 'misread'").collect()]
    assert {(r["id"], r["a"], r["b"]) for r in edits} == {("g", "sha1l", "shall"), ("g", "0rder", "order")}
    assert S.repair("The registrar SHA1L hear, and the 0rder is valid.", edits) == "The registrar SHALL hear, and the order is valid."


def test_both_ways_of_picking_misread_words_agree(spark):
    rows = [*corpus(), ("a", "d", PAGE, [12]), ("g", "d", "The registrar sha1l hear, and the 0rder is valid.", None)]
    a, b = (sorted(tuple(r) for r in S.traces(*tables(spark, rows), broadcast_rows=n).collect()) for n in (500_000, 0))
    assert a == b and any(x[1] == "misread" for x in a)
