from lexgrain.plans import corpus


def test_no_part_exceeds_the_limit_and_no_text_is_lost(spark, tmp_path):
    rows = [("d", "s1", 1, 4, 0, "section", "a" * 7000), ("d", "s2", 2, 3, 1, "subsection", "b" * 100), ("d", "s3", 3, 3, 2, "clause", "c" * 6500), ("d", "s4", 4, 4, 1, "proviso", "p" * 50), ("d", "s5", 5, 6, 0, "section", "x" * 10), ("d", "s6", 6, 6, 5, "subsection", "y" * 10)]
    spark.createDataFrame(rows, "document_id string, section_id string, ord int, last_desc int, parent_ord int, level string, text string").write.parquet(str(tmp_path / "sections.parquet"))
    got = {(r["section"], r["piece"], r["part"]): r["text"] for r in corpus.statute_pieces(spark, str(tmp_path)).collect()}
    assert {k: len(v) for k, v in got.items()} == {(1, 0, 0): 6000, (1, 0, 1): 1000, (1, 1, 0): 6000, (1, 1, 1): 650, (5, 0, 0): 20}
    assert "".join(got[k] for k in sorted(got) if k[0] == 1) == "".join(r[6] for r in rows[:4])
