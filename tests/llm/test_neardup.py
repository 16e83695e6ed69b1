import random
import re
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from lexgrain.llm import neardup as N

WORDS = [f"w{i}" for i in range(400)]


def corpus(seed=1):
    r = random.Random(seed)
    base = [[r.choice(WORDS) for _ in range(r.randrange(5, 90))] for _ in range(40)]
    out = []
    for i, b in enumerate(base):
        out.append((f"a{i:03}", " ".join(b)))
        for v in range(3):
            x = list(b)
            for _ in range(r.randrange(0, 1 + len(x) // 9)):
                p = r.randrange(len(x))
                x[p : p + r.randrange(0, 2)] = [r.choice(WORDS)]
            out.append((f"b{i:03}{v}", (", " if v else "\n").join(x).upper()))
    out += [("c1", None), ("c2", ""), (None, "w1 " * 50), ("c3", "same " * 40), ("c4", "same " * 44), ("c5", "w1 w2 w3 w4 w5 w6 w7"), ("c6", "w1 w2 w3 w4 w5 w6 w7"), ("c7", "नमस्ते " * 50)]
    return out + [("a000", dict(out)["a000"])]


def brute(rows, k, t, least):
    import re

    rows = {i: x for i, x in rows if i and x and len(re.findall("[a-z0-9]+", x.lower())) >= least}
    return {(a, b) for a, b in combinations(sorted(rows), 2) if N.similarity(rows[a], rows[b], k) >= t - 1e-12}


def test_pairs_are_those_of_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "id string, text string").withColumn("c", F.lit(1)).withColumn("cell", F.lit("x"))
    for k, t, least in ((3, 0.6, 5), (5, 0.8, 7)):
        links, members = N.near_duplicates(df, "id", "text", threshold=t, k=k, min_words=least)
        got = {(r["left"], r["right"]) for r in N.pairs_of_members(links, members).collect()}
        assert got == brute(rows, k, t, least)


def test_full_bitmap_gives_the_same(spark):
    df = spark.createDataFrame(corpus(2), "id string, text string")
    a = N.pairs_of_members(*N.near_duplicates(df, "id", "text", 0.6, 3, 30))
    b = N.pairs_of_members(*N.near_duplicates(df, "id", "text", 0.6, 3, 30, sketch_bits=14, bitmap_bits=15))
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


def test_classes_cover_every_id_and_hot_copies_stay_one(spark):
    rows = [(f"h{i}", "the same text of a hot group with more than ten words in it") for i in range(300)] + corpus(3)
    df = spark.createDataFrame(rows, "id string, text string")
    links, members = N.near_duplicates(df, "id", "text", 0.6, 3, 10)
    c = {r["id"]: (r["class"], r["links"]) for r in N.classes(links, members).collect()}
    assert {c[f"h{i}"][0] for i in range(300)} == {"h0"} and c["h7"][1] == 0
    assert len(c) == members.select("id").distinct().count()


def test_empty(spark):
    df = spark.createDataFrame([], "id string, text string")
    links, members = N.near_duplicates(df, "id", "text")
    assert links.count() == 0 and N.pairs_of_members(links, members).count() == 0 and N.classes(links, members).count() == 0


def test_hot_group_of_frequent_hashes_is_whole(spark):
    r = random.Random(5)
    base = [r.choice(WORDS) for _ in range(34)]
    group = [" ".join(r.choice(WORDS) if r.random() < 0.09 else w for w in base) for _ in range(700)]
    rows = [(f"h{i:03}", t) for i, t in enumerate(group)]
    runs = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in map(str.split, group)]
    want = {(rows[i][0], rows[j][0]) for i, j in combinations(range(700), 2) if 1.6 * len(runs[i] & runs[j]) >= 0.6 * (len(runs[i]) + len(runs[j])) - 1e-9}
    df = spark.createDataFrame(rows, "id string, text string")
    for bits in (20, 6):  # 6: every counter far above the bound
        got = {tuple(x) for x in N.pairs_of_members(*N.near_duplicates(df, "id", "text", 0.6, 3, 30, sketch_bits=bits)).collect()}
        assert got == want


def test_nothing_that_grows_is_broadcast(spark, monkeypatch):
    plans = []

    def cut(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.checkpoint(eager=True)

    from lexgrain.session import checkpoint_dir

    checkpoint_dir(spark)
    monkeypatch.setattr(N, "cut", cut)
    links, members = N.near_duplicates(spark.createDataFrame(corpus(6), "id string, text string"), "id", "text", 0.6, 3, 30)
    for df in (N.pairs_of_members(links, members), N.classes(links, members)):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
    assert len(plans) >= 5 and any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_cells_in_blocks_give_the_same(spark):
    df = spark.createDataFrame(corpus(7), "id string, text string")
    a = N.pairs_of_members(*N.near_duplicates(df, "id", "text", 0.6, 3, 30))
    b = N.pairs_of_members(*N.near_duplicates(df, "id", "text", 0.6, 3, 30, hot=2))
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


def test_cells_are_compared_in_place_and_texts_named_once(spark, monkeypatch):
    """A cell's texts meet within its task: the grid is no side of a join, and hashes
    that are seen often take no second pass over the texts."""
    plans = []

    def cut(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df.checkpoint(eager=True)

    from lexgrain.session import checkpoint_dir

    checkpoint_dir(spark)
    monkeypatch.setattr(N, "cut", cut)
    df = spark.createDataFrame(corpus(8) + [(f"h{i}", f"{'w1 w2 w3 ' * 9} w{i} w{i + 1} w{i + 2}") for i in range(60)], "id string, text string")
    links, members = N.near_duplicates(df, "id", "text", 0.6, 3, 30, sketch_bits=6, hot=50)
    N.pairs_of_members(links, members)
    assert not [p for p in plans if re.search(r"SortMergeJoin \[cell#", p)]
    assert len(re.findall("MapIn(?:Pandas|Arrow) cells", plans[0])) == 1


def test_cells_in_blocks_of_a_second_exchange_equal_brute_force(spark, monkeypatch):
    r = random.Random(9)
    base = [r.choice(WORDS) for _ in range(36)]
    rows = [(f"h{i:03}", " ".join(r.choice(WORDS) if r.random() < 0.06 else w for w in base)) for i in range(160)] + corpus(9)
    df = spark.createDataFrame(rows, "id string, text string")
    for bits in (20, 6):
        got = {tuple(x) for x in N.pairs_of_members(*N.near_duplicates(df, "id", "text", 0.6, 3, 30, sketch_bits=bits, hot=1)).collect()}
        assert got == brute(rows, 3, 0.6, 30)


def test_tiles_and_pair_lists_meet_the_same_pairs(monkeypatch):
    r = np.random.default_rng(3)
    rows = np.empty(700, N.ROW)
    rows["c"], rows["n"] = r.integers(-(2**62), 2**62, 700), r.integers(30, 200, 700)
    rows["left"] = np.where(r.random(700) < 0.2, -rows["n"], rows["n"] - (r.random(700) * 0.4 * rows["n"]).astype(int))
    rows["p"] = np.packbits(r.random((700, 256)) < 0.2, axis=1, bitorder="little").view("<u8")
    rows["p"][1::2] = rows["p"][::2]
    cell, one = np.sort(r.integers(0, 2, 700)), np.full(700, -1, np.int32)

    def met(tiled, cell, rows, side):
        monkeypatch.setattr(N, "TILED", tiled)
        monkeypatch.setattr(N, "TILE", (7, 50))
        out, i, j = N._near(cell, rows, side, 0.6)
        return {tuple(sorted((int(out["c"][a]), int(out["c"][b])))) for a, b in zip(i, j)}

    want = set()
    for x, y in combinations(range(700), 2):
        a, b, both = rows[x], rows[y], int(rows["n"][x]) + int(rows["n"][y])
        far = int(np.bitwise_count(a["p"] ^ b["p"]).sum())
        left = min(abs(int(a["left"])), abs(int(b["left"])))
        if cell[x] == cell[y] and 4 * far <= both and 8 * left >= 3 * both and 5 * min(a["n"], b["n"]) >= 3 * max(a["n"], b["n"]):
            want.add(tuple(sorted((int(a["c"]), int(b["c"])))))
    assert len(want) > 100 and met(2, cell, rows, one) == want == met(10**9, cell, rows, one)
    # each text once a cell, and sides that differ
    assert met(2, np.repeat(cell, 2), np.repeat(rows, 2), np.repeat(one, 2)) == want
    side = r.integers(0, 2, 700).astype(np.int32)
    of = dict(zip(rows["c"].tolist(), side.tolist()))
    assert met(2, cell, rows, side) == {p for p in want if of[p[0]] != of[p[1]]} == met(10**9, cell, rows, side)
