import numpy as np

from lexgrain.llm import vectors as V


def rows(seed=0, n=300):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, 64))
    for i in range(0, n, 10):
        x[i + 1 : i + 4] = x[i] + r.standard_normal((3, 64)) * r.uniform(0.05, 0.6)
    x *= r.uniform(1e-3, 1e3, (n, 1))
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]


def cosines(data):
    m = np.array([v for _, v in data], dtype=np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    return m @ m.T


BAD = [(1000, None), (1001, [0.0] * 64), (1002, [1.0] * 63), (1003, [float("nan")] + [1.0] * 63), (1004, [float("inf")] + [1.0] * 63), (None, [1.0] * 64)]


def test_pairs_equal_brute_force(spark):
    data = rows()
    c = cosines(data)
    want = {(i, j) for i in range(len(data)) for j in range(i + 1, len(data)) if c[i, j] >= 0.9}
    extra = [(2000, data[0][1]), (2000, data[0][1]), (2001, data[0][1])]
    df = spark.createDataFrame(data + BAD + extra, "id long, x array<float>")
    got = {(r["left"], r["right"]) for r in V.similar_pairs(df, "id", "x", 64, 0.9).collect()}
    near0 = {0} | {j for i, j in want if i == 0}
    assert got == want | {(min(a, b), max(a, b)) for a in (2000, 2001) for b in near0} | {(2000, 2001)}


def test_nearest_recall(spark):
    data = rows(4, 900)
    df = spark.createDataFrame(data + BAD, "id long, x array<float>")
    c = cosines(data)
    np.fill_diagonal(c, -9)
    got = {}
    for r in V.nearest(df, "id", "x", 64, "v % 50 = 0", k=10, block_rows=400, query_block=8).collect():
        got.setdefault(r["query"], {})[r["rank"]] = r["neighbour"]
    assert set(got) == {i for i in range(0, 900, 50)} | {1000} - {1000}
    hit = sum(len(set(np.argsort(-c[q])[:10]) & set(v.values())) for q, v in got.items())
    assert hit / (10 * len(got)) >= 0.9 and all(sorted(v) == list(range(1, 11)) for v in got.values())


def test_empty_and_single(spark):
    df = spark.createDataFrame([], "id long, x array<float>")
    assert V.similar_pairs(df, "id", "x", 64, 0.9).count() == 0 and V.nearest(df, "id", "x", 64, "true").count() == 0
    one = spark.createDataFrame([(0, [1.0] * 64)], "id long, x array<float>")
    assert V.similar_pairs(one, "id", "x", 64, 0.9).count() == 0 and V.nearest(one, "id", "x", 64, "true").count() == 0


def test_nearest_is_asked_for_both_kinds_of_vectors(spark, data):
    from lexgrain.llm import vectors

    assert {r["kind"] for r in vectors.p6_nearest(spark, data).selectExpr("query % 2 AS kind").distinct().collect()} == {0, 1}


def test_bit_counts_equal_plain_counts():
    r = np.random.default_rng(2)
    for n in (1, 65, 300):
        q = V.buckets(V.unit_rows(r.standard_normal((n, 16)).astype(np.float32)), V.lines(16, 20, 1))
        d = np.abs(q[:, None, :].astype(int) - q[None].astype(int))
        for (radius, need), sets in zip(((8, 6), (30, 15)), [V.colliding(V.Sorted(q), q, [8, 30], x) for x in (6, 15)]):
            got = set(zip(*map(np.ndarray.tolist, V.members(sets[0 if radius == 8 else 1]))))
            assert got == {tuple(x) for x in np.argwhere((d <= radius).sum(2) >= need).tolist()}


def test_many_blocks_and_parts_equal_brute_force(spark):
    data = rows(9, 600)
    # a common direction, so that signs alone would tell nothing
    data = [(i, [x + 40.0 * float(np.abs(v).max()) * (k == 3) for k, x in enumerate(v)]) if i % 3 == 0 else (i, v) for i, v in data]
    c = cosines(data)
    want = {(i, j) for i in range(len(data)) for j in range(i + 1, len(data)) if c[i, j] >= 0.9}
    df = spark.createDataFrame(data, "id long, x array<float>")
    got = {(r["left"], r["right"]) for r in V.similar_pairs(df, "id", "x", 64, 0.9, block_rows=100, most_rows=60).collect()}
    assert len(want & got) >= 0.999 * len(want) and got <= want
