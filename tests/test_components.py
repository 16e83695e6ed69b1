import random

from lexgrain.operators.components import connected_components


def plain(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def test_random_chain_star_and_loops(spark):
    r = random.Random(5)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(300, 300), (None, 5), (7, None)] * 2
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {x["node"]: x["component"] for x in connected_components(df).collect()} == plain(edges)


def test_text_nodes_and_empty(spark):
    df = spark.createDataFrame([("b", "c"), ("a", "b"), ("x", "y")], "src string, dst string")
    assert {x["node"]: x["component"] for x in connected_components(df).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    assert connected_components(df.limit(0)).count() == 0
