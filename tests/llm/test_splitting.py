import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexgrain.llm import splitting as S


def check(text, limit, overlap):
    p = S.pieces(text, limit, overlap)
    if not text:
        assert p == []
        return p
    assert p[0][0] == 0 and p[-1][1] == len(text)
    assert all((b - a) // 4 <= limit for a, b in p)
    for (a, b), (c, d) in zip(p, p[1:]):
        assert a < c and d > b and 4 * overlap <= b - c <= 4 * overlap + 40
    return p


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab. \n।é\fक"), max_size=900), st.integers(0, 6))
def test_invariants(text, overlap):
    check(text, 40, overlap)


def test_topic_boundary_is_cut():
    r = random.Random(2)
    say = lambda words: " ".join(r.choice(words) for _ in range(8)).capitalize() + ". "
    a = "".join(say(["rivers", "water", "boats", "fishing", "banks", "floods"]) for _ in range(9))
    b = "".join(say(["orchard", "apples", "harvest", "trees", "pruning", "cider"]) for _ in range(14))
    limit = (len(a) + 200) // 4
    assert S.pieces(a + b, limit, 10)[0][1] == len(a)


def test_no_boundary_and_bad_limits():
    assert len(check("x" * 5000, 100, 20)) > 10
    with pytest.raises(ValueError):
        S.pieces("x", 30, 20)


def test_table(spark):
    big = "A sentence of words. " * 40
    rows = [("s", "1", big, 5), ("s", "1", big, 5), ("c", "1", big, 5), ("s", "2", "short", 5), ("s", "3", None, 5), ("s", "4", "", 5), (None, "5", big, 5)]
    df = spark.createDataFrame(rows, "rec string, rec_id string, text string, piece int")
    got = S.split_oversized(df, ["rec", "rec_id"], "text", limit=100, overlap=10)
    ids = {(r["rec"], r["rec_id"]) for r in got.collect()}
    assert ids == {("s", "1"), ("c", "1"), (None, "5")}
    one = sorted((r["start"], r["length"], r["text"]) for r in got.where("rec = 's'").collect())
    assert [(a, a + n) for a, n, _ in one] == S.pieces(big, 100, 10) and all(big[a : a + n] == t for a, n, t in one)
    assert S.split_oversized(df.limit(0), ["rec", "rec_id"], "text").count() == 0
