import os
import random

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from lexgrain.llm import lexicon as L
from lexgrain.llm import packing as K

RANKS = os.path.join(L.TOKENIZERS, "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary files")


@pytest.fixture(scope="module")
def ranks():
    return L.read_ranks(RANKS)


@pytest.fixture(scope="module")
def plain(ranks):
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=L.SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_merge_is_exact(text):
    import tiktoken

    r = L.read_ranks(RANKS) if not hasattr(test_merge_is_exact, "r") else test_merge_is_exact.r
    test_merge_is_exact.r = r
    if not hasattr(test_merge_is_exact, "e"):
        test_merge_is_exact.e = tiktoken.Encoding("plain", pat_str=L.SPLIT, mergeable_ranks=r, special_tokens={}).encode_ordinary
    assert [i for w in regex.findall(L.SPLIT, text) for i in L.merge(w.encode(), r)] == test_merge_is_exact.e(text)


def test_transducer():
    r = random.Random(1)
    words = {bytes(r.choices(b"abc", k=r.randrange(1, 7))): [r.randrange(99) for _ in range(r.randrange(1, 4))] for _ in range(300)} | {"क".encode(): [7]}
    t = L.Transducer.compile(words)
    asked = [*words, b"", b"zzz", b"abcabcabcabc", b"\xff"]
    places = t.places(asked)
    assert all(t.lookup(p) == words[w] if w in words else p == -1 for w, p in zip(asked, places))
    assert len(t.final) < sum(map(len, words))  # suffixes are shared
    assert list(L.Transducer.compile({}).places([b"a"])) == [-1]


def test_corpus(spark, plain):
    texts = ["The law of the land.", "", None, "<|endoftext|> x", "का  कानून\r\n\t1234 5", "  ", "a" * 3000, "The law of the land.", "naïve\x00🙂🙂"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(None, "x", "z")], "doc_id long, text string, ids string")
    for size in (0, 3, 1000):
        got = {r["id"]: list(r["ids"]) for r in L.encode(df, "doc_id", "text", lexicon_size=size).collect()}
        assert got == {i: plain(t) if t else [] for i, t in enumerate(texts)} | {None: plain("x")}
    n = {r["id"]: r["tokens"] for r in L.encode(df, "doc_id", "text", count_only=True).collect()}
    assert n[0] == len(plain(texts[0])) and n[1] == 0 and n[2] == 0
    assert L.encode(df.limit(0), "doc_id", "text").count() == 0


def slow_best_fit(sizes, cap):
    rooms, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = [(r, -j) for j, r in enumerate(rooms) if r >= sizes[i]]
        if fit:
            j = -min(fit)[1]
        else:
            rooms.append(cap)
            j = len(rooms) - 1
        rooms[j] -= sizes[i]
        out[i] = j
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_needs_as_few_bins_as_the_plain_one(sizes):
    fast, slow = K.best_fit_decreasing(sizes, 50), slow_best_fit(sizes, 50)
    load = {}
    for s, b in zip(sizes, fast):
        load[b] = load.get(b, 0) + s
    assert all(v <= 50 for v in load.values()) and len(set(fast)) == len(set(slow))


def test_pack(spark):
    r = random.Random(3)
    sizes = [(i, r.randrange(1, 130)) for i in range(400)] + [(900, 0), (901, None), (None, 5), (5, 1), (902, 100), (903, 200), (904, 250)]
    df = spark.createDataFrame(sizes, "id long, size int")
    want = {}
    for i, s in sizes:
        if i is not None and s:
            want[i] = max(want.get(i, 0), s)
    rows = K.pack(df, "id", "size", 100, group_rows=100).collect()
    assert all(x["used"] <= 100 and x["used"] == sum(p["size"] for p in x["parts"]) for x in rows)
    assert len({x["container"] for x in rows}) == len(rows)
    spans = {}
    for x in rows:
        assert list(x["doc_ids"]) == [p["doc_id"] for p in x["parts"]]
        for p in x["parts"]:
            spans.setdefault(p["doc_id"], []).append((p["start"], p["start"] + p["size"]))
    for i, s in want.items():
        got = sorted(spans[i])
        assert got[0][0] == 0 and got[-1][1] == s and all(a[1] == b[0] for a, b in zip(got, got[1:])) and len(got) == -(-s // 100)
    assert set(spans) == set(want)
    assert K.pack(df.limit(0), "id", "size", 100).count() == 0
