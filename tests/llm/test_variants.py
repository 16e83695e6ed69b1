import pytest

from lexgrain.llm import variants as V

STATES = ["Varunapur", "Gandharva", "Mokshapur"]
ACT = V.act_parts(STATES)
GIVEN = {"hemant": "hemant", "hemu": "hemant", "aravind": "aravind", "tarun": "tarun"}
JUDGE = V.judge_parts(GIVEN)
FORMS = [("AIR", "All India Reporter", "reporter"), ("SCC", "Supreme Court Cases", "reporter"), ("SC", "Supreme Court", "court"), ("Var", "Varunapur", "court"), ("Mok", "Mokshapur", "court")]


def act(name, number=None, year=None, place=None):
    return ACT(name, number, year, place)[0]


BASE = act("The Gandharva Electricity Inspection (Procedure) Act, 1990", "864/1990")


@pytest.mark.parametrize("other", [
    ("GANDHARVA ELECTRIICTY INSPESTION (PROCEDURE) ACT 1990",), ("Electricity Inspection (Procedure) Act, 1990 (Gandharva)", "No 864"), ("Act of 1990: Inspection of Electricity (Procedure), Gandharva",),
    ("Gandharva Elec. Inspec. (Pro.) Act, '90",), ("G.E.I.P.A., 1990", None, None, "Gandharva"), ("GEIPA 1990",), ("The Electricity Inspection (Procedure) Act", None, 1990, "Gandharva"),
])
def test_same_act(other):
    assert V.same_act(BASE, act(*other)) and V.same_act(act(*other), BASE)


@pytest.mark.parametrize("other", [
    ("The Gandharva Electricity Inspection (Procedure) Act, 1991",), ("The Mokshapur Electricity Inspection (Procedure) Act, 1990",), ("The Electricity Inspection (Procedure) Act, 1990",),
    ("The Gandharva Electricity Inspection (Procedure) Act, 1990", "865/1990"), ("The Gandharva Excise Inspection (Procedure) Act, 1990",), ("The Gandharva Electricity Inspection (Supplementary) Act, 1990",),
])
def test_other_act(other):
    assert not V.same_act(BASE, act(*other)) and not V.same_act(act(*other), BASE)


@pytest.mark.parametrize(("text", "want"), [
    ("A.I.R. (l961) Mok. 1639", ["air|mok|1961|1639"]), ("1961 AIR Mokshapur 1639 (DB)", ["air|mok|1961|1639"]), ("AIR '61 Mok 1639, para 14", ["air|mok|1961|1639"]), ("All India Reporter 1961 Mokshpaur 1639", ["air|mok|1961|1639"]),
    ("(1995) 8 Supreme Court Cases 7134", ["scc|1995|8|7134"]), ("SCC 1995 Vol. 8 p. 7134", ["scc|1995|8|7134"]), ("('95) 8 S.C.C. 7134.", ["scc|1995|8|7134"]), ("1957 S.C.C. OnLne Mok 1772", ["scc online|mok|1957|1772"]),
    ("2011 SCC OnLine Supreme Court 12468", ["scc online|sc|2011|12468"]), ("AIR 1965 Var. 1199; (1989) 2 SCC 1472", ["air|var|1965|1199", "scc|1989|2|1472"]), ("ibid.", []), ("-", []), ("", []), (None, []),
])
def test_citations(text, want):
    assert V.citation_keys(FORMS)(text) == want


def clusters(spark, names):
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    edges = V.judge_edges(V.parse(df, ["id", "name"], JUDGE), V._known(GIVEN))
    return {(r["left_id"], r["right_id"]) for r in V.pairs_within(edges).collect()}


def test_judges(spark):
    names = [
        "Hemant Hashayavun", "HASHAYAVUN HEMANT", "Hon'ble Mr. Justice Hemu Hasshayavun", "Hashayavun, Hemant", "H. Hashayavun", "Hemant Das Hashayavun",  # 0-5 one judge
        "Tarun Hashayavun", "Tarun K. Hashayavun", "Hashayavun J",  # 6-7 another; 8 fits both
        "Aravind Sibhutrusa", "Justice Sibutrusa", None, "", "J.",  # 9-10
        "Zubair Krukanaba", "Krookanaba Zubair", "K. Lone", "Lone K, J.", "Justice Lone",  # 14-15, 16-18
    ]
    one, two = {0, 1, 2, 3, 4, 5}, {6, 7}
    want = {(a, b) for g in (one, two, {9, 10}, {14, 15}, {16, 17, 18}) for a in g for b in g if a < b}
    assert clusters(spark, names) == want


def test_hot_spelling(spark):
    assert clusters(spark, ["Hemant Hashayavun"] * 40 + ["Hemu Hashayavun"]) == {(a, b) for a in range(41) for b in range(a + 1, 41)}


def test_judgments(spark):
    rows = [(1, "AIR 1961 Mok 1639", None), (2, "ibid.", ["A.I.R. (l961) Mokshapur 1639", None]), (3, "(1995) 8 SCC 7134", []), (4, None, ["('95) 8 S.C.C. 7134; 1961 AIR Mok 1639"]), (5, None, None), (None, "AIR 1961 Mok 1639", None)]
    df = spark.createDataFrame(rows, "judgment_id long, citation string, alt_citations array<string>")
    e = V.judgment_edges(df, "judgment_id", "citation", "alt_citations", FORMS)
    assert {tuple(r) for r in V.pairs_within(e).collect()} == {(a, b) for a in (1, 2, 3, 4) for b in (1, 2, 3, 4) if a < b}


def test_words():
    assert V.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4) and V.jaro_winkler("", "a") == 0
    assert V.one_edit("abcd", "abdc") and V.one_edit("abcd", "abd") and not V.one_edit("abcd", "badc")
    assert V.close("krookanaba", "krukanaba")


def test_empty(spark):
    assert clusters(spark, ["", None]) == set()
    df = spark.createDataFrame([], "judgment_id long, citation string, alt_citations array<string>")
    assert V.judgment_edges(df, "judgment_id", "citation", "alt_citations", FORMS).count() == 0
