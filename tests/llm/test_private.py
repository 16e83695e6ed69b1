import pytest

from lexgrain.llm import private as P

NAMES = P.Names({"Farida", "Ganesh", "Hemant", "Hemu"}, {f"{a}{b}" for a in ("Mri", "Tru", "Pra", "Yuna", "Vapu", "Chi", "Kru", "Dri") for b in ("mutti", "gundam", "lekar")})


def items(text):
    return [(s.kind, text[s.start : s.end]) for s in P.find(text, NAMES)]


@pytest.mark.parametrize(("text", "want"), [
    ("write to a.b+c7@mail.example.org now", [("email", "a.b+c7@mail.example.org")]),
    ("write to ram [at] mail [dot] example [dot] org or om @ lawdesk.test", [("email", "ram [at] mail [dot] example [dot] org"), ("email", "om @ lawdesk.test")]),
    ("see note @ page 897.", []),
    ("Phone: +91-55508 11819, call 0555-7145222 or (0555) 501 5935 or 0091 555 255 6265", [("phone", "+91-55508 11819"), ("phone", "0555-7145222"), ("phone", "(0555) 501 5935"), ("phone", "0091 555 255 6265")]),
    ("दूरभाष: +९१-५५५०१ ११४०१", [("phone", "+९१-५५५०१ ११४०१")]),
    ("Challan 5867297144 dated 3 May", []),
    ("identity number 0200 6788 0747 and PAN: KJMXQ4320F", [("id_number", "0200 6788 0747"), ("id_number", "KJMXQ4320F")]),
    ("Diary No. 7559 6482 1400 was assigned", []),
    ("Address for service: H.No. 697/4, Tank Cross, Suraksha Layout, Phulwadi 002627. Go", [("address", "H.No. 697/4, Tank Cross, Suraksha Layout, Phulwadi 002627")]),
    ("resides at Door No 8-22,\nGrove Street,\nSarkheda-064675 and", [("address", "Door No 8-22,\nGrove Street,\nSarkheda-064675")]),
    ("Complaint of Sri FARIDA KRULEKAR against", [("name", "FARIDA KRULEKAR")]),
    ("signed by Primutti, Ganesh, s/o HEMANT K. TRUGUNDAM, on", [("name", "Primutti, Ganesh"), ("name", "HEMANT K. TRUGUNDAM")]),
    ("Smt. L.B. Drilekar, r/o", [("name", "L.B. Drilekar")]),
    ("The Mrimutti Memorial Trust and Mrimutti & Sons Ltd.", []),
    ("Dr. Chigundam is absent. As told by hemu yunalekar over", [("name", "Chigundam"), ("name", "hemu yunalekar")]),
])
def test_items(text, want):
    assert items(text) == want


def test_checksums():
    assert P.luhn("4539578763621486") and not P.luhn("4539578763621487") and not P.luhn("")
    assert P.mod97("GB82WEST12345698765432") and not P.mod97("GB82WEST12345698765433")
    assert P.verhoeff("2363") and not P.verhoeff("2364")
    assert items("card 4539 5787 6362 1486 used") == [("id_number", "4539 5787 6362 1486")] and items("number 4539 5787 6362 1487 used") == []


def test_redaction_keeps_the_rest():
    t = "Contact: Farida Mrimutti, Tel +91 5559668387; a@b.co. End"
    assert P.redact(t, P.find(t, NAMES)) == "Contact: [NAME], Tel [PHONE]; [EMAIL]. End"


def test_long_text_is_read_to_its_end():
    t = "Nothing here. " * 20_000 + "call +91 5559668387"
    assert items(t) == [("phone", "+91 5559668387")]


def test_table(spark):
    df = spark.createDataFrame([(1, "mail a@b.co", 0), (1, "mail a@b.co", 0), (2, None, 0), (3, "", 0), (None, "x", 0)], "doc_id long, text string, kind int")
    rows = P.personal_information(df, "doc_id", "text", {"Farida"}, set()).collect()
    assert sorted((str(r["id"]), str(r["redacted"]), len(r["items"])) for r in rows) == [("1", "mail [EMAIL]", 1), ("1", "mail [EMAIL]", 1), ("2", "None", 0), ("3", "", 0), ("None", "x", 0)]
    assert P.personal_information(df.limit(0), "doc_id", "text", set(), set()).count() == 0
