import numpy as np
import pytest

from lexgrain.llm import markup as M


@pytest.mark.parametrize(("text", "want"), [
    ("<p>Bail &amp; rent", ["html"]), ("plots < 105 sq. m. and > 2 acres, R & D, Form #90 under {Annexure 309}, US$ 40 and $ 5, file_ref_703, C:\\forms\\384, [2001] 2 SCC 5, x^2 > y, [sic]; ~10%", []),
    ("* Inserted by Act 5 of 1990.\n- one\n* two\n** three", []), ("## Savings\n\nText", ["markdown"]), ("a **b** [c](http://d)", ["markdown"]), ("**b", []), ("x **b", ["markdown"]), ("[[Levy|the]] plan", ["wiki"]), ("'''Levy''' and ''x''", ["wiki"]),
    ("== Savings ==\ntext", ["wiki"]), ("\\begin{quote}x\\end{quote}", ["latex"]), ("Fee: $f_{n} \\le 135$.", ["latex"]), ("M/s A & Co.", []), ("duty at 61\\% \\& cess", ["latex"]), ("", []), ("```json\n{}\n```", ["markdown"]), ("| a | b |\n|---|--:|\n| 1 | 2 |", ["markdown"]),
])
def test_forms(text, want):
    assert M.languages(text) == want


def test_cleaning():
    c = lambda t: M.clean(t, M.languages(t))
    assert c("<h2>Rent</h2><ul><li>one<li>two</ul><p>a &lt; b</p>") == "## Rent\n\n- one\n- two\n\na < b"
    assert c("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>") == "a | b\n1 | 2"
    assert c("== Rent ==\n{| class=x\n! a !! b\n|-\n| 1 || 2\n|}\nSee [[X|y]].") == "## Rent\na | b\n1 | 2\nSee y."
    assert c("# T\n\n**b** `c` [d](e)\n\n| a | b |\n|---|---|\n| 1 | 2 |") == "# T\n\nb c d\n\na | b\n1 | 2"
    assert c("\\section*{Rent}\n\\begin{enumerate}\n\\item one\n\\item two\n\\end{enumerate}\n$I = \\frac{P}{2}$ at 5\\%") == "## Rent\n\n- one\n- two\n$I = \\frac{P}{2}$ at 5%"
    assert c("<pre><code>if x:\n  y</code></pre>") == "    if x:\n      y"


def test_gradients():
    r = np.random.default_rng(1)
    m = M.Labeller({k: v.astype(np.float64) for k, v in M.Labeller.fresh(5).w.items()})
    seqs = [r.standard_normal((n, M.DIMS)).astype(np.float32) * 0.3 for n in (4, 2)]
    lang, kind = [(r.random((len(s), 4)) > 0.5).astype(np.float32) for s in seqs], [r.integers(0, 6, len(s)) for s in seqs]
    _, g = m.step(seqs, lang, kind)

    def loss():
        lens = np.array([4, 2])
        x = np.zeros((4, 2, M.DIMS), np.float32)
        for j, s in enumerate(seqs):
            x[: len(s), j] = s
        z = m.logits(x, lens).astype(np.float64)
        total = 0.0
        for j, s in enumerate(seqs):
            for t in range(len(s)):
                p = 1 / (1 + np.exp(-z[t, j, :4]))
                w = 1 + lang[j][t]
                total -= (w * (lang[j][t] * np.log(p) + (1 - lang[j][t]) * np.log(1 - p))).sum()
                e = z[t, j, 4:]
                total -= e[kind[j][t]] - np.log(np.exp(e).sum())
        return total / 6

    for k in ("hf", "xb", "o", "bb"):
        at = tuple(r.integers(0, n) for n in m.w[k].shape)
        old, eps = m.w[k][at], 2e-2
        m.w[k][at] = old + eps
        up = loss()
        m.w[k][at] = old - eps
        down = loss()
        m.w[k][at] = old
        assert (up - down) / (2 * eps) == pytest.approx(g[k][at], abs=2e-3)


CLEAN = ["The tenant paid rent to the landlord\nThe appeal is allowed with costs\nSection twelve applies to the lease of the premises\nNo order is made\nThe bench heard both sides"] * 3


def test_training_learns():
    model = M.train(CLEAN, documents=1500, epochs=8, hidden=12, batch=32, rate=8e-3)
    docs = list(M.planted(CLEAN, 200, 5))
    recall, precision = M.score(model, docs)
    assert recall > 0.85 and precision > 0.85


def test_shipped_weights_decide_on_documents_made_from_other_text():
    docs = list(M.planted(CLEAN, 1500, 6))
    model = M.Labeller.load()
    want = [{k for i, k in enumerate(M.LANGUAGES) if lang[:, i].any()} for _, _, lang, _ in docs]
    plain = [set(M.languages(t)) for t, _, _, _ in docs]
    forms_alone = sum(len(a & b) for a, b in zip(plain, want)) / sum(map(len, plain))
    recall, precision = M.score(model, docs)
    assert recall >= 0.98 and precision >= 0.97 and precision > forms_alone
    assert min(M.score(model, docs, hide=True)) > 0.9  # the named forms aren't the final word


def test_labels_of_plants_are_where_they_were_put():
    for text, spans, lang, kind in M.planted(CLEAN, 100, 7):
        assert len(spans) == len(lang) == len(kind)
        for (a, e), x in zip(spans, lang):
            assert not x.any() or set(text[a:e]) & set("<>&*_#[]{}|\\=`~$'-")


def test_batches_do_not_matter():
    m = M.Labeller.load()
    texts = ["a <b>c</b>. d; e", "x", "one\ntwo\nthree **four**", "y " * 3000 + "\n" + "z. " * 900]
    seqs = [M.vectors(t, M.blocks(t)) for t in texts]
    for one, many in zip((m.label([s])[0] for s in seqs), m.label(seqs)):
        assert np.allclose(one, many, atol=1e-4)


def test_table(spark):
    rows = [("1", "<p>x</p>", 0), ("1", "<p>x</p>", 0), ("2", None, 0), ("3", "", 0), ("4", "plain", 0), (None, "a **b** c", 0), ("5", "< > & * _ [ ] ^", 0)]
    df = spark.createDataFrame(rows, "id string, text string, languages int")
    got = sorted((str(r["id"]), tuple(r["languages"]), str(r["text"])) for r in M.residue(df, ["id"], "text", all_rows=True).collect())
    assert got == sorted([("1", ("html",), "x"), ("1", ("html",), "x"), ("2", (), "None"), ("3", (), ""), ("4", (), "plain"), ("None", ("markdown",), "a b c"), ("5", (), "< > & * _ [ ] ^")])
    assert M.residue(df.limit(0), ["id"], "text").count() == 0
