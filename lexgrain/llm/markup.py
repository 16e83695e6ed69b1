"""Markup residue: a recurrent labeller of text blocks, and clean text.

A text is cut into leaf blocks (lines, long lines into sentences). Each block is a
vector of hashed words, hashed signs, the path of open elements, some measures of form
and the named forms that stand in it; a bidirectional LSTM (numpy) reads the whole
sequence of a document and labels every block with the markup languages of which it
holds residue and with its structure. The labels decide: a record has the languages
that some block of it is labelled with, and code that is labelled so stays as it is.

The weights beside this module were trained by :func:`train` on documents made from
clean text with planted marks (:mod:`lexgrain.llm.planted`), so labels are known by
construction and told by no pattern; nothing of the data is kept but the weights.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.llm.planted import document

LANGUAGES = ("html", "markdown", "wiki", "latex")
STRUCTURES = ("text", "heading", "list", "table", "code", "formula")
#: clean texts that training documents are made from, and documents made, at most
SAMPLE = 6000
DOCUMENTS = 30_000
#: a block is labelled with a language from this probability on
DECIDE = 0.5
WEIGHTS = Path(__file__).with_name("markup_weights.npz")

# ------------------------------------------------------------------ forms

# fixed values: names of HTML elements and of common character references
TAGS = (
    "html head body title meta link script style div span p br hr h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th td caption a b i u s "
    "em strong small big sub sup font center blockquote q cite code pre tt kbd samp var img form input label button select option textarea iframe section "
    "article header footer nav main aside figure figcaption address abbr del ins mark strike wbr col colgroup"
).split()
ENTITIES = (
    "amp lt gt quot apos nbsp ensp emsp thinsp ndash mdash lsquo rsquo sbquo ldquo rdquo bdquo hellip bull middot sect para copy reg trade deg plusmn times "
    "divide frac12 frac14 frac34 laquo raquo euro pound yen cent shy dagger larr rarr uarr darr"
).split()
FORMS = {
    "html": re.compile(
        rf"</?(?:{'|'.join(TAGS)})(?=[\s/>]|$)[^<>\n]*>?|<!--|-->|<!DOCTYPE|&(?:{'|'.join(ENTITIES)})(?![A-Za-z0-9])|&(?:[A-Za-z]{{2,8}}|#\d{{1,6}}|#[xX][0-9A-Fa-f]{{1,5}});"
        r"|&#\d{2,6}\b|(?<![{|\w])\b(?:class|style|href|src|title|border|align)=[\"']",
        re.I,
    ),
    "markdown": re.compile(
        r"^ {0,3}#{1,6}[ \t]+\S|\*\*(?=[^\s*])(?<!\n\*\*)(?<!\A\*\*)|(?<=[^\s*])\*\*|(?<![\w])__(?=[^\W_])(?![A-Z]+__)|(?<=[a-z])__(?!\w)|\]\(|^\[[^\]\n]+\]:\s*\S|\]\[|```|^~~~"
        r"|(?<!`)`[^`\n]+`(?!`)|^-{3,}\s*$|^\s*\|?\s*:?-{2,}:?\s*\|[\s:|-]*$|^={4,}\s*$|^>\s+(?=[A-Z*])|~~(?=\S)|(?<=\S)~~|\[\^\w+\]|^\s*[-*+] \[[ xX]\]|!\[",
        re.M,
    ),
    "wiki": re.compile(
        r"\[\[|\]\]|\{\{|\}\}|'{2,}(?=\w)|(?<=\w)'{2,}|^(={2,6})[^=\n]+\1?\s*$|^\{\||^\|-(?!-)|^\|\}|^![^!\n]+!!|(?<!!)\[https?://\S+[ \]]|<ref|</ref|</?nowiki|__[A-Z]+__|^\|[^|\n]+\|\||#REDIRECT",
        re.M,
    ),
    "latex": re.compile(r"(?<![:\w\\])\\[a-zA-Z]+\*?(?![\\\w])|(?<=[\w.,;:)}$])\\[a-zA-Z]{2,}\*?(?![\\\w])|\\[%&$#_{}~]|\\\\(?=\s|\[|$)|\$(?=[^\s\d$])[^$\n]*[\\^_=][^$\n]*\$?|(?<!`)``(?!`)|\\S\b|\bS~\d", re.M),
}
#: a text without any of these signs holds no form of any language
SIGNS = r"[<>&*_#\[\]{}|\\=`~$]|''|---"


def languages(text: str) -> list[str]:
    """Languages of which a form stands in the text."""
    return [k for k, form in FORMS.items() if form.search(text)]


# ----------------------------------------------------------------- blocks

SPLIT = re.compile(r"\n|(?<=[.;:।])[ \t]+(?=\S)")
TOKENS = re.compile(
    r"[A-Za-z]:(?:\\[\w.$-]+)+|\\\\\w+(?:\\[\w.$-]+)+|<?[\w.+-]+@[\w.-]+>?|https?://[^\s\])>|]+|\\[a-zA-Z]+|\\[^\sa-zA-Z]?|</?[a-zA-Z][a-zA-Z0-9]*|&#?\w+;?|!\[|\]\(|\[\[|\]\]|\{\{|\}\}|\{\||\|-+|\|\}|'{2,}|[#*=`~|^_$<>{}\[\]&-]+|[^\W\d_]+|\d+"
)
OPEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)|\\(begin|end)\{(\w+)|(```)|(\{\||\|\})")
WORD_DIMS, SIGN_DIMS, PATH_DIMS = 32, 128, 16
DIMS = WORD_DIMS + SIGN_DIMS + PATH_DIMS + 12 + len(LANGUAGES)


def blocks(text: str) -> list[tuple[int, int]]:
    """Spans of the leaf blocks; the blanks between belong to none."""
    out, at = [], 0
    for m in SPLIT.finditer(text):
        if text[at : m.start()].strip():
            out.append((at, m.start()))
        at = m.end()
    if text[at:].strip():
        out.append((at, len(text)))
    return out


def forms(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which named forms stand in each block."""
    out = np.zeros((len(spans), len(LANGUAGES)), np.float32)
    starts = np.array([a for a, _ in spans])
    for k, name in enumerate(LANGUAGES if len(spans) else ()):
        for m in FORMS[name].finditer(text):
            out[max(0, int(np.searchsorted(starts, m.start(), "right")) - 1), k] = 1
    return out


_SLOT: dict[str, int] = {}


def _name(token: str) -> str:
    """Places, addresses and long runs of a sign under one name each."""
    c = token[0]
    if "@" in token:
        return "<>@" if c == "<" else "@"
    if token[1:3] == ":\\" or token[:2] == "\\\\" and len(token) > 2:
        return "\\path"
    if "://" in token:
        return "://"
    if c.isalpha():
        return token.lower()
    if c.isdigit():
        return "0"
    if token[:2] == "&#":
        return "&#;" if token[-1] == ";" else "&#"
    if len(token) > 4 and token == c * len(token):
        return c * 4
    return token.lower()


def _slot(token: str) -> int:
    s = _SLOT.get(token)
    if s is None:
        if len(_SLOT) > 200_000:
            _SLOT.clear()
        h = xxhash.xxh32_intdigest(token)
        word = token[0].isalnum()
        s = _SLOT[token] = (h % WORD_DIMS) if word else WORD_DIMS + h % SIGN_DIMS
    return s


def vectors(text: str, spans: list[tuple[int, int]]) -> np.ndarray:
    x = np.zeros((len(spans), DIMS), np.float32)
    path: list[str] = []
    base = WORD_DIMS + SIGN_DIMS + PATH_DIMS
    for r, (a, b) in enumerate(spans):
        t = text[a:b]
        row = x[r]
        tokens = TOKENS.findall(t)
        for w in tokens:
            row[_slot(_name(w))] += 1
        for p in path:
            row[WORD_DIMS + SIGN_DIMS + xxhash.xxh32_intdigest(p) % PATH_DIMS] = 1
        for m in OPEN.finditer(t):
            name = (m[2] or m[4] or m[5] or "{|").lower()
            closing = m[1] == "/" or m[3] == "end" or m[6] == "|}" or (m[5] and name in path)
            if closing:
                if name in path:
                    del path[len(path) - 1 - path[::-1].index(name) :]
            elif name not in ("br", "hr", "img", "input", "meta", "link", "wbr", "col"):
                path.append(name)
                del path[:-8]
        s = t.strip()
        row[base : base + 12] = (
            min(len(t), 400) / 200, len(tokens) / 20, s.isupper(), s[:1] in "-*+", s[:1] == "#", s[:1] == ">", s[:1] in "=|!{", s[:1] == "\\",
            s[:1] == "<", a == 0 or text[a - 1] == "\n", b == len(text) or text[b : b + 1] == "\n", len(set(s)) == 1,
        )
    np.log1p(x[:, : WORD_DIMS + SIGN_DIMS], out=x[:, : WORD_DIMS + SIGN_DIMS])
    x[:, base + 12 :] = forms(text, spans)
    return x


# ------------------------------------------------------------------ model


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a linear layer: four language logits, six
    structure logits for each block."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w = {k: v.astype(np.float32) for k, v in w.items()}

    @classmethod
    def load(cls, path: Path = WEIGHTS) -> Labeller:
        with np.load(path) as z:
            return cls({k: z[k] for k in z.files})

    @classmethod
    def fresh(cls, hidden: int = 24, seed: int = 3) -> Labeller:
        r = np.random.default_rng(seed)
        n = lambda *s: r.standard_normal(s) / np.sqrt(s[0])
        w = {}
        for d in "fb":
            w[f"x{d}"], w[f"h{d}"], bias = n(DIMS, 4 * hidden), n(hidden, 4 * hidden), np.zeros(4 * hidden)
            bias[hidden : 2 * hidden] = 1
            w[f"b{d}"] = bias
        w["o"], w["c"] = n(2 * hidden + DIMS, len(LANGUAGES) + len(STRUCTURES)) * 0.5, np.zeros(len(LANGUAGES) + len(STRUCTURES))
        return cls(w)

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """x: (time, batch, DIMS) -> hidden states in the given order of time."""
        hid = self.w[f"h{d}"].shape[0]
        z = (x.reshape(-1, x.shape[2]) @ self.w[f"x{d}"] + self.w[f"b{d}"]).reshape(x.shape[0], x.shape[1], -1)
        h = c = np.zeros((x.shape[1], hid), np.float32)
        out = np.zeros((x.shape[0], x.shape[1], hid), np.float32)
        for t in range(x.shape[0]):
            g = z[t] + h @ self.w[f"h{d}"]
            i, f, o, u = _sigmoid(g[:, :hid]), _sigmoid(g[:, hid : 2 * hid]), _sigmoid(g[:, 2 * hid : 3 * hid]), np.tanh(g[:, 3 * hid :])
            prev_h, prev_c = h, c
            c = f * c + i * u
            h = o * np.tanh(c)
            out[t] = h
            if keep is not None:
                keep.append((i, f, o, u, c, prev_c, prev_h))
        return out

    @staticmethod
    def _flip(x: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Each sequence backwards within its own length."""
        t = np.arange(x.shape[0])[:, None]
        at = np.where(t < lens, lens - 1 - t, t)
        return np.take_along_axis(x, at[:, :, None], 0)

    def logits(self, x: np.ndarray, lens: np.ndarray, keep: dict | None = None) -> np.ndarray:
        kf, kb = ([], []) if keep is not None else (None, None)
        back = self._flip(x, lens)
        hf, hb = self._run(x, "f", kf), self._flip(self._run(back, "b", kb), lens)
        top = np.concatenate((hf, hb, x), axis=2)
        if keep is not None:
            keep.update(f=kf, b=kb, back=back, top=top)
        return top @ self.w["o"] + self.w["c"]

    def label(self, seqs: list[np.ndarray], batch: int = 256) -> list[np.ndarray]:
        """Logits of each sequence; sequences of similar length run together."""
        out: list[np.ndarray | None] = [None] * len(seqs)
        order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
        at = 0
        while at < len(order):
            # long sequences in smaller batches, so that memory stays bounded
            n = max(1, min(batch, 60_000 // max(1, len(seqs[order[min(at + batch, len(order)) - 1]]))))
            part = order[at : at + n]
            at += n
            lens = np.array([len(seqs[i]) for i in part])
            x = np.zeros((max(1, lens.max()), len(part), DIMS), np.float32)
            for j, i in enumerate(part):
                x[: lens[j], j] = seqs[i]
            z = self.logits(x, lens)
            for j, i in enumerate(part):
                out[i] = z[: lens[j], j]
        return out

    def step(self, seqs: list[np.ndarray], langs: list[np.ndarray], structs: list[np.ndarray]) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of one batch (backpropagation through time)."""
        lens = np.array([len(s) for s in seqs])
        n, b, nl = lens.max(), len(seqs), len(LANGUAGES)
        x = np.zeros((n, b, DIMS), np.float32)
        want, mask = np.zeros((n, b, nl + len(STRUCTURES)), np.float32), np.zeros((n, b, 1), np.float32)
        for j, s in enumerate(seqs):
            x[: len(s), j], want[: len(s), j, :nl], mask[: len(s), j] = s, langs[j], 1
            want[np.arange(len(s)), j, nl + structs[j]] = 1
        keep: dict = {}
        z = self.logits(x, lens, keep)
        p = _sigmoid(z[:, :, :nl])
        e = np.exp(z[:, :, nl:] - z[:, :, nl:].max(axis=2, keepdims=True))
        q = e / e.sum(axis=2, keepdims=True)
        total = mask.sum()
        weight = 1 + want[:, :, :nl]
        loss = -(weight * (want[:, :, :nl] * np.log(p + 1e-7) + (1 - want[:, :, :nl]) * np.log(1 - p + 1e-7)) * mask).sum() / total
        dz = np.concatenate((weight * (p - want[:, :, :nl]), q - want[:, :, nl:]), axis=2) * mask / total
        g = {"o": np.einsum("tbi,tbj->ij", keep["top"], dz), "c": dz.sum((0, 1))}
        dtop = dz @ self.w["o"].T
        hid = self.w["hf"].shape[0]
        for d, dh_all, xin in (("f", dtop[:, :, :hid], x), ("b", self._flip(dtop[:, :, hid : 2 * hid], lens), keep["back"])):
            gx, gh, gb = np.zeros_like(self.w[f"x{d}"]), np.zeros_like(self.w[f"h{d}"]), np.zeros_like(self.w[f"b{d}"])
            dh, dc = np.zeros((b, hid), np.float32), np.zeros((b, hid), np.float32)
            for t in range(n - 1, -1, -1):
                i, f, o, u, c, pc, ph = keep[d][t]
                dh = dh + dh_all[t]
                tc = np.tanh(c)
                dc = dc + dh * o * (1 - tc * tc)
                da = np.concatenate((dc * u * i * (1 - i), dc * pc * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)), axis=1)
                gx += xin[t].T @ da
                gh += ph.T @ da
                gb += da.sum(0)
                dh, dc = da @ self.w[f"h{d}"].T, dc * f
            g |= {f"x{d}": gx, f"h{d}": gh, f"b{d}": gb}
        return float(loss), g


def planted(clean: list[str], n: int, seed: int) -> Iterator[tuple[str, list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """n documents (text, blocks, languages and structure of each block)."""
    r = random.Random(seed)
    for _ in range(n):
        lines = document(r, r.choice(clean).split("\n"))
        text = "\n".join(x for x, _, _ in lines)
        ends = np.cumsum([len(x) + 1 for x, _, _ in lines])
        spans = blocks(text)
        lang, kind = np.zeros((len(spans), len(LANGUAGES)), np.float32), np.zeros(len(spans), np.int64)
        for i, (a, e) in enumerate(spans):
            _, k, form = lines[int(np.searchsorted(ends, a, "right"))]
            kind[i] = STRUCTURES.index(form)
            # of a line in several blocks, those without any sign are plain
            if k and re.search(r"[<>&*_#\[\]{}|\\=`~$]|''|---", text[a:e]):
                lang[i, LANGUAGES.index(k)] = 1
        if spans:
            yield text, spans, lang, kind


def train(clean: list[str], documents: int = DOCUMENTS, epochs: int = 10, batch: int = 64, rate: float = 4e-3, seed: int = 3, hidden: int = 24, unseen: float = 0.3) -> Labeller:
    """Fit a labeller (Adam) on ``documents`` documents made from at most ``SAMPLE``
    clean texts. In a share ``unseen`` of them the named forms are hidden, so that
    words, signs and context must do without."""
    data, rng = [], np.random.default_rng(seed)
    for text, spans, lang, kind in planted(clean[:SAMPLE], documents, seed):
        x = vectors(text, spans)
        if rng.random() < unseen:
            x[:, -len(LANGUAGES) :] = 0
        data.append((x, lang, kind))
    model = Labeller.fresh(hidden, seed)
    m, v, n = {k: 0.0 for k in model.w}, {k: 0.0 for k in model.w}, 0
    for epoch in range(epochs):
        order = sorted(range(len(data)), key=lambda i: len(data[i][0]) + rng.random())
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for g in rng.permutation(len(groups)):
            _, grad = model.step(*zip(*(data[i] for i in groups[g])))
            n += 1
            lr = rate * 0.5 ** max(0, epoch - epochs // 2 + 1)
            for k, d in grad.items():
                d = np.clip(d, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                model.w[k] -= (lr * (m[k] / (1 - 0.9**n)) / (np.sqrt(v[k] / (1 - 0.999**n)) + 1e-8)).astype(np.float32)
    return model


def found_languages(logits: np.ndarray) -> list[str]:
    """Languages that some block is labelled with."""
    p = _sigmoid(logits[:, : len(LANGUAGES)].max(axis=0)) if len(logits) else np.zeros(len(LANGUAGES))
    return [k for k, x in zip(LANGUAGES, p) if x >= DECIDE]


# --------------------------------------------------------------- cleaning

HEAD = "\x01"  # marks in between, gone in the result


def _html(t: str) -> str:
    t = re.sub(r"(?s)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "", t)
    t = re.sub(r"(?is)<pre[^>]*>\s*(?:<code[^>]*>)?(.*?)(?:</code>\s*)?</pre>", lambda m: "\n" + "\n".join("    " + x for x in m[1].strip("\n").split("\n")) + "\n", t)
    t = re.sub(r"(?i)<h([1-6])\b[^<>]*>\s*", lambda m: "\n\n" + "#" * int(m[1]) + " ", t)
    t = re.sub(r"(?i)</h[1-6]\s*>?", "\n\n", t)
    t = re.sub(r"(?i)<li\b[^<>]*>\s*", "\n- ", t)
    t = re.sub(r"(?i)</t[hd]\s*>\s*<t[hd]\b[^<>]*>", " | ", t)
    t = re.sub(r"(?i)<tr\b[^<>]*>\s*|</(?:p|div|ul|ol|table|blockquote)\s*>?|<(?:p|br|hr|div|ul|ol|table|blockquote)\b(?:\"[^\"\n]*\"|'[^'\n]*'|[^<>\n])*>?", "\n", t)
    t = re.sub(rf"(?i)</?(?:{'|'.join(TAGS)})(?=[\s/>]|$)(?:\"[^\"\n]*\"|'[^'\n]*'|[^<>\n])*>?", "", t)
    return html.unescape(t)


def _markdown(t: str) -> str:
    t = re.sub(r"(?ms)^```[^\n]*\n(.*?)(?:^```[ \t]*$|\Z)", lambda m: "\n".join("    " + x for x in m[1].rstrip("\n").split("\n")) + "\n", t)
    t = re.sub(r"(?m)^([^\n#|>*\-=][^\n]*)\n={4,}[ \t]*$", r"# \1", t)
    t = re.sub(r"(?m)^([^\n#|>*\-=][^\n]*)\n-{4,}[ \t]*$", r"## \1", t)
    t = re.sub(r"(?m)^(?:-{3,}|[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*\|[ \t:|-]*)[ \t]*(?:\n|\Z)", "", t)
    t = re.sub(r"(?m)^\|\s?(.*?)\s?\|[ \t]*$", r"\1", t)
    t = re.sub(r"!?\[([^\]\n]*)\]\([^)\n]*\)?", r"\1", t)
    t = re.sub(r"(?m)^\[[^\]\n]+\]:\s*\S+[ \t]*\n?", "", t)
    t = re.sub(r"\[([^\]\n]+)\]\[[^\]\n]*\]", r"\1", t)
    t = re.sub(r"\[\^\w+\]:?", "", t)
    t = re.sub(r"(?m)^>\s?", "", t)
    t = re.sub(r"~~[^~\n]+~~[ ]?", "", t)  # struck out
    t = re.sub(r"\*\*(?=\S)([^*\n]*?)\*\*|(?<!\w)__(?=\S)([^_\n]*?)__(?!\w)", lambda m: m[1] or m[2] or "", t)
    t = re.sub(r"(?<!^)\*\*(?=\S)|(?<=\S)\*\*|(?<!\w)__(?=[^\W_])(?![A-Z]+__)|(?<=[a-z])__(?!\w)", "", t)
    return re.sub(r"(?<!`)`([^`\n]+)`(?!`)", r"\1", t)


def _wiki(t: str) -> str:
    t = re.sub(r"\[\[(?:Category|File|Image):[^\]\n]*\]\]\n?", "", t, flags=re.I)
    t = re.sub(r"\[\[(?:[^\]|\n]*\|)?([^\]\n]*)\]\]", r"\1", t)
    t = re.sub(r"(?s)\{\{[^{}]*\}\}\n?", "", t)
    t = re.sub(r"\[https?://\S+ ([^\]\n]*)\]", r"\1", t)
    t = re.sub(r"\[(https?://[^\]\s]+)\]", r"\1", t)
    t = re.sub(r"(?m)^(\*+|#+)\s+(?=\S)", lambda m: "  " * (len(m[1]) - 1) + ("- " if m[1][0] == "*" else m[1] + " "), t)
    t = re.sub(r"(?m)^(={2,6})\s*([^=\n]+?)\s*\1?[ \t]*$", lambda m: "#" * len(m[1]) + " " + m[2], t)
    t = re.sub(r"(?m)^\{\|[^\n]*\n?|^\|-(?!-)[^\n]*\n?|^\|\}[ \t]*\n?", "", t)
    t = re.sub(r"(?m)^[!|]\s?([^\n]*(?:!!|\|\|)[^\n]*)$", lambda m: re.sub(r"\s*(?:!!|\|\|)\s*", " | ", m[1]), t)
    t = re.sub(r"<ref[^<>]*>[^<]*</ref>|<ref[^<>]*/?>|</?nowiki>?|__[A-Z]+__|#REDIRECT\s*", "", t)
    return re.sub(r"'{2,}(?=\w)|(?<=[\w.,;:])'{2,}|\[\[|\]\]|\{\{|\}\}", "", t)


def _latex(t: str) -> str:
    t = re.sub(r"(?s)\\begin\{(?:verbatim|lstlisting)\}(.*?)\\end\{(?:verbatim|lstlisting)\}", lambda m: "\n".join("    " + x for x in m[1].strip("\n").split("\n")), t)
    t = re.sub(r"\\(chapter|section|subsection|subsubsection|paragraph)\*?\{([^{}\n]*)\}?", lambda m: "\n" + "#" * (1 + ("chapter", "section", "subsection", "subsubsection", "paragraph").index(m[1])) + " " + m[2] + "\n", t)
    t = re.sub(r"\\item(?:\[[^\]\n]*\])?\s*", "- ", t)
    t = re.sub(r"(?m)\\begin\{tabular\}(?:\{[^}\n]*\})?([\s\S]*?)\\end\{tabular\}", lambda m: re.sub(r"\s*\\\\\s*(?:\\hline)?[ \t]*\n?", "\n", re.sub(r"\s*(?<!\\)&\s*", " | ", m[1])).replace("\\hline", ""), t)
    t = re.sub(r"\\(?:begin|end)\{[^}\n]*\}(?:\[[^\]\n]*\])?\n?", "", t)
    keep: list[str] = []

    def formula(m: re.Match) -> str:
        keep.append(m[0])
        return f"\x02{len(keep) - 1}\x03"

    t = re.sub(r"\$[^$\n]*[\\^_=][^$\n]*\$|\\\([^\n]*?\\\)|(?s:\\\[.*?\\\])", formula, t)
    t = re.sub(r"\\footnote\{([^{}\n]*)\}?", r" (\1)", t)
    for _ in range(3):
        t = re.sub(r"\\(?:textbf|textit|emph|underline|texttt|textsc|text|mbox)\{([^{}\n]*)\}", r"\1", t)
    t = re.sub(r"\\(?:cite|ref|label|pageref)\w*\{[^{}\n]*\}", "", t)
    t = re.sub(r"\\textsection\s*|\\S(?=[~\s\d])~?\s*", "§ ", t)
    t = t.replace("\\ldots{}", "…").replace("\\ldots", "…")
    t = re.sub(r"\\par\b\s*(?:\\noindent\b\s*)?", "\n\n", t)
    t = re.sub(r"\\(?:noindent|hline|clearpage|newpage|centering|small|large|medskip|bigskip)\b\s*", "", t)
    t = re.sub(r"\\\\(?=\s|$)", "", t)
    t = re.sub(r"\\([%&$#_{}])", r"\1", t)
    t = re.sub(r"(?<=[A-Za-z0-9.])~(?=[\dA-Za-z])", " ", t)
    t = re.sub(r"(?<!`)``(?!`)([^'\n]*)''", r"“\1”", t)
    t = re.sub(r"(?<![:\w\\])\\[a-zA-Z]+\*?\{([^{}\n]*)\}", r"\1", t)
    return re.sub(r"\x02(\d+)\x03", lambda m: keep[int(m[1])], t)


CLEAN = {"latex": _latex, "wiki": _wiki, "markdown": _markdown, "html": _html}


def clean(text: str, found: list[str], code: list[tuple[int, int]] = ()) -> str:
    """Plain text with its structure: headings as "# title", list items as
    "- item", table rows with " | " between cells, code indented by four blanks,
    formulas as they stand. ``code``: spans that are left as they stand."""
    held: list[str] = []
    for a, b in sorted(code, reverse=True):
        held.append(text[a:b])
        text = text[:a] + f"\x05{len(held) - 1}\x06" + text[b:]
    for name, fn in CLEAN.items():
        if name in found:
            text = fn(text)
    text = re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", text)).strip("\n")
    return re.sub(r"\x05(\d+)\x06", lambda m: held[int(m[1])], text)


# --------------------------------------------------------------- operator


def residue(df: DataFrame, id_cols: list[str], text_col: str, weights: Path = WEIGHTS, all_rows: bool = False) -> DataFrame:
    """id columns, languages array<string>, structures map<string, int>, text.

    The languages are those that the network labels some block of the whole text with;
    ``text`` is the clean text. Texts without any sign that markup is made of are left
    out before Python (they hold none), unless ``all_rows``, where they come back unchanged with no language. Null texts
    give no row (with ``all_rows`` a null text); empty ones stay empty; rows are
    kept one by one, repeated or with null ids; other columns aren't read.
    """
    names = [f"_k{i}" for i in range(len(id_cols))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(id_cols, names)], F.col(text_col).alias("_t"))
    marked = rows.where(F.col("_t").rlike(SIGNS))
    with np.load(weights) as z:
        shared = df.sparkSession.sparkContext.broadcast({k: z[k] for k in z.files})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Labeller(shared.value)
        nl = len(LANGUAGES)
        for whole in batches:
            for at in range(0, len(whole), 1000):
                b = whole.iloc[at : at + 1000]
                spans = [blocks(t) for t in b["_t"]]
                logits = model.label([vectors(t, s) for t, s in zip(b["_t"], spans)])
                langs, structs, texts = [], [], []
                for t, s, z in zip(b["_t"], spans, logits):
                    kind = z[:, nl:].argmax(axis=1) if len(s) else np.zeros(0, int)
                    found = found_languages(z)
                    inline = [(a, e) for (a, e), c in zip(s, kind) if c == 4 and "```" not in t[a:e] and not re.search(r"</?(?:pre|code)", t[a:e], re.I)]
                    langs.append(found)
                    structs.append({STRUCTURES[c]: int(n) for c, n in zip(*np.unique(kind, return_counts=True))})
                    texts.append(clean(t, found, inline if "html" not in found else []) if found else t)
                out = {n: b[n].to_numpy() for n in names}
                yield pd.DataFrame(out | {"languages": langs, "structures": structs, "text": texts})

    kinds = dict(df.dtypes)
    schema = ", ".join(f"{n} {kinds[c]}" for n, c in zip(names, id_cols)) + ", languages array<string>, structures map<string, int>, text string"
    out = marked.mapInPandas(run, schema)
    if all_rows:
        plain = rows.where(~F.coalesce(F.col("_t").rlike(SIGNS), F.lit(False)))
        out = out.unionByName(plain.select(*names, F.array().cast("array<string>").alias("languages"), F.create_map().cast("map<string, int>").alias("structures"), F.col("_t").alias("text")))
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, id_cols)], "languages", "structures", "text")


def _both(spark, sf):
    from lexgrain.session import load

    s = load(spark, sf, "sections").select(F.lit("section").alias("rec"), F.col("section_id").alias("rec_id"), "text")
    return s.unionByName(load(spark, sf, "chunks").select(F.lit("chunk").alias("rec"), F.col("id").alias("rec_id"), "text"))


def p7_found(spark, sf):
    return residue(_both(spark, sf), ["rec", "rec_id"], "text").select("rec", "rec_id", F.explode("languages").alias("markup")).distinct()


def p7_clean(spark, sf):
    return residue(_both(spark, sf), ["rec", "rec_id"], "text", all_rows=True).select("rec", "rec_id", "text")


QUERIES = {"p7_found": (p7_found, None), "p7_clean": (p7_clean, None)}


def score(model: Labeller, docs: list, hide: bool = False) -> tuple[float, float]:
    """(recall, precision) of (document, language) pairs."""
    seqs = [vectors(t, s) for t, s, _, _ in docs]
    for x in seqs if hide else ():
        x[:, -len(LANGUAGES) :] = 0
    got = [set(found_languages(z)) for z in model.label(seqs)]
    want = [{k for i, k in enumerate(LANGUAGES) if lang[:, i].any()} for _, _, lang, _ in docs]
    hit = sum(len(a & b) for a, b in zip(got, want))
    return hit / max(1, sum(map(len, want))), hit / max(1, sum(map(len, got)))


def main(folder: str) -> None:
    """Train on documents made from clean sections and chunks of a folder with test
    tables (in the order of a hash, the first ``SAMPLE``); report on documents made
    from others, with the network alone, the forms alone, and both."""
    texts = pd.concat([pd.read_parquet(f"{folder}/{t}.parquet", columns=["text"])["text"] for t in ("sections", "chunks")]).dropna().drop_duplicates()
    texts = sorted((t for t in texts if t.strip() and not re.search(SIGNS, t)), key=xxhash.xxh64_intdigest)
    model = train(texts)
    np.savez_compressed(WEIGHTS, **{k: v.astype(np.float16) for k, v in model.w.items()})
    held = list(planted(texts[SAMPLE:] or texts, 4000, 77))
    want = [{k for i, k in enumerate(LANGUAGES) if lang[:, i].any()} for _, _, lang, _ in held]
    plain = [set(languages(t)) for t, _, _, _ in held]
    hit = sum(len(a & b) for a, b in zip(plain, want))
    model = Labeller.load()
    print("held out, recall and precision: both", score(model, held), "network alone", score(model, held, True), "forms alone", (hit / sum(map(len, want)), hit / sum(map(len, plain))))
    same = [(model.label([vectors(t, s)])[0][:, len(LANGUAGES) :].argmax(1) == kind).mean() for t, s, _, kind in held[:1000]]
    print("structure of blocks", float(np.mean(same)))


if __name__ == "__main__":
    import sys

    main(sys.argv[1])
