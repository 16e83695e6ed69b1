"""Training documents for the labeller of markup, with labels by construction.

Clean text is cut into blocks, and marks of a language, whole or damaged, are put in
at known places; signs that belong to a sentence are put in as counter-examples. What
a block holds is therefore known and told by no pattern.
"""

from __future__ import annotations

import random
from collections.abc import Callable

#: blocks of a training document at most
RUN = 30

# what can be planted: (language, structure, maker); a maker gets a random source, a word, a phrase and gives one or more lines
Maker = Callable[[random.Random, str, str], list[str]]


def _entity(r: random.Random) -> str:
    return r.choice(["&nbsp;", "&amp;", "&lt;", "&gt;", "&quot;", "&sect;", "&mdash;", "&rsquo;", "&copy;", "&frac12;", "&eacute;", "&ldquo;", "&rdquo;", "&hellip;", "&ndash;", "&euro;", "&times;", "&deg;", "&para;", "&ldquo", "&rdquo", "&ndash", "&hellip", "&lt", "&gt", "&para", "&copy", "&deg", f"&#{r.randrange(33, 9000)};", f"&#x{r.randrange(33, 9000):x};", f"&#x{r.randrange(33, 9000):X};", "&nbsp", "&amp", "&sect"])


def _tag(r: random.Random) -> str:
    t = r.choice("b i u em strong sup sub small span font tt code cite big center mark".split())
    return t.upper() if r.random() < 0.2 else t


def _pair(r: random.Random, w: str) -> str:
    t = _tag(r)
    return f"<{t}>{w}</{t}>"


def _rows(r: random.Random, w: str) -> list[str]:
    return [r.choice(["<table border=1>", "<table>", '<TABLE class="x">']), "<tr><th>" + w + "</th><th>no</th></tr>", f"<tr><td>{w}</td><td>{r.randrange(99)}</td></tr>", "</table>"]


HTML: list[tuple[str, Maker]] = [
    ("text", lambda r, w, p: [f"<p>{p}</p>"]),
    ("text", lambda r, w, p: [f"{p} {_pair(r, w)} {w}"]),
    ("text", lambda r, w, p: [f"{p} {_entity(r)} {w}"]),
    ("text", lambda r, w, p: [f"{p}{_entity(r)}{w}."]),
    ("text", lambda r, w, p: [f"{p} {_entity(r)}{r.randrange(99)},000 {w}"]),
    ("text", lambda r, w, p: [f"<FONT SIZE={r.randrange(9)}>{p}</FONT>", f"<P ALIGN=center>{w}"]),
    ("text", lambda r, w, p: [p + r.choice(["<br>", "<BR/>", "<br />", "<hr>", "<HR>"])]),
    ("text", lambda r, w, p: [f'<a href="http://{w}.in/{r.randrange(99)}">{w}</a> {p}']),
    ("text", lambda r, w, p: [f'<div class="{w}">{p}', "</div>"]),
    ("text", lambda r, w, p: [f'{p} <img src="{w}.png" alt="{w}">']),
    ("text", lambda r, w, p: [f"{p} <!-- {w} --> {w}"]),
    ("text", lambda r, w, p: [f'<span style="color:red">{p}</span>']),
    ("text", lambda r, w, p: [f"{p} &ldquo;{w} {w}&rdquo; {w}"]),
    ("text", lambda r, w, p: [f"{p} &ldquo{w} {w}&rdquo {w}"]),
    ("text", lambda r, w, p: [f"<a href=\"#{w}{r.randrange(999)}\" title='x > y'>{w}</a> {p}"]),
    ("text", lambda r, w, p: [f"{p}.{r.choice(['<td a', '<td align', '<td align=', '<tr val', '<table bor', '<th', '<FONT SIZE=2', '<p', '</p', '<div cl', '<a href=', '<span', '<br', '</li'])}"]),
    ("text", lambda r, w, p: [f"<FONT SIZE={r.randrange(9)}", p]),
    ("heading", lambda r, w, p: [f"<h{r.randrange(1, 7)}>{p}</h2>"]),
    ("list", lambda r, w, p: ["<ul>", f"<li>{p}</li>", f"<li>{w}", "</ul>"]),
    ("table", lambda r, w, p: _rows(r, w)),
    ("code", lambda r, w, p: ["<pre><code>", f"{w} = {w}({r.randrange(9)})", "</code></pre>"]),
]
MARKDOWN: list[tuple[str, Maker]] = [
    ("heading", lambda r, w, p: ["#" * r.randrange(1, 7) + " " + p[:60]]),
    ("heading", lambda r, w, p: [p[:50], r.choice("=-") * r.randrange(6, 40)]),
    ("text", lambda r, w, p: [f"{p} **{w}** {w}"]),
    ("text", lambda r, w, p: [f"{p} __{w}__ {w}"]),
    ("text", lambda r, w, p: [f"{p} [{w}](https://{w}.org/{r.randrange(99)}) {w}"]),
    ("text", lambda r, w, p: [f"{p} ![{w}]({w}.png)"]),
    ("text", lambda r, w, p: [f"{p} ~~{w}~~ {w}"]),
    ("text", lambda r, w, p: [f"{p} `{w}_{r.randrange(99)}` {w}"]),
    ("text", lambda r, w, p: [f"{p} [{w}][{r.randrange(9)}]", f"[{r.randrange(9)}]: https://{w}.org"]),
    ("text", lambda r, w, p: [f"{p}[^{r.randrange(9)}]"]),
    ("text", lambda r, w, p: [f"> {p[:1].upper()}{p[1:]}"]),
    ("list", lambda r, w, p: [f"- [{r.choice('x ')}] {p}", f"- [ ] {w}"]),
    ("table", lambda r, w, p: [f"| {w} | no |", r.choice(["|---|---:|", "|:--|---|", "| --- | --- |"]), f"| {w} | {r.randrange(99)} |"]),
    ("code", lambda r, w, p: ["```" + r.choice(["", "python", "text"]), f"{w} = {w}({r.randrange(9)})", "```"]),
]
WIKI: list[tuple[str, Maker]] = [
    ("text", lambda r, w, p: [f"{p} [[{w}]] {w}"]),
    ("text", lambda r, w, p: [f"{p} [[{w} {w}|{w}]] {w}"]),
    ("text", lambda r, w, p: [f"{{{{{w}|{r.randrange(99)}}}}} {p}"]),
    ("text", lambda r, w, p: [f"{p} '''{w}''' {w}"]),
    ("text", lambda r, w, p: [f"{p} ''{w}'' {w}"]),
    ("text", lambda r, w, p: [f"{p} [https://{w}.org/{r.randrange(99)} {w}] {w}"]),
    ("text", lambda r, w, p: [f"[[{r.choice(['Category', 'File', 'Image'])}:{w}]]", p]),
    ("text", lambda r, w, p: [f"#REDIRECT [[{w}]]"]),
    ("text", lambda r, w, p: [f"{p}<ref>{w}</ref>"]),
    ("text", lambda r, w, p: [f"{{{{Infobox {w}", f"| year = {r.randrange(1950, 2020)}", f"| {w} = {p}", "}}"]),
    ("list", lambda r, w, p: [f"== {w} ==", f"* {p}", f"** {w} {p}", f"* {w}"]),
    ("text", lambda r, w, p: [r.choice(["__TOC__", "__NOTOC__"]), p]),
    ("heading", lambda r, w, p: ["=" * (k := r.randrange(2, 5)) + f" {p[:40]} " + "=" * k]),
    ("table", lambda r, w, p: ['{| class="wikitable"', f"! {w} !! no", "|-", f"| {w} || {r.randrange(99)}", "|}"]),
]
LATEX: list[tuple[str, Maker]] = [
    ("text", lambda r, w, p: [f"{p} \\{r.choice(['textbf', 'emph', 'textit', 'underline', 'texttt', 'textsc', 'mbox'])}{{{w}}} {w}"]),
    ("text", lambda r, w, p: [f"{p}\\footnote{{{w}}} {w}"]),
    ("text", lambda r, w, p: [f"{p} \\{r.choice(['cite', 'ref', 'label'])}{{{w}}} {w}"]),
    ("text", lambda r, w, p: [f"{p} {r.randrange(99)}\\% {w}"]),
    ("text", lambda r, w, p: [f"{p} {w} \\& {w}"]),
    ("text", lambda r, w, p: [f"{p} {r.choice([chr(92) + 'S', chr(92) + 'S~', chr(92) + 'textsection '])}{r.randrange(99)}"]),
    ("text", lambda r, w, p: [f"{p} \\{r.choice(['ldots', 'noindent', 'par', 'newpage', 'dots', 'quad'])} {w}"]),
    ("text", lambda r, w, p: [f"\\noindent {p}\\\\", w]),
    ("text", lambda r, w, p: [f"{p} ``{w}'' {w}"]),
    ("heading", lambda r, w, p: [f"\\{r.choice(['section', 'subsection', 'chapter', 'section*', 'subsection*', 'paragraph'])}{{{p[:40]}}}"]),
    ("list", lambda r, w, p: ["\\begin{" + (e := r.choice(["itemize", "enumerate"])) + "}", f"\\item {p}", f"\\item {w}", f"\\end{{{e}}}"]),
    ("table", lambda r, w, p: ["\\begin{tabular}{ll}", f"{w} & no \\\\ \\hline", f"{w} & {r.randrange(99)} \\\\", "\\end{tabular}"]),
    ("formula", lambda r, w, p: [f"{p} $I = \\frac{{P r}}{{{r.randrange(9)}}}$ {w}"]),
    ("formula", lambda r, w, p: [f"{p} ${r.choice('fxyz')}_{{{r.choice('nij')}}} \\le {r.randrange(999)}$ {w}"]),
    ("formula", lambda r, w, p: [f"So \\[ {r.choice('TNS')} = {r.randrange(999)} \\cdot {r.choice('nx')}^{{{r.randrange(9)}}} \\]"]),
    ("code", lambda r, w, p: ["\\begin{verbatim}", f"{w} = {w}({r.randrange(9)})", "\\end{verbatim}"]),
]
PLANTS = {"html": HTML, "markdown": MARKDOWN, "wiki": WIKI, "latex": LATEX}

#: signs that belong to the sentence
DECOYS: list[Maker] = [
    lambda r, w, p: [f"{p} where {w} < {r.randrange(99)} and {w} > {r.randrange(9)}"],
    lambda r, w, p: [f"Messrs {w.title()} & {w.title()} Co. {p}"],
    lambda r, w, p: [f"{w.upper()[:2]}&{w.upper()[:1]} {p}"],
    lambda r, w, p: [f"{p} M/s {w.title()} & Co. {w}"],
    lambda r, w, p: [f"M/s {w.title()} & Co.", p],
    lambda r, w, p: [f"{p} {r.randrange(9)}0_000 / {r.randrange(2, 9)} == {r.randrange(9)}_500."],
    lambda r, w, p: [f"* {p}", f"** {w} {p}"],
    lambda r, w, p: [f"{w} = {r.randrange(1950, 2020)}", f"| {w} = {p}"],
    lambda r, w, p: [f"{p} [{w} ({r.randrange(999)})] ({w} {w}) and {w}_{w}_{r.randrange(99)}."],
    lambda r, w, p: [f"[{w}] ({p}) {w}"],
    lambda r, w, p: [f"See [{w.title()}-{w} ({r.randrange(999)})] ({w} {w}) and {w}_{w}_{r.randrange(999)}."],
    lambda r, w, p: [f"{p} [{w} {r.randrange(9)}] ({w}) {w}_{r.randrange(999)}"],
    lambda r, w, p: [f"Table {r.randrange(999)} -- {w}, C:\\{w}\\{r.randrange(999)}."],
    lambda r, w, p: [f"M/s {w.title()} & {w.title()}", f"{p} M/s {w.title()} & Sons"],
    lambda r, w, p: [f"* {p}"],
    lambda r, w, p: [f"{p}* {w}", f"* {w} as then in force"],
    lambda r, w, p: [f"{p} [{r.randrange(999)}] {w}"],
    lambda r, w, p: [f"{p} [{r.randrange(1950, 2024)}] {r.randrange(9)} SCR {r.randrange(999)}"],
    lambda r, w, p: [f"{p} [{w}] {w}"],
    lambda r, w, p: [f"[{w} {w}]"],
    lambda r, w, p: [f"{p} C:\\{w}\\{w}.txt"],
    lambda r, w, p: [f"{p} \\\\{w}\\{w}\\{w}.doc"],
    lambda r, w, p: [f"{p} $ {r.randrange(999)} or Rs {r.randrange(999)} and US$ {r.randrange(99)}"],
    lambda r, w, p: [f"{p} {r.randrange(9)} * {r.randrange(9)} = {r.randrange(99)}"],
    lambda r, w, p: [f"{p} ~{r.randrange(99)}% of {w}"],
    lambda r, w, p: [f"{p} {w[:1]}^{r.randrange(9)} > {w}"],
    lambda r, w, p: [f"if {w} == {w} {p}"],
    lambda r, w, p: [f"{p} {{{w}}} {w}", p],
    lambda r, w, p: [f"{p} {w}/[{r.randrange(999)}]/{r.randrange(2024)}"],
    lambda r, w, p: [f"lot #{r.randrange(99)} {p}"],
    lambda r, w, p: [f"{w} | {w} | {w}"],
    lambda r, w, p: [f"{p} {'_' * r.randrange(3, 20)}", "Signature"],
    lambda r, w, p: ["* * *", p],
    lambda r, w, p: [f"Form {w.upper()[:3]}_{r.randrange(99)}_{w.upper()[:1]} {p}"],
    lambda r, w, p: [f"{w}_{w}_{r.randrange(99)} {p}"],
    lambda r, w, p: [f"- {p}", f"- {w}"],
    lambda r, w, p: [f"+ {p}"],
    lambda r, w, p: [f"{r.randrange(1, 9)}. {p}"],
    lambda r, w, p: [f"'{w}' and \"{w}\" {p}"],
    lambda r, w, p: [f"{p} <{w}@{w}.in>"],
    lambda r, w, p: [f"{p}<{r.randrange(99)}"],
    lambda r, w, p: [f"({w})] ({w}) {p}"],
    lambda r, w, p: [f"{p} ({w}[{r.randrange(9)}])"],
    lambda r, w, p: [f"{w.upper()} {'=' * 1} {r.randrange(99)}"],
    lambda r, w, p: [f"{p} R&D, {w}&{w}"],
    lambda r, w, p: [f"{p} `{w}"],
    lambda r, w, p: [f"{p} 5' 6\" {w}"],
    lambda r, w, p: [" ".join(r.sample("< > & * _ [ ] ^ | { } # ~ $ / = - +".split(), r.randrange(2, 9)))],
    lambda r, w, p: [f"{p} " + " ".join(r.sample("< > & * _ [ ] ^ | { } # ~ $ / = - +".split(), r.randrange(2, 9))) + f" {w}"],
]


def damaged(r: random.Random, lines: list[str]) -> list[str]:
    """The first or last line lost, or some characters at an end of one."""
    if len(lines) > 1 and r.random() < 0.5:
        return lines[1:] if r.random() < 0.5 else lines[:-1]
    at = r.randrange(len(lines))
    n = r.randrange(1, 4)
    line = lines[at][n:] if r.random() < 0.5 else lines[at][:-n]
    return [*lines[:at], line, *lines[at + 1 :]]


def document(r: random.Random, clean: list[str]) -> list[tuple[str, str, str]]:
    """(line, language or '', structure) of a document made from clean lines."""
    at = r.randrange(max(1, len(clean) - RUN + 1))
    out = [(t, "", "text") for t in clean[at : at + r.randrange(1, RUN + 1)]]
    words = [w for t, _, _ in out for w in t.split() if w.isalpha()] or ["x"]
    phrase = lambda: " ".join(r.choice(words) for _ in range(r.randrange(3, 12)))
    put = []
    for k in r.choices([(), (1,), (2,)], [0.35, 0.5, 0.15])[0] and r.sample(list(PLANTS), r.choice((1, 1, 2))):
        for _ in range(r.choice((1, 1, 2, 3))):
            kind, make = r.choice(PLANTS[k])
            lines = make(r, r.choice(words), phrase())
            whole = len(lines)
            if r.random() < 0.25 and (cut := damaged(r, lines)) and any(set(x) & set("<>&*_#[]{}|\\=`~$'") for x in cut):
                lines = cut
            bare = kind == "code" and whole == len(lines)
            # the middle of a block of code holds none of the language's signs
            put.append([(x, "" if bare and 0 < i < len(lines) - 1 else k, kind) for i, x in enumerate(lines)])
    for _ in range(r.choice((0, 0, 1, 2))):
        put.append([(x, "", "text") for x in r.choice(DECOYS)(r, r.choice(words), phrase())])
    for lines in put:
        i = r.randrange(len(out) + 1)
        out[i:i] = lines
    return out
