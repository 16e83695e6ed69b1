"""Repair of text from scanned pages.

Three traces of the page are found and undone:

* misread words: every word of the running text is counted over the corpus; in
  SQL, words are joined with confusable, far more frequent words through the
  difference of their anagram hashes (the sum of the fifth powers of the letters:
  putting "rn" for "m" changes it by the same amount in any word), and the most
  frequent candidate is the correction;
* page lines: page numbers by their form and the section's page list, running
  heads by the document's own titles, the court and the gazette;
* words cut at a line end: a cut is undone where the corpus knows the joined word
  or the compound.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.session import cut

# fixed values: letters and what scanners take them for, digits last
CONFUSIONS = [
    ("a", "o"), ("e", "c"), ("i", "l"), ("t", "f"), ("h", "b"), ("d", "cl"), ("m", "rn"),
    ("n", "ri"), ("u", "ii"), ("li", "h"), ("w", "vv"), ("m", "in"), ("k", "lc"),
    ("o", "0"), ("l", "1"), ("i", "1"), ("s", "5"), ("g", "9"), ("b", "6"), ("b", "8"), ("a", "4"),
]

BREAK = re.compile(r"(?P<word>[^\W\d_]+(?:[-‐‑][^\W\d_]+)*)(?P<sign>[-‐‑‒¬­])[ \t\r]*$")
START = re.compile(r"\s*(?P<word>[^\W\d_]+)")
#: a word, also with one of its letters read as a digit (one confusion undoes no more)
WORD = re.compile(r"[A-Za-z]{2,}(?:-[A-Za-z]+)*|(?!(?:[A-Za-z-]*[0-9]){2})(?=(?:[0-9-]*[A-Za-z]){2})[A-Za-z0-9]{2,}(?:-[A-Za-z0-9]+)*")
#: what may stand around a word
AROUND = ".,;:!?()[]{}'\"“”‘’*_—–…"
SIGNS = frozenset("-‐‑‒¬­")
ORNATE = re.compile(r"(?:[-—–]+\s*(\d{1,4})\s*[-—–]+|\[\s*(\d{1,4})\s*\]|(?:page|pg\.?|p\.)\s*(\d{1,4})(?:\s+of\s+\d+)?|(\d{1,4})\s*\|\s*page|[-—–]?\s*[ivxlc]{1,8}\s*[-—–]?)", re.I)
ROMAN = re.compile(r"[-—–]?\s*(?=[ivxlc])(?:c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})\s*[-—–]?")
BARE = re.compile(r"\d{1,4}")
NUMBER_SIDE = re.compile(r"^\s*\d{1,4}\s{2,}|\s{2,}\d{1,4}\s*$")
NUMBERED = re.compile(r"(?:order|report|notification|schedule|circular|ordinance)\s+no\.?\s*\d+\s+of\s+\d{4}", re.I)
GAZETTE = re.compile(r"(?:vol\.?\s*\d+\]?\s+)?(?:the\s+)?(?:state\s+gazette|gazette\s+of\s+(?:the\s+)?[a-z]+)(?:\s+of\s+[a-z]+)?\s*(?:[\[(]?part\s+[ivx\d]+[\])]?)?", re.I)
EDITION = re.compile(r"\s+[–—-]\s+(?:extraordinary|certified copy|reported|unreported|part\s+\w+)\s*$", re.I)
MARKED = re.compile(r"\s*(?:[#|*>{}\\<=`\[]|[-+]\s|\d+[.)]\s|\([a-z]\)\s|[-=~]{3,})")


def lines_of(text: str) -> list[str]:
    return re.split(r"\r\n|[\n\r\f]", text)


def _fold(s: str) -> str:
    """Letters of a heading, with digits that scanners put for letters undone."""
    return re.sub(r"[^a-z]", "", re.sub(r"(?<=[A-Za-z])[0-9](?=[A-Za-z]|\b)", lambda m: {"4": "a", "0": "o", "1": "i", "5": "s", "9": "a", "8": "b"}.get(m[0], ""), s).lower())


def is_page_number(line: str, before: str, pages: set[int]) -> bool:
    """A line with nothing but a page number. Ornament or a roman number is
    enough; a bare number must be one of the section's pages, or, where these are
    unknown, must not stand as the value of a line that ends in a colon."""
    s = line.strip()
    if not s or len(s) > 20:
        return False
    m = ORNATE.fullmatch(s)
    if m:
        return any(m.groups()) or bool(ROMAN.fullmatch(s))
    if BARE.fullmatch(s):
        return int(s) in pages if pages else not before.rstrip().endswith((":", "|", ",")) and int(s) < 2000
    return False


def heading_like(line: str) -> bool:
    """Could be a running head: short, capitalised words, no sentence."""
    if len(line) < 5 or len(line) > 140:
        return False
    quick = line.split()
    if 3 * sum(w[0].islower() for w in quick) > len(quick) + 2:
        return False
    s = NUMBER_SIDE.sub("", line).strip()
    if not 5 <= len(s) <= 100 or s[0] in "#|*<>{\\=`-":
        return False
    w = re.findall(r"[^\W\d_][\w’']*", s)
    low = sum(x[0].islower() and x not in ("of", "vs", "v", "at", "and", "the", "on", "in", "copy") for x in w)
    return bool(w) and w[0][0].isupper() and low <= 0.2 * len(w) and not s.endswith((":", ";", ","))


def _gazette(s: str) -> bool:
    return bool(GAZETTE.fullmatch(re.sub(r"(?<=[A-Za-z])[49](?=[A-Za-z])", "A", s))) and (s.upper() == s or "[" in s or s.istitle())


def is_head(line: str, heads: list[str]) -> bool:
    """A running head: the gazette's, a numbered paper's, or (the start of) one
    of the document's titles, which may be cut off; one letter in eight may
    differ."""
    s = EDITION.sub("", NUMBER_SIDE.sub("", line).strip())
    if _gazette(s) or NUMBERED.fullmatch(s):
        return True
    a = _fold(s)
    if len(a) < 3:
        return False
    for h in heads:
        b = _fold(h)
        if a == b and len(s.split()) <= len(h.split()) + 1 or len(a) >= 8 and len(b) >= len(a) and sum(x != y for x, y in zip(a, b)) <= len(a) // 8:
            return True
    return False


def _title_shape(line: str) -> bool:
    """Heading-like and no part of a sentence, as far as form tells."""
    s = line.strip()
    return heading_like(line) and bool(s.upper() == s or NUMBER_SIDE.search(line) or EDITION.search(s) or NUMBERED.search(s) or _gazette(EDITION.sub("", NUMBER_SIDE.sub("", line).strip())) or re.search(r"\bvs\b|\b(?:[A4]ct|Adhiniyam),?\s*(?:\d{4}|['’]\d\d)|^Act of \d{4}", s))


def at_cut(line: str) -> re.Match | None:
    """The word before a hyphen-like sign at the line's end."""
    end = line.rstrip(" \t\r")
    return BREAK.search(line, max(0, len(end) - 60)) if end and end[-1] in SIGNS else None


def running_text(text: str) -> str:
    """Text without page numbers, headings and words at a cut."""
    if "\n" not in text and "\f" not in text and "\r" not in text:
        return text
    kept: list[str] = []
    for s in lines_of(text):
        short = s.strip()
        if not short or (len(short) <= 20 and (ORNATE.fullmatch(short) or BARE.fullmatch(short))) or _title_shape(s):
            continue
        if kept and (m := at_cut(kept[-1])) and START.match(s):
            kept[-1] = kept[-1][: m.start()]
            s = START.sub("", s, count=1)
        kept.append(s)
    return "\n".join(kept)


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, n) of the running text of all rows; tasks add up their own first."""

    def words(c: Counter) -> pd.DataFrame:
        out: Counter = Counter()
        for raw, n in c.items():
            w = raw.strip(AROUND)
            if WORD.fullmatch(w):
                out[w.lower()] += n
        return pd.DataFrame({"word": list(out), "n": list(out.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c: Counter = Counter()
        for b in batches:
            for t in b["text"]:
                c.update(running_text(t).split())
            if len(c) > 300_000:
                yield words(c)
                c.clear()
        if c:
            yield words(c)

    return texts.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def corrections(vocab: DataFrame, ratio: int = 8, often: int = 150, least: int = 4, letters: int = 3) -> DataFrame:
    """(wrong, right, n): words that are one confusion away from a word at least
    ``ratio`` times as frequent; the most frequent one, then the first by name. A
    form that comes five times or more, or has three letters, is rather a word of
    its own: there the other must be ``often`` times as frequent. One with a digit
    is none however often it comes, and never a correction.

    The join is on the anagram hash of the word less the confusion's difference;
    the spelling is compared exactly afterwards.
    """
    spark = vocab.sparkSession
    power = lambda s: sum(ord(c) ** 5 for c in s)
    conf = spark.createDataFrame([(r, w, power(w) - power(r)) for r, w in CONFUSIONS], "r string, w string, delta long")
    hashed = vocab.where(f"length(word) >= {letters}").withColumn("h", F.expr("aggregate(split(word, ''), 0L, (a, c) -> a + cast(pow(ascii(c), 5) as bigint))"))
    rare = hashed.alias("x").join(F.broadcast(conf), F.expr("instr(x.word, w) > 0")).select(F.col("word").alias("wrong"), F.col("n").alias("nw"), "r", "w", (F.col("h") - F.col("delta")).alias("h"))
    common = hashed.where(f"n >= {least} and not word rlike '[0-9]'").select(F.col("word").alias("right"), F.col("n").alias("nr"), "h")
    met = rare.join(common, "h").where(f"nr >= nw * if(nw >= 5 and not wrong rlike '[0-9]' or length(wrong) <= 3, {often}, {ratio})")
    exact = met.where("exists(sequence(1, length(wrong)), i -> substr(wrong, i, length(w)) = w and concat(substr(wrong, 1, i - 1), r, substr(wrong, i + length(w))) = right)")
    return exact.groupBy("wrong").agg(F.expr("max_by(right, struct(nr, reverse(right)))").alias("right"), F.max("nw").alias("n"))


def traces(sections: DataFrame, titles: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """(id, kind, line, a, b): what there is to repair.

    sections(id, doc, text, pages): kinds 'page_number' and 'running_header' with
    the line's number; 'hyphen_break' with the two parts of the word and the
    number of the line that ends in the cut; 'misread' with the word and its
    correction. titles(doc, heads array<string>): the document's own titles.

    Rows with a null id or text take no part; null pages or documents are as if
    unknown; repeated rows count once; an empty table gives an empty result.
    """
    spark = sections.sparkSession
    base = sections.where("id is not null and text is not null and text <> ''")
    vocab = cut(vocabulary(base))
    wrong = cut(corrections(vocab))
    few = wrong.count() <= broadcast_rows
    known = spark.sparkContext.broadcast({r["wrong"] for r in wrong.select("wrong").collect()}) if few else None

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only = known.value if known else None
        for batch in batches:
            rows = []
            for sid, doc, text, pages in batch.itertuples(index=False):
                pages = {int(p) for p in pages if p == p and p is not None} if pages is not None else set()
                raw = set(running_text(text).split())
                for w in {w for r in raw if WORD.fullmatch(w := r.strip(AROUND).lower())} if only is None else {w for r in raw if (w := r.strip(AROUND).lower()) in only}:
                    rows.append((sid, doc, "misread", 0, w, ""))
                ls = lines_of(text)
                if len(ls) < 2:
                    continue
                page = [is_page_number(x, ls[i - 1] if i else "", pages) for i, x in enumerate(ls)]
                head = [not p and heading_like(x) for p, x in zip(page, ls)]
                rows += [(sid, doc, "page_number", i, "", "") for i, p in enumerate(page) if p]
                rows += [(sid, doc, "running_header", i, x.strip(), "") for i, (x, h) in enumerate(zip(ls, head)) if h]
                for i, x in enumerate(ls):
                    m = not page[i] and at_cut(x)
                    if not m:
                        continue
                    j = i + 1
                    while j < len(ls) and (page[j] or head[j] or not ls[j].strip()):
                        j += 1
                    nxt = START.match(ls[j]) if j < len(ls) else None
                    if nxt:
                        left = m["word"] if m["sign"] in "-‐‑" else re.split("[-‐‑]", m["word"])[-1]
                        rows.append((sid, doc, "hyphen_break", i, left, nxt["word"]))
            if rows:
                yield pd.DataFrame(rows, columns=["id", "doc", "kind", "line", "a", "b"])

    found = cut(base.select("id", "doc", "text", "pages").mapInPandas(scan, "id string, doc string, kind string, line int, a string, b string"))

    pages = found.where("kind = 'page_number'").select("id", "kind", "line", "a", "b")
    words = found.where("kind = 'misread'").join(wrong.select(F.col("wrong").alias("a"), "right"), "a").select("id", "kind", "line", "a", F.col("right").alias("b"))

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = [is_head(a, list(h) if h is not None else []) for a, h in zip(b["a"], b["heads"])]
            yield b[["id", "kind", "line", "a", "b"]][ok]

    lines = found.where("kind = 'running_header'").join(titles, "doc", "left").select("id", "kind", "line", "a", "b", "heads")
    lines = lines.mapInPandas(heads, "id string, kind string, line int, a string, b string")

    cuts = found.where("kind = 'hyphen_break'").withColumn("last", F.element_at(F.split("a", "[-‐‑]"), -1))
    known_word = lambda name, col: vocab.select(F.col("word").alias(col), F.col("n").alias(name))
    cuts = cuts.withColumn("joined", F.lower(F.concat("last", "b"))).withColumn("compound", F.lower(F.concat_ws("-", "last", "b"))).withColumn("whole", F.lower(F.concat_ws("-", "a", "b")))
    cuts = cuts.withColumn("p", F.lower("last")).withColumn("s", F.lower("b"))
    for name, col in (("nj", "joined"), ("nc", "compound"), ("nw", "whole"), ("np", "p"), ("ns", "s")):
        cuts = cuts.join(known_word(name, col), col, "left")
    misread = wrong.select(F.col("wrong").alias("joined"), F.lit(1).alias("m"))
    cuts = cuts.join(misread, "joined", "left")
    # the joined word or the compound is known, or the parts aren't words of their own
    sure = "coalesce(nj, 0) > 0 or coalesce(nc, 0) > 0 or coalesce(nw, 0) > 0 or (b = s and (np is null or ns is null or (np < 3 and ns < 3)) and s not in ('and', 'or', 'to'))"
    cuts = cuts.where(sure).select("id", "kind", "line", F.when(F.expr("coalesce(nj, 0) = 0 and (coalesce(nc, 0) > 0 or coalesce(nw, 0) > 0)"), F.concat("a", F.lit("-"))).otherwise(F.col("a")).alias("a"), "b", "joined", "m")
    # a cut word that is itself misread counts for both
    also = cuts.where("m = 1").select("id", F.lit("misread").alias("kind"), F.lit(0).alias("line"), F.col("joined").alias("a"), F.lit("").alias("b"))
    return pages.unionByName(words).unionByName(lines).unionByName(cuts.drop("joined", "m")).unionByName(also).distinct()


def repair(text: str, edits: list[dict]) -> str:
    """The text as running paragraphs: page lines dropped, cut words joined,
    misread words corrected, wrapped lines put together. Texts of a few long
    lines keep their lines; marked-up lines stay as they are."""
    ls = lines_of(text)
    drop = {e["line"] for e in edits if e["kind"] in ("page_number", "running_header")}
    joins = {e["line"]: e for e in edits if e["kind"] == "hyphen_break"}
    right = {e["a"]: e["b"] for e in edits if e["kind"] == "misread" and e["b"]}
    kept: list[str] = []
    gap = False
    glue = ""
    for i, x in enumerate(ls):
        if i in drop:
            gap = True
            continue
        x = x.rstrip()
        if not x and (gap or glue):
            continue
        gap = False
        if glue and x:
            m = START.match(x)
            kept[-1] += m["word"] if m else x
            x = x[m.end() :].lstrip() if m else ""
            # punctuation belongs to the word that was cut
            while x and x[0] in ".,;:)":
                kept[-1] += x[0]
                x = x[1:].lstrip()
            glue = ""
        if i in joins:
            b = BREAK.search(x)
            if b:
                x = x[: b.start("sign")] + ("-" if joins[i]["a"].endswith("-") else "")
                glue = "yes"
        if x or not kept or kept[-1]:
            kept.append(x)
    body = [x for x in kept if x and not MARKED.match(x)]
    wrapped = len(body) > 2 and sum(not x.endswith((".", ":", "।")) for x in body[:-1]) >= 0.5 * (len(body) - 1)
    if wrapped:
        out: list[str] = []
        for x in kept:
            plain = x and not MARKED.match(x)
            if plain and out and out[-1] and not MARKED.match(out[-1]) and not (heading_like(out[-1]) and out[-1].upper() == out[-1]):
                out[-1] += " " + x.strip()
            else:
                out.append(x.strip() if plain else x)
        kept = out
    done = "\n".join(kept)
    if right:
        done = re.sub(rf"(?<![\w-])(?:{WORD.pattern})(?![\w-])", lambda m: _cased(m[0], right[m[0].lower()]) if m[0].lower() in right else m[0], done)
    return done


def _cased(old: str, new: str) -> str:
    return new.upper() if old.isupper() else new.capitalize() if old[0].isupper() else new


def _inputs(spark, sf):
    from lexgrain.session import load

    s = load(spark, sf, "sections").select(F.col("section_id").alias("id"), F.col("document_id").alias("doc"), "text", F.col("page_numbers").alias("pages"))
    p = load(spark, sf, "parsed_documents")
    titles = p.select(F.col("document_id").alias("doc"), F.explode(F.array_compact(F.array("title", "act_name", "court", "parties"))).alias("h"))
    return s, titles.groupBy("doc").agg(F.collect_set("h").alias("heads"))


def p2_found(spark, sf):
    return traces(*_inputs(spark, sf)).select(F.col("id").alias("section_id"), F.col("kind").alias("noise")).distinct()


def p2_repaired(spark, sf):
    """Whole sections with their repaired text; a section delivered twice comes once."""
    s, titles = _inputs(spark, sf)
    edits = traces(s, titles).groupBy("id").agg(F.collect_set(F.struct("kind", "line", "a", "b")).alias("edits"))
    once = s.where("id is not null").groupBy("id").agg(F.max("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"section_id": b["id"], "text": [repair(t, list(e)) if t and e is not None else t for t, e in zip(b["text"], b["edits"])]})

    return once.join(edits, "id", "left").mapInPandas(run, "section_id string, text string")


QUERIES = {"p2_found": (p2_found, None), "p2_repaired": (p2_repaired, None)}
