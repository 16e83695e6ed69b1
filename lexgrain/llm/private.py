"""Personal information in free text.

Patterns propose spans, checksum validators confirm numbers, words nearby raise
or lower the score, and spans whose score reaches the threshold are reported and
replaced by typed placeholders.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.session import collect_bounded

THRESHOLD = 0.5

#: digits of Devanagari stand for themselves in numbers; same length, so that places stay
DIGITS = str.maketrans("०१२३४५६७८९", "0123456789")

# fixed values: the Verhoeff scheme's multiplication in D5 and its permutation
_D5 = ("0123456789", "1234067895", "2340178956", "3401289567", "4012395678", "5987604321", "6598710432", "7659821043", "8765932104", "9876543210")
_PERM = "1576283094"


def luhn(digits: str) -> bool:
    """Check digit of payment cards."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return len(digits) > 1 and (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def mod97(code: str) -> bool:
    """ISO 7064 check of account numbers: the first four signs go to the end."""
    turned = code[4:] + code[:4]
    return turned.isalnum() and turned.isascii() and len(code) > 4 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def verhoeff(digits: str) -> bool:
    """Check digit of twelve-digit identity numbers."""
    c = 0
    for i, x in enumerate(reversed(digits)):
        for _ in range(i % 8):
            x = _PERM[int(x)]
        c = int(_D5[c][int(x)])
    return c == 0


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    score: float


EMAIL = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9](?:[\w.%+-]*[\w%+-])?(?:@|\s?[(\[]\s?at\s?[)\]]\s?|\s@\s)"
    r"[A-Za-z0-9-]+(?:(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?)[A-Za-z0-9-]+)*(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?)[A-Za-z]{2,}(?![\w-])",
    re.I | re.A,
)
PHONE = re.compile(
    r"(?<![\w+/.-])(?:(?P<cc>\+\s?91|0091)[\s.-]?\(?\d{2,5}\)?[\s.-]?\d{3,5}(?:[\s.-]?\d{2,5})?"
    r"|(?P<area>\(0\d{2,4}\)|0\d{2,4}(?=[\s-]))[\s-]?\d{3,4}[\s-]?\d{3,4}"
    r"|\d{5}[.\s-]\d{5}|\d{10})(?![\w/-]|\.\d)",
    re.A,
)
ID = re.compile(
    r"(?<![\w+/-])(?:(?P<card>\d{4}(?P<s2>[ -]?)\d{4}(?P=s2)\d{4}(?P=s2)\d{4})|(?P<twelve>\d{4}(?P<sep>[ -]?)\d{4}(?P=sep)\d{4})|(?P<pan>[A-Z]{5}\d{4}[A-Z])"
    r"|(?P<licence>[A-Z]{2}-\d{2}-\d{4}-\d{7})|(?P<voter>[A-Z]{3}\d{7})|(?P<iban>[A-Z]{2}\d{2}[A-Z0-9]{11,30}))(?![\w/-]|\.\d)",
    re.A,
)
ID_YES = re.compile(r"\b(?:identity|id|uid|pan|passport|licen[cs]e|voter|aadhaar|card|holds|ssn|iban|account)\b|पहचान|आधार", re.I)
ID_NO = re.compile(r"\b(?:diary|challan|cnr|receipt|survey|case|petition|appeal|file|gsr|gazette|invoice|docket)\b(?:\s+(?:no|number)s?\b\.?)?[\s:#-]*$", re.I)
PHONE_YES = re.compile(r"\b(?:call|phone|tel|telephone|mob|mobile|m|ph|over|again|contact|fax|whatsapp)\b|संपर्क|दूरभाष|फ़?ोन|मोबाइल", re.I)
ADDRESS = re.compile(
    r"(?<![\w/,.-])(?P<lead>(?:H\.?\s?No\.?|House(?:\s+No\.?)?|Flat(?:\s+No\.?)?|Plot(?:\s+No\.?)?|Door(?:\s+No\.?)?|D\.?\s?No\.?|Apartment|Apt\.?|Shop(?:\s+No\.?)?|Quarters?(?:\s+No\.?)?)\s*)?"
    r"\d+(?:\s?[A-Z])?(?:[/-]\s?\d+[A-Z]?)*\s*,\s*(?P<body>[^\d]{5,160}?)(?P<pin>\d{3}\s?\d{3})(?!\d)",
    re.I | re.A,
)
STREET = re.compile(r"\b(?:Road|Rd|Street|St|Lane|Marg|Cross|Nagar|Layout|Enclave|Colony|Path|Bazaar|Avenue|Main|Gali|Chowk|Dist|PIN)\b", re.I)
TITLE = r"(?:Shri|Sri|Shrimati|Smt|Mr|Ms|Mrs|Dr|Km|Kum|Adv|Advocate|Prof|Er|Justice|Miss)\b\.?"
TITLED = re.compile(r"\b" + TITLE + r"\s+(?P<name>(?:[A-Z]\.\s?){0,3}[A-Z][A-Za-z'’]+(?:\s+(?:[A-Z]\.\s?){0,2}[A-Z][A-Za-z'’]+){0,2})")
BEFORE_TITLE = re.compile(r"\b" + TITLE + r"\s+$")
TRIGGER = re.compile(r"(?:\bsigned\s+by|\bwitness,|\btold\s+by|\bContact:|\bthough|\b[sdw]/o|\b(?:son|daughter|wife|widow)\s+of|\bname\s+of|\bexamined|\bsummons\s+to|\bstatement\s+of|\bComplaint\s+of|\bBefore:|\band)\s+$", re.I)
MIDDLE = r"(?:Kumar|Das|Dev|Lal|Prasad|Narayan|Chandra|Nath|Mohan|Bai|Devi|Singh|Rani|Ram)"
LEAD = re.compile(r"(?:(?<![\w.-])(?P<given>[A-Za-z]{2,})\s+(?:(?P<middle>" + MIDDLE + r"|[A-Za-z]\.(?:\s?[A-Za-z]\.)?)\s+)?|(?<![\w.])(?P<initials>(?:[A-Z]\.\s?){1,3}))$", re.I)
WORD = re.compile(r"(?<![\w])[A-Za-z]{3,}")
BOUND = re.compile(r"[\w@+-]|\.\w", re.A)
MIDDLE_ONLY = re.compile(MIDDLE + r"$", re.I)
AFTER_COMMA = re.compile(r",\s+(?P<given>[A-Za-z]{2,}(?:\s+(?:" + MIDDLE + r"|[A-Z]\.))?)(?=\s*[,.;:(]|\s+[a-z(]|\s*$)")
FOLLOWED = re.compile(r"\s*\((?:[PDC]W-\d+|ID\b)|\s+v(?:s|ersus)?\.?\s|,\s+(?:aged|r/o|[sdw]/o|(?:son|daughter|wife|widow)\s+of)\b|\s+(?:appeared|deposed|paid|over\s+[+(\d])|,\s+(?:Member|Registrar|on\s+\d)", re.I)
ORG = re.compile(r"\s+(?:&|and\s+Sons|Sons|Memorial|Trust|Ltd|Pvt|LLP|Brothers|Bros|Enterprises|Foundation|Mills|Nagar|Act|Street|Road)\b|\s*&")
#: words that stand before a surname without being a given name
NOT_GIVEN = frozenset("the a an and of in on by to for at from with under though over before that this between act state court messrs m/s member registrar shri sri smt mr ms mrs dr km kum adv prof justice".split())


class Names:
    """What name parts look like: the lexicon's words, and the endings that its
    surnames share (an ending counts if at least ``share`` of them have it)."""

    def __init__(self, given: set[str], surnames: set[str], share: float = 0.02):
        self.given = {g.lower() for g in given}
        self.surnames = {s.lower() for s in surnames}
        ends = Counter(s[-n:] for s in self.surnames for n in range(3, 7) if len(s) > n + 2)
        least = max(3, share * len(self.surnames))
        keep = {e: c for e, c in ends.items() if c >= least}
        # the longest form that nearly all words with an ending share, and of these the shortest
        full = [e for e, c in keep.items() if not any(o.endswith(e) and o != e and n >= 0.8 * c for o, n in keep.items())]
        self.endings = sorted((e for e in full if not any(o != e and e.endswith(o) for o in full)), key=len, reverse=True)
        self.tails = tuple(self.endings)

    def surname_like(self, t: str) -> Iterator[re.Match]:
        """Words that are surnames or end like them, and aren't part of an
        address on the net or of a compound."""
        for m in WORD.finditer(t):
            w = m[0].lower()
            if (w.endswith(self.tails) and self.tails or w in self.surnames) and not BOUND.match(t, m.end()) and (m.start() == 0 or t[m.start() - 1] not in "@.+-_"):
                yield m

    def find(self, t: str) -> Iterator[Span]:
        for m in TITLED.finditer(t):
            if not ORG.match(t, m.end()):
                yield Span(m.start("name"), m.end("name"), "name", 0.8)
        for m in self.surname_like(t):
            a, b = m.span()
            if ORG.match(t, b):
                continue
            word = m[0]
            sure = 0.2 if word.lower() in self.surnames else 0.0
            pre = t[max(0, a - 60) : a]
            cap = word[0].isupper()
            lead = LEAD.search(pre)
            given, first_at = (lead["given"], lead.start()) if lead else (None, 0)
            if given and (given.lower() in NOT_GIVEN or (given.islower() and (lead["middle"] or "x")[0].isupper())):
                # what stands before is no name: a middle name may be the given one
                given, first_at = (lead["middle"], lead.start("middle")) if lead["middle"] and "." not in lead["middle"] else (None, 0)
                lead = lead if given else None
            if lead and lead["given"] and MIDDLE_ONLY.match(lead["given"]) and lead["given"].lower() not in self.given:
                longer = re.search(r"(?<![\w.-])([A-Za-z]{2,})\s+$", pre[: lead.start()])
                if longer and longer[1].lower() in self.given:
                    yield Span(a - (len(pre) - longer.start()), b, "name", 0.9)
                    continue
            if lead and given:
                start = a - (len(pre) - first_at)
                before = pre[:first_at]
                score = 0.25 + sure + 0.4 * (given.lower() in self.given or bool(MIDDLE_ONLY.match(given))) + 0.3 * bool(TRIGGER.search(before)) + 0.3 * bool(BEFORE_TITLE.search(before))
                score += 0.3 * bool(FOLLOWED.match(t, b))
                score += 0.25 if cap and given[0].isupper() and (word.isupper() == given.isupper()) else -0.1
                if score >= THRESHOLD:
                    yield Span(start, b, "name", min(score, 1.0))
                    continue
            if lead and lead["initials"] and (cap or sure):
                before = pre[: lead.start()]
                yield Span(a - (len(pre) - lead.start()), b, "name", 0.3 + sure + 0.4 * bool(BEFORE_TITLE.search(before)))
                continue
            after = AFTER_COMMA.match(t, b)
            if after:
                first = after["given"].split()[0].lower()
                score = 0.2 + sure + 0.4 * (first in self.given) + 0.3 * bool(TRIGGER.search(pre)) + 0.3 * bool(FOLLOWED.match(t, after.end("given")))
                if first not in NOT_GIVEN and score >= THRESHOLD:
                    yield Span(a, after.end("given"), "name", score)
                    continue
            if BEFORE_TITLE.search(pre):
                yield Span(a, b, "name", 0.6 + sure)


def _numbers(t: str) -> Iterator[Span]:
    for m in ID.finditer(t):
        pre = t[max(0, m.start() - 34) : m.start()]
        digits = re.sub(r"\D", "", m[0])
        if m["iban"]:
            score = 0.6 if mod97(m[0]) else 0.0
        elif m["card"]:
            score = 0.3 if luhn(digits) else 0.0
        else:
            score = 0.55 + (0.1 if m["twelve"] and verhoeff(digits) else 0.0)
        score += 0.3 * bool(ID_YES.search(pre)) - 0.6 * bool(ID_NO.search(pre))
        yield Span(*m.span(), "id_number", score)
    for m in PHONE.finditer(t):
        digits = re.sub(r"\D", "", m[0])
        if not 9 <= len(digits) <= 14:
            continue
        pre = t[max(0, m.start() - 26) : m.start()]
        score = 0.35 + 0.3 * bool(m["cc"] or m["area"]) + 0.3 * bool(PHONE_YES.search(pre)) - 0.6 * bool(ID_NO.search(pre))
        yield Span(*m.span(), "phone", score)


def find(text: str, names: Names) -> list[Span]:
    """Accepted spans in order, without overlaps: addresses and e-mails before
    numbers before names, then by score and length."""
    t = text.translate(DIGITS)
    spans = []
    if "@" in t or "at" in t:
        spans += [Span(*m.span(), "email", 0.9) for m in EMAIL.finditer(t)]
    for m in ADDRESS.finditer(t):
        pre = t[max(0, m.start() - 30) : m.start()]
        score = 0.3 + 0.3 * bool(m["lead"]) + 0.3 * bool(STREET.search(m["body"])) + 0.2 * bool(re.search(r"\b(?:r/o|resid\w+|address|service|at)\b", pre, re.I)) - 0.5 * (". " in re.sub(r"\b\w{1,4}\. ", "", m["body"]))
        spans.append(Span(*m.span(), "address", score))
    spans += _numbers(t)
    spans += names.find(t)
    rank = {"email": 0, "address": 0, "id_number": 1, "phone": 1, "name": 2}
    taken: list[Span] = []
    for s in sorted((s for s in spans if s.score >= THRESHOLD), key=lambda s: (rank[s.kind], -s.score, s.start - s.end, s.start)):
        if all(s.end <= o.start or s.start >= o.end for o in taken):
            taken.append(s)
    return sorted(taken)


def redact(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    for s in spans:
        out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = s.end
    return "".join(out) + text[at:]


def personal_information(df: DataFrame, id_col: str, text_col: str, given: set[str], surnames: set[str]) -> DataFrame:
    """(id, redacted, items): ``items`` an array of (kind, found, start, score).

    ``found`` is the item exactly as it stands. Null texts stay null with no
    items, empty texts empty; rows are kept one by one, repeated or with null
    ids; ties between proposals go to the longer, then the earlier span; other
    columns aren't read. ``given`` and ``surnames`` come from a table of fixed
    size and go to the workers with the function.
    """
    names = Names(given, surnames)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, items = [], []
            for t in b["text"]:
                s = find(t, names) if t else []
                texts.append(redact(t, s) if s else t)
                items.append([{"kind": x.kind, "found": t[x.start : x.end], "start": x.start, "score": float(x.score)} for x in s])
            yield pd.DataFrame({"id": b["id"], "redacted": texts, "items": items})

    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]
    schema = f"id {kind}, redacted string, items array<struct<kind: string, found: string, start: int, score: double>>"
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, schema)


def lexicon(table: DataFrame) -> tuple[set[str], set[str]]:
    """Given names with their familiar forms, and surnames, of name_lexicon (a
    table of fixed size)."""
    rows = collect_bounded(table.select("token", "role", "short_form"), 100_000)
    given = {x for r in rows if r["role"] == "given" for x in (r["token"], r["short_form"]) if x}
    return given, {r["token"] for r in rows if r["role"] == "surname" and r["token"]}


def _p10(spark, sf):
    from lexgrain.session import load

    return personal_information(load(spark, sf, "documents"), "doc_id", "text", *lexicon(load(spark, sf, "name_lexicon")))


def p10_found(spark, sf):
    out = _p10(spark, sf).select("id", F.explode("items").alias("i"))
    return out.select(F.col("id").alias("doc_id"), "i.kind", "i.found").distinct()


def p10_redacted(spark, sf):
    return _p10(spark, sf).select(F.col("id").alias("doc_id"), F.col("redacted").alias("text"), F.size("items").alias("items"))


QUERIES = {"p10_found": (p10_found, None), "p10_redacted": (p10_redacted, None)}
