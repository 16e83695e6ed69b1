"""Variant spellings of names: records that mean the same one.

Records are parsed into parts, blocked by phonetic codes of their sorted words,
compared within a block by Jaro-Winkler similarity together with a table of
familiar forms, and accepted pairs are clustered by connected components.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.operators.components import connected_components
from lexgrain.session import collect_bounded, cut, joined

# ---------------------------------------------------------------- words


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    reach = max(max(la, lb) // 2 - 1, 0)
    used, ma = [False] * lb, []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(lb, i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                ma.append(x)
                break
    m = len(ma)
    if not m:
        return 0.0
    half = sum(x != y for x, y in zip(ma, (y for y, u in zip(b, used) if u))) / 2
    jaro = (m / la + m / lb + (m - half) / m) / 3
    p = 0
    while p < min(4, la, lb) and a[p] == b[p]:
        p += 1
    return jaro + p * 0.1 * (1 - jaro)


def one_edit(a: str, b: str) -> bool:
    """At most one letter put in, left out or changed, or two neighbours swapped."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (len(x) > 1 and len(y) > 1 and x[:2] == y[1::-1] and x[2:] == y[2:])


@lru_cache(200_000)
def sound(word: str) -> str:
    """A spelling in which forms that sound alike are equal."""
    w = word.replace("ee", "i").replace("oo", "u").replace("ph", "f").replace("w", "v")
    return re.sub(r"(.)\1+", r"\1", w)


@lru_cache(200_000)
def code(word: str) -> str:
    """Phonetic code: consonants by groups that are confused, runs once."""
    w = re.sub(r"[aeiouh]", "", sound(word)).translate(str.maketrans("cqzxgjdbmy", "kksskstpnj"))
    return re.sub(r"(.)\1+", r"\1", w)


@lru_cache(500_000)
def close(a: str, b: str) -> bool:
    """The same word but for one slip or its sound."""
    if a == b or sound(a) == sound(b):
        return True
    return min(len(a), len(b)) > 2 and (one_edit(a, b) or one_edit(sound(a), sound(b))) and jaro_winkler(a, b) >= 0.8 or (min(len(a), len(b)) > 5 and jaro_winkler(a, b) >= 0.955)


@lru_cache(200_000)
def slips(word: str) -> tuple[str, ...]:
    """The phonetic skeleton of a word (the consonants of its sound) and all that it
    becomes without one of its letters: words one slip apart share one."""
    c = re.sub(r"[aeiouh]", "", sound(word))
    return (c, *sorted({c[:i] + c[i + 1 :] for i in range(len(c))} - {c})) if len(c) > 2 else (c,)


# ------------------------------------------------------------- blocking


def link(records: DataFrame, same: Callable[[dict, dict], bool]) -> DataFrame:
    """Edges (src, dst) between records that ``same`` accepts.

    records(id long, sig string, keys array<string>): ``sig`` the parsed parts as
    JSON. Records of equal parts hang on their smallest id and are compared once,
    so a spelling that a third of all rows have makes one row in its blocks; the
    others meet only within a block.
    """
    reps = cut(records.groupBy("sig").agg(F.min("id").alias("id"), F.first("keys").alias("keys")))
    hang = joined(records, reps.select("sig", F.col("id").alias("rep")), "sig").where("id <> rep").select(F.col("id").alias("src"), F.col("rep").alias("dst"))
    # blocks hold ids alone; the parts are fetched for the pairs that meet
    k = reps.select("id", F.explode(F.array_distinct("keys")).alias("key"))
    pairs = joined(k.select("key", F.col("id").alias("i")), k.select("key", F.col("id").alias("j")), "key").where("i < j").select("i", "j").distinct()
    parts = reps.select("id", "sig")
    pairs = joined(joined(pairs, parts.select(F.col("id").alias("i"), F.col("sig").alias("s")), "i"), parts.select(F.col("id").alias("j"), F.col("sig").alias("t")), "j")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parsed = lru_cache(50_000)(json.loads)
        for x in batches:
            ok = [same(parsed(s), parsed(t)) for s, t in zip(x["s"], x["t"])]
            yield pd.DataFrame({"src": x["i"][ok], "dst": x["j"][ok]})

    return hang.unionByName(pairs.mapInPandas(compare, "src long, dst long"))


def parse(df: DataFrame, columns: list[str], fn: Callable[..., tuple[dict, list[str]] | None]) -> DataFrame:
    """(id, sig, keys) by a function of the other columns; the first is the id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, fn(*rest)) for i, *rest in b.itertuples(index=False)]
            rows = [(i, json.dumps(r[0], sort_keys=True), sorted(set(r[1]))) for i, r in rows if r]
            if rows:
                yield pd.DataFrame(rows, columns=["id", "sig", "keys"])

    return df.select(F.col(columns[0]).cast("long").alias("_id"), *columns[1:]).where("_id is not null").distinct().mapInPandas(run, "id long, sig string, keys array<string>")


# ----------------------------------------------------------------- acts

#: words for the kind of text, and articles
KIND = frozenset("act the adhiniyam of a and".split())
INDIA = frozenset("central india union".split())


def act_parts(states: list[str]) -> Callable:
    low = [s.lower() for s in states]

    def state_of(w: str) -> str | None:
        if w in INDIA:
            return "india"
        return next((s for s in low if s == w), None) or next((s for s in low if close(w, s)), None)

    def fn(name, number, year, jurisdiction):
        name = name or ""
        num = re.search(r"\d+", number or "")
        num_year = re.search(r"(?:of|/)\s*(\d{4})", number or "")
        found = re.search(r"(?<!\d)(1[89]\d\d|20\d\d)(?!\d)", name)
        short = re.search(r"['’](\d\d)\b", name)
        y = int(year) if year == year and year is not None else None
        if y is None and found:
            y = int(found[1])
        if y is None and short:
            y = int(short[1]) + (2000 if int(short[1]) <= 25 else 1900)
        if y is None and num_year:
            y = int(num_year[1])
        letters = re.sub(r"\d+|['’]", " ", name)
        acronym = re.fullmatch(r"\s*((?:[A-Za-z]\.\s?){3,}|[A-Z]{3,})[\s,.]*", letters)
        named = None
        words, extra = [], []
        if not acronym:
            inside = " ".join(re.findall(r"\(([^)]*)\)", letters)).lower()
            for w in re.findall(r"[a-z]+\.?", re.sub(r"co-o(perative)?", r"coo\1", letters.lower())):
                bare = w.rstrip(".")
                if bare in KIND or one_edit(bare, "act") and len(bare) > 2 and bare not in ("cat",):
                    continue
                s = None if w.endswith(".") and len(bare) < 6 else state_of(bare)
                if s and not named:
                    named = s
                elif bare in re.findall(r"[a-z]+", inside):
                    extra.append(bare)
                elif len(bare) > 1:
                    words.append(bare)
            words = sorted(words)
        s = (jurisdiction or "").strip().lower()
        s = (state_of(s) if s else None) or named
        short_name = re.sub(r"[^a-z]", "", acronym[1].lower()) if acronym else ""
        p = {"y": y, "s": s or ("" if acronym else "india"), "n": int(num[0]) if num else None, "w": words, "x": extra, "a": short_name}
        if not words and not short_name:
            return None
        keys = []
        if acronym:
            keys.append(f"a|{y}|{''.join(sorted(short_name))}")
        else:
            at = f"{y}|{p['s']}"
            keys += [f"w|{at}|{code(w)[:2]}" for w in words] + [f"l|{at}|{''.join(code(w)[:1] for w in words)}"]
            initials = "".join(w[0] for w in words + extra)
            lead = "" if p["s"] == "india" else p["s"][0]
            keys += [f"a|{y}|{''.join(sorted(initials + lead + 'a'))}", f"a|{y}|{''.join(sorted(initials + 'a'))}"]
        return p, keys

    return fn


def _stem(a: str, b: str) -> bool:
    """Equal words, or one a shortened form of the other."""
    if close(a, b):
        return True
    s, t = sorted((a, b), key=len)
    if len(s) < 3 or len(s) >= len(t):
        return False
    head = t[: len(s)]
    return head == s or (len(s) > 4 and (one_edit(s, head) or s[:-1] == t[: len(s) - 1]))


def _aligned(a: list[str], b: list[str]) -> bool:
    """Each word has its own partner; few words, so all ways are tried."""
    if len(a) != len(b):
        return False
    if not a:
        return True
    return any(_stem(a[0], y) and _aligned(a[1:], b[:i] + b[i + 1 :]) for i, y in enumerate(b))


def _same_extra(a: list[str], b: list[str]) -> bool:
    """Words in brackets: in order, a shortened form may stop after the first."""
    return not a and not b or bool(a and b) and all(_stem(x, y) for x, y in zip(a, b))


def same_act(p: dict, q: dict) -> bool:
    if p["y"] is None or p["y"] != q["y"]:
        return False
    if p["n"] is not None and q["n"] is not None and p["n"] != q["n"]:
        return False
    agree = p["n"] is not None and p["n"] == q["n"]
    if p["a"] and q["a"]:
        return p["a"] == q["a"] and (p["s"] == q["s"] or not p["s"] or not q["s"] or agree and p["s"] == q["s"])
    if p["a"] or q["a"]:
        if q["a"]:
            p, q = q, p
        if p["s"] and p["s"] != q["s"]:
            return False
        lead = "" if q["s"] == "india" else q["s"][0]
        initials = sorted("".join(w[0] for w in q["w"] + q["x"]))
        with_state = sorted([*initials, *lead, "a"])
        if sorted(p["a"]) == with_state and p["a"].startswith(lead) and p["a"].endswith("a"):
            return True
        return bool(p["s"]) and sorted(p["a"]) == sorted([*initials, "a"])
    if p["s"] != q["s"]:
        return False
    if _aligned(p["w"], q["w"]) and (_same_extra(p["x"], q["x"]) or agree and not (p["x"] and q["x"])):
        return True
    # same number of the same state and year: one word may be spoilt beyond one slip
    return agree and len(p["w"]) == len(q["w"]) > 0 and any(_stem(x, y) for x in p["w"] for y in q["w"]) and (
        sum(max(jaro_winkler(x, y) for y in q["w"]) for x in p["w"]) / len(p["w"]) >= 0.85)


# --------------------------------------------------------------- judges

TITLES = frozenset("hon honble mr ms mrs smt shri sri dr justice chief acting km kumari adv".split())
MIDDLE = frozenset("kumar das dev lal prasad narayan chandra nath mohan bai devi singh rani ram".split())


def judge_parts(given: dict[str, str]) -> Callable:
    """``given``: known given names and familiar forms -> given name, lower case."""
    known = _known(given)
    like = given_like(known)

    cache: dict[str, list[str]] = {}
    # known names by their skeletons less a letter and by their first letters; short skeletons all together
    near: dict[str, set[str]] = {}
    for k in known:
        for v in (*slips(k), f"^{k[:3]}", *(["^"] if len(slips(k)[0]) < 4 else [])):
            near.setdefault(v, set()).add(k)

    def meant(word: str) -> list[str]:
        """A known given name, or those that a word may be a spelling of and its first two sounds (of a short word the first one, too)."""
        if len(cache) > 200_000:
            cache.clear()
        if word not in cache:
            c = slips(word)[0]
            sounds = ["~" + c[:2]] + (["~~" + c[:1]] if len(c) < 3 else [])
            some = {k for v in (*slips(word), f"^{word[:3]}", *(["^"] if len(c) < 4 else [])) for k in near.get(v, ())}
            cache[word] = [word] if word in known else [*(k for k in sorted(some) if like(word, k)), *sounds]
        return cache[word]

    def fn(name):
        text = re.sub(r"['’]", "", name or "")
        text = re.sub(r"[\s,]+(?:C\.?)?J\.?(?:\s+retd\.?)?\s*$", "", text.strip(), flags=re.I)
        upper = text.isupper()
        words, initials = [], []
        raw = [w for w in re.findall(r"[^\W\d_]+", text) if w.lower() not in TITLES]
        for w in raw:
            if len(w) == 1:
                initials.append(w.lower())
            elif w.isupper() and not upper and len(w) <= 3:
                initials += list(w.lower())
            else:
                words.append(w.lower())
        if not words:
            return None
        middle = []
        if len(words) > 2:
            comma = "," in text
            inner = [w for w in words if w in MIDDLE] if comma else [w for w in words[1:-1] if w in MIDDLE] or [w for w in words if w in MIDDLE]
            middle = inner[-1:]
            for w in middle:
                words.remove(w)
        words = sorted(given.get(w, w) for w in words)
        p = {"w": words, "i": initials, "m": middle}
        if len(words) == 1:
            return p, [f"s|{c}" for c in slips(words[0])]
        # the skeleton of the one word, or all but a letter of it, with the known names that the other may be; or the whole skeleton with all but a letter of the other's
        keys = []
        for x, y in permutations(words[:4], 2):
            if x not in known and len(x) > 4:
                names = meant(y)
                keys += [f"n|{v}|{g}" for v in slips(x) for g in names]
                keys += [] if y in known else [f"n|{slips(x)[0]}||{v}" for v in slips(y)]
        return p, keys

    return fn


def _known(given: dict[str, str]) -> frozenset[str]:
    return frozenset(given.values())


def given_like(known: frozenset[str]) -> Callable[[str, str], bool]:
    def fn(a: str, b: str) -> bool:
        if a in known and b in known:
            return a == b
        if close(a, b):
            return True
        s, t = sorted((a, b), key=len)
        # familiar forms that no table has: the start of the name, or its start with a short ending
        return 3 <= len(s) <= 5 and len(t) > len(s) and (t.startswith(s) or (s[:3] == t[:3] and s[-1] in "uiy"))

    return fn


def same_judge(known: frozenset[str]) -> Callable[[dict, dict], bool]:
    like = given_like(known)

    def fn(p: dict, q: dict) -> bool:
        a, b = p["w"], q["w"]
        if len(a) < 2 or len(b) < 2 or len(a) != len(b):
            return False
        mp, mq = [x[0] for x in p["m"]] or p["i"][-1:], [x[0] for x in q["m"]] or q["i"][-1:]
        if mp and mq and mp != mq:
            return False
        if p["m"] and q["m"] and not close(p["m"][0], q["m"][0]):
            return False
        for x, y in ((0, 1), (1, 0)):
            # one word is the surname, the other the given name, in either order
            for u, v in ((0, 1), (1, 0)):
                if close(a[x], b[u]) and len(a[x]) > 4 and a[x] not in known and like(a[y], b[v]):
                    return True
        return False

    return fn


def fits_judge(p: dict, q: dict, known: frozenset[str]) -> int:
    """1 if a surname alone or with initials (p) can be the full name q, -1 if
    only a middle name speaks against it, else 0."""
    s = p["w"][0]
    for i, w in enumerate(q["w"]):
        if w in known and len(q["w"]) > 1 or not close(s, w):
            continue
        rest = [x for j, x in enumerate(q["w"]) if j != i]
        if not p["i"]:
            return 1
        if rest and rest[0][0] != p["i"][0]:
            continue
        middle = [x[0] for x in q["m"]] or q["i"][-1:]
        if len(p["i"]) > 1 and middle and p["i"][-1] != middle[0]:
            return -1
        return 1
    return 0


def judge_edges(recs: DataFrame, known: frozenset[str]) -> DataFrame:
    """Edges between judges' records: full names among themselves, then bare
    surnames and initials with the only judge that they fit."""
    recs = cut(recs)
    one = F.size(F.from_json(F.get_json_object("sig", "$.w"), "array<string>")) == 1
    whole, part = recs.where(~one), recs.where(one)
    edges = cut(link(whole, same_judge(known)))
    comp = connected_components(edges).select(F.col("node").alias("id"), "component")
    members = joined(whole, comp, "id", "left").select("sig", F.coalesce("component", "id").alias("component")).distinct()

    def surname_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for s, c in zip(b["sig"], b["component"]):
                for w in json.loads(s)["w"]:
                    if w not in known:
                        rows += [(s, c, f"s|{v}") for v in slips(w)]
            if rows:
                yield pd.DataFrame(rows, columns=["t", "component", "key"])

    full = members.mapInPandas(surname_keys, "t string, component long, key string")
    bare = part.select("sig", "keys").dropDuplicates(["sig"]).select(F.col("sig").alias("s"), F.explode("keys").alias("key"))
    pairs = joined(bare, full, "key").select("s", "t", "component").distinct()

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parsed = lru_cache(50_000)(json.loads)
        for b in batches:
            yield pd.DataFrame({"s": b["s"], "component": b["component"], "f": [fits_judge(parsed(s), parsed(t), known) for s, t in zip(b["s"], b["t"])]})

    judged = pairs.mapInPandas(fit, "s string, component long, f int").groupBy("s", "component").agg(F.max("f").alias("hi"), F.min("f").alias("lo")).where("hi = 1 and lo >= 0")
    counts = cut(judged.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("component")))
    only = part.join(counts.where("n = 1"), part["sig"] == counts["s"]).select(F.col("id").alias("src"), F.col("component").alias("dst"))
    # those that fit no full name: the same surname with the same initials
    lone = part.join(counts, part["sig"] == counts["s"], "left_anti")
    alike = link(lone, lambda p, q: close(p["w"][0], q["w"][0]) and p["i"][:1] == q["i"][:1] and (len(p["i"]) < 2 or len(q["i"]) < 2 or p["i"] == q["i"]))
    # a bare surname among them whose other holders all have one first initial
    seen = lone.select("id", F.get_json_object("sig", "$.w[0]").alias("w"), F.get_json_object("sig", "$.i[0]").alias("i"))
    held = seen.where("i is not null").groupBy("w").agg(F.min("i").alias("a"), F.max("i").alias("b"), F.min("id").alias("dst")).where("a = b")
    bare_one = seen.where("i is null").join(held, "w").select(F.col("id").alias("src"), "dst")
    return edges.unionByName(only).unionByName(alike).unionByName(bare_one)


# ------------------------------------------------------------ judgments


def citation_keys(forms: list[tuple[str, str, str]]) -> Callable[[str], list[str]]:
    """A function that gives the canonical report citations of a typed text.

    ``forms``: (abbreviation, full form, 'reporter' or 'court') of a fixed table.
    """
    squash = lambda s: re.sub(r"[^a-z]", "", s.lower())
    courts = {}
    reporters = {}
    for abbrev, full, kind in forms:
        for x in (abbrev, full):
            (courts if kind == "court" else reporters)[squash(x)] = abbrev.lower()
    for r in [k for k, v in reporters.items() if v == "scc"]:
        reporters[r + "online"] = "scc online"

    @lru_cache(100_000)
    def court_of(tail: tuple[str, ...]) -> tuple[str, int] | None:
        for n in (1, 2, 3):
            if len(tail) >= n and (w := "".join(tail[-n:])) in courts:
                return courts[w], n
        best = None
        for n in (1, 2, 3):
            if len(tail) < n:
                break
            w = "".join(tail[-n:])
            for c, v in courts.items():
                if len(w) > 2 and len(c) > 2 and (s := jaro_winkler(w, c)) >= 0.87 and (one_edit(w, c) or s >= 0.93) and (best is None or s > best[0]):
                    best = (s, v, n)
        return (best[1], best[2]) if best else None

    @lru_cache(100_000)
    def reporter_of(w: str) -> str | None:
        if w in reporters:
            return reporters[w]
        s, v = max(((jaro_winkler(w, r), v) for r, v in reporters.items()), default=(0, None))
        return v if s >= 0.8 else None

    def year_of(t: str) -> int:
        y = int(t)
        return y if y > 99 else y + (2000 if y <= 25 else 1900)

    def one(text: str) -> str | None:
        t = re.sub(r"\(\s*[A-Za-z]{1,4}\.?\s*\)\s*\.?\s*$", "", text.strip())
        t = re.sub(r"[,:]?\s*\b(?:para|paras|paragraph)\b\.?\s*\d+.*$", "", t, flags=re.I)
        # letters that stand for digits: within a run that also holds a digit
        t = re.sub(r"(?<![A-Za-z])[\dlIoO]*\d[\dlIoO]*(?![A-Za-z])", lambda m: m[0].translate(str.maketrans("lIoO", "1100")), t)
        parts = re.findall(r"\d+|[A-Za-z]+", t)
        numbers = [x for x in parts if x.isdigit()]
        if len(numbers) < 2:
            return None
        last = max(i for i, x in enumerate(parts) if x.isdigit())
        words = [x.lower() for x in parts[:last] if not x.isdigit() and x.lower() not in ("vol", "p", "pp", "page", "volume", "no")]
        # single letters of a dotted abbreviation belong together
        joined: list[str] = []
        run = ""
        for w in words:
            if len(w) == 1:
                run += w
            else:
                joined += [run, w] if run else [w]
                run = ""
        joined += [run] if run else []
        if len(numbers) >= 3:
            rep = reporter_of("".join(joined))
            return f"{rep}|{year_of(numbers[0])}|{int(numbers[1])}|{int(numbers[2])}" if rep else None
        found = court_of(tuple(joined))
        if not found and joined:  # reporter and court without a blank between
            w = "".join(joined)
            for c, v in sorted(courts.items(), key=lambda x: -len(x[0])):
                if w.endswith(c) and reporter_of(w[: -len(c)]):
                    return f"{reporter_of(w[: -len(c)])}|{v}|{year_of(numbers[0])}|{int(numbers[1])}"
            return None
        if not found:
            return None
        rep = reporter_of("".join(joined[: -found[1]]))
        return f"{rep}|{found[0]}|{year_of(numbers[0])}|{int(numbers[1])}" if rep else None

    def fn(text: str | None) -> list[str]:
        return sorted({k for x in re.split(r"[;|=\n]|\s+(?:and|also)\s+", text or "") if (k := one(x))})

    return fn


def judgment_edges(df: DataFrame, id_col: str, citation: str, alternatives: str, forms: list[tuple[str, str, str]]) -> DataFrame:
    """Edges from each row to the smallest row with the same report citation: a
    star for each citation, whatever the number of its rows."""
    c = df.select(F.col(id_col).cast("long").alias("id"), F.explode(F.concat(F.array(citation), F.coalesce(F.col(alternatives), F.array().cast("array<string>")))).alias("c"))
    c = c.where("id is not null and c is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys_of = citation_keys(forms)
        for b in batches:
            rows = [(i, k) for i, t in zip(b["id"], b["c"]) for k in keys_of(t)]
            if rows:
                yield pd.DataFrame(rows, columns=["id", "key"])

    k = cut(c.mapInPandas(run, "id long, key string").distinct())
    low = k.groupBy("key").agg(F.min("id").alias("low"))
    return joined(k, low, "key").where("id <> low").select(F.col("id").alias("src"), F.col("low").alias("dst"))


# -------------------------------------------------------------- queries


def pairs_within(edges: DataFrame) -> DataFrame:
    """(left_id, right_id), left < right: all pairs of a component."""
    c = cut(connected_components(edges))
    a, b = c.select("component", F.col("node").alias("left_id")), c.select("component", F.col("node").alias("right_id"))
    return joined(a, b, "component").where("left_id < right_id").select("left_id", "right_id")


def act_links(spark, sf) -> DataFrame:
    from lexgrain.session import load

    states = sorted({r["state"] for r in collect_bounded(load(spark, sf, "court_list").select("state"), 100_000) if r["state"]})
    recs = parse(load(spark, sf, "acts"), ["act_id", "name", "number", "year", "jurisdiction"], act_parts(states))
    return link(cut(recs), same_act)


def judge_links(spark, sf) -> DataFrame:
    from lexgrain.session import load

    rows = collect_bounded(load(spark, sf, "name_lexicon").where("role = 'given'").select("token", "short_form"), 100_000)
    given = {x.lower(): r["token"].lower() for r in rows for x in (r["token"], r["short_form"]) if x}
    return judge_edges(parse(load(spark, sf, "judges"), ["judge_id", "name"], judge_parts(given)), _known(given))


def judgment_links(spark, sf) -> DataFrame:
    from lexgrain.session import load

    rows = collect_bounded(load(spark, sf, "cite_forms").select("abbrev", "full_form", "kind"), 100_000)
    forms = [(r[0], r[1], r[2]) for r in rows if r[0] and r[1]]
    return judgment_edges(load(spark, sf, "judgments"), "judgment_id", "citation", "alt_citations", forms)


def p1_found(spark, sf):
    """All kinds of records share one run of components: the kind is kept in the
    lowest two bits of the numbers."""
    kinds = (("act", act_links), ("judge", judge_links), ("judgment", judgment_links))
    edges = None
    for k, (_, links) in enumerate(kinds):
        e = links(spark, sf)
        e = e.select(*[(F.shiftleft(F.col(c), 2) + k).alias(c) for c in ("src", "dst")])
        edges = e if edges is None else edges.unionByName(e)
    pairs = pairs_within(edges)
    node = F.element_at(F.array(*[F.lit(n) for n, _ in kinds]), (F.col("left_id").bitwiseAND(F.lit(3)) + 1).cast("int"))
    return pairs.select(node.alias("node"), *[F.shiftright(F.col(c), 2).alias(c) for c in ("left_id", "right_id")])


QUERIES = {"p1_found": (p1_found, None)}
