"""Model-backed stages behind pluggable providers.

A provider is a small picklable object with ``complete(prompt) -> str`` or
``embed(texts) -> list of vectors``; it is opened once a task. The stand-ins here
need no model and no network: they are deterministic, so that dataflow and tests
don't depend on a service, and they make no claim to quality.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexgrain.operators.corpus import token_windows


class Completer(Protocol):
    def complete(self, prompt: str) -> str: ...


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray: ...


class TemplateCompleter:
    """Answers from the prompt alone: its first sentence, or questions about its
    longest words, or its sentences as statements."""

    def complete(self, prompt: str) -> str:
        task, _, body = prompt.partition("\n")
        sentences = [s.strip() for s in re.split(r"(?<=[.!?])\s+", body) if s.strip()]
        if task.startswith("questions"):
            words = sorted(set(re.findall(r"[A-Za-z]{5,}", body)), key=lambda w: (-len(w), w))[:5]
            return "\n".join(f"What is said about {w.lower()}?" for w in words)
        if task.startswith("claims"):
            return "\n".join(sentences)
        return sentences[0] if sentences else ""


class HashEmbedder:
    """Signed sums of hashed words, of length one."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dims))
        for r, t in enumerate(texts):
            for w in re.findall(r"[a-z0-9]+", (t or "").lower()):
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                out[r, h % self.dims] += 1 if h >> 63 else -1
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(n > 0, n, 1)


REGISTRY: dict[str, Callable[[], object]] = {"template": TemplateCompleter, "hash": HashEmbedder}


def provider(name: str) -> Callable[[], object]:
    """The maker of a provider by name; an unknown name is an error."""
    if name not in REGISTRY:
        raise KeyError(f"unknown provider {name!r}; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def for_component(component: str, config: dict[str, str]) -> Callable[[], object]:
    """The maker that a configuration names for a component, or its ``default``; a
    component without either, or an unknown provider, is an error."""
    name = config.get(component) or config.get("default")
    if not name:
        raise KeyError(f"no provider for {component!r}, and no default")
    return provider(name)


def complete(df: DataFrame, prompt: str, out: str, make: Callable[[], Completer]) -> DataFrame:
    """Adds ``out`` and ``error``: one call per row; a failed call is an error of
    its row, null prompts stay null."""
    cols = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = make()
        for b in batches:
            got, err = [], []
            for t in b[prompt]:
                try:
                    got.append(p.complete(t) if t is not None else None)
                    err.append(None)
                except Exception as e:  # noqa: BLE001 - the provider may fail in any way
                    got.append(None)
                    err.append(f"{type(e).__name__}: {e}")
            yield b.assign(**{out: got, "error": err})

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    return df.mapInPandas(run, f"{schema}, `{out}` string, error string").select(*cols, out, "error")


def contexts(chunks: DataFrame, make: Callable[[], Completer], size: int = 180_000, overlap: int = 500) -> DataFrame:
    """(id, text, contextualized, error): a line of context, a blank line, and the text.

    chunks(id, document_id, chunk_index, text). The prompt holds the window of the
    document's text that the chunk belongs to, and the chunk; a task holds one window
    at a time. A chunk whose call fails, or without text, stays as it is.
    """
    c = chunks.withColumn("tokens", F.expr("coalesce(length(text), 0) div 4"))
    w = token_windows(c, size, overlap).withColumn("w", F.explode(F.array_compact(F.array("window", "other"))))
    kinds = dict(chunks.dtypes)

    def run(g: pd.DataFrame) -> pd.DataFrame:
        p = make()
        g = g.sort_values(["start", "id"])
        whole = "\n\n".join(t for t in g["text"] if t)
        out = []
        for i, t in g.loc[g["w"] == g["window"], ["id", "text"]].itertuples(index=False):
            context = error = None
            if t:
                try:
                    context = p.complete(f"context\n{whole}\n\n<chunk>\n{t}")
                except Exception as e:  # noqa: BLE001 - the provider may fail in any way
                    error = f"{type(e).__name__}: {e}"
            out.append((i, t, f"{context}\n\n{t}" if context else None, error))
        return pd.DataFrame(out, columns=["id", "text", "contextualized", "error"])

    return w.select("id", "document_id", "start", "window", "w", "text").groupBy("document_id", "w").applyInPandas(run, f"id {kinds['id']}, text string, contextualized string, error string")


def questions(chunks: DataFrame, make: Callable[[], Completer], most: int = 5) -> DataFrame:
    """(id, q, question): lines of the answer that are questions or longer than 20
    characters, numbered from 0."""
    p = chunks.select("id", F.concat(F.lit("questions\n"), F.coalesce("text", F.lit(""))).alias("prompt"))
    c = complete(p, "prompt", "answer", make)
    lines = F.slice(F.filter(F.transform(F.split("answer", "\n"), F.trim), lambda x: F.contains(x, F.lit("?")) | (F.length(x) > 20)), 1, most)
    return c.select("id", F.posexplode(lines).alias("q", "question"))


def embed(df: DataFrame, id_col: str, text_col: str, make: Callable[[], Embedder], batch: int = 256) -> DataFrame:
    """(id, v): a vector per text; null texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = make()
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                yield pd.DataFrame({"id": part["id"], "v": [x.astype(np.float32) for x in p.embed(part["t"].tolist())]})

    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t is not null")
    return src.mapInPandas(run, f"id {dict(src.dtypes)['id']}, v array<float>")


def late_chunks(docs: DataFrame, make: Callable[[], Embedder], size: int = 200, window: int = 512, overlap: int = 64) -> DataFrame:
    """(id, piece, v): words are embedded in overlapping windows of the whole text,
    vectors of words in several windows are averaged, and a piece is the mean of
    its words. docs(id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = make()
        for b in batches:
            rows = []
            for i, t in zip(b["id"], b["text"]):
                words = (t or "").split()
                if not words:
                    continue
                total, n = np.zeros((len(words), p.dims)), np.zeros((len(words), 1))
                for at in range(0, len(words), window - overlap):
                    part = words[at : at + window]
                    total[at : at + len(part)] += p.embed(part) * 0.9 + p.embed([" ".join(part)]) * 0.1
                    n[at : at + len(part)] += 1
                    if at + window >= len(words):
                        break
                v = total / n
                rows += [(i, k // size, v[k : k + size].mean(axis=0).astype(np.float32)) for k in range(0, len(words), size)]
            yield pd.DataFrame(rows, columns=["id", "piece", "v"])

    src = docs.select("id", "text")
    return src.mapInPandas(run, f"id {dict(src.dtypes)['id']}, piece int, v array<float>")


def semantic_pieces(text: str, embedder: Embedder, most: int, alike: float = 0.75) -> list[str]:
    """Recursive cutting by ever finer separators, then joining of neighbours that
    are alike and fit; what is still too long is cut where neighbouring sentences
    are least alike, and at last by length. Blank text has no pieces."""
    if not text.strip():
        return []

    def fine(t: str, seps: list[str]) -> list[str]:
        if len(t) <= most or not seps:
            return [t] if len(t) <= most else least_alike(t)
        parts = [p for p in t.split(seps[0]) if p.strip()]
        return [q for p in parts for q in (fine(p, seps[1:]) if len(p) > most else [p])]

    def least_alike(t: str) -> list[str]:
        s = [x for x in re.split(r"(?<=[.!?।])\s+", t) if x]
        if len(s) < 2:
            return [t[i : i + most] for i in range(0, len(t), most)]
        v = embedder.embed(s)
        k = int(np.argmin((v[:-1] * v[1:]).sum(1))) + 1
        return [q for half in (" ".join(s[:k]), " ".join(s[k:])) for q in ([half] if len(half) <= most else least_alike(half))]

    parts = fine(text, ["\n\n\n", "\n\n", "\n", ". "])
    v = embedder.embed(parts)
    out, last = [parts[0]], v[0]
    for p, x in zip(parts[1:], v[1:]):
        if float(last @ x) > alike and len(out[-1]) + 1 + len(p) <= most:
            out[-1] += "\n" + p
            last = embedder.embed([out[-1]])[0]
        else:
            out.append(p)
            last = x
    return out


def semantic_chunks(docs: DataFrame, make: Callable[[], Embedder], most: int = 6000, alike: float = 0.75) -> DataFrame:
    """(id, piece, text) by :func:`semantic_pieces`; blank texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = make()
        for b in batches:
            rows = [(i, k, p) for i, t in zip(b["id"], b["text"]) if t and t.strip() for k, p in enumerate(semantic_pieces(t, e, most, alike))]
            yield pd.DataFrame(rows, columns=["id", "piece", "text"])

    src = docs.select("id", "text")
    return src.mapInPandas(run, f"id {dict(src.dtypes)['id']}, piece int, text string")


def maxmin_pieces(text: str, embedder: Embedder, most: int = 6000, least: int = 200, share: float = 25) -> list[str]:
    """Groups of sentences between the places where neighbours are less alike than the
    ``share`` percentile of all neighbours; a group shorter than ``least`` characters
    joins the one before where both fit, one longer than ``most`` is cut."""
    s = [x.strip() for x in re.split(r"(?<=[.!?])\s+", text) if x.strip()]
    if not s:
        return []
    v = embedder.embed(s)
    alike = (v[:-1] * v[1:]).sum(1)
    low = np.percentile(alike, share) if len(alike) else 0.0
    groups = [[s[0]]]
    for x, a in zip(s[1:], alike):
        groups.append([x]) if a < low else groups[-1].append(x)
    out: list[str] = []
    for g in (" ".join(g) for g in groups):
        if out and len(g) < least and len(out[-1]) + 1 + len(g) <= most:
            out[-1] += " " + g
        else:
            out.append(g)
    return [p[i : i + most] for p in out for i in range(0, len(p), most)]


def maxmin_chunks(docs: DataFrame, make: Callable[[], Embedder], most: int = 6000, least: int = 200) -> DataFrame:
    """(id, piece, text) by :func:`maxmin_pieces`; blank texts have none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = make()
        for b in batches:
            rows = [(i, k, p) for i, t in zip(b["id"], b["text"]) if t and t.strip() for k, p in enumerate(maxmin_pieces(t, e, most, least))]
            yield pd.DataFrame(rows, columns=["id", "piece", "text"])

    src = docs.select("id", "text")
    return src.mapInPandas(run, f"id {dict(src.dtypes)['id']}, piece int, text string")


def align_claims(answers: DataFrame, evidence: DataFrame, make: Callable[[], Completer], supported: float = 0.6, partly: float = 0.3, most: int | None = 50) -> DataFrame:
    """(id, claim_no, claim, finding, best): statements of an answer against the
    evidence texts of the same id; the share of a statement's words that the best
    text has decides. Statements without evidence are unsupported. The first ``most``
    statements of an answer count, or all.
    answers(id, text), evidence(id, chunk, text)."""
    from lexgrain.functions.text import tokens

    p = answers.select("id", F.concat(F.lit("claims\n"), F.coalesce("text", F.lit(""))).alias("prompt"))
    said = F.filter(F.split("claims", "\n"), lambda x: F.trim(x) != "")
    c = complete(p, "prompt", "claims", make).select("id", F.posexplode(F.slice(said, 1, most) if most is not None else said).alias("claim_no", "claim"))
    w = F.array_distinct(tokens(F.col("claim")))
    j = c.join(evidence.select("id", "chunk", F.col("text").alias("ev")), "id", "left")
    share = F.when(F.size(w) > 0, F.size(F.array_intersect(w, tokens(F.coalesce("ev", F.lit(""))))) / F.size(w)).otherwise(0.0)
    g = j.withColumn("share", share).groupBy("id", "claim_no", "claim").agg(F.round(F.max("share"), 6).alias("share"), F.max_by("chunk", F.struct("share", "chunk")).alias("best"))
    finding = F.when(F.col("share") >= supported, "supported").when(F.col("share") >= partly, "partial").otherwise("unsupported")
    return g.select("id", "claim_no", "claim", finding.alias("finding"), "best", "share")


def flare(segments: DataFrame, search: Callable[[DataFrame], DataFrame], have: DataFrame, low: float = 0.5, rounds: int = 5, top: int = 5) -> DataFrame:
    """Further retrieval for segments of low confidence.

    segments(query, seg, text, confidence): those below ``low`` (a missing
    confidence isn't low), at most ``rounds`` a query, lowest first, are searched
    again; their ``top`` hits that the query doesn't have yet are given as
    (query, id). ``search`` takes (query, text) and gives (query, id, rank).
    """
    from pyspark.sql import Window as W

    w = W.partitionBy("query").orderBy("confidence", "seg")
    ask = segments.where(F.col("confidence") < low).withColumn("n", F.row_number().over(w)).where(F.col("n") <= rounds)
    key = F.concat_ws("#", F.col("query").cast("string"), F.col("seg").cast("string"))
    hits = search(ask.select(key.alias("query"), "text")).where(F.col("rank") <= top)
    hits = hits.join(ask.select(key.alias("k"), F.col("query").alias("q")), F.col("query") == F.col("k")).select(F.col("q").alias("query"), "id").distinct()
    return hits.join(have.select("query", "id").distinct(), ["query", "id"], "left_anti")
