"""Fetching pages: a replay data source, polite fetching, and page parsing."""

from __future__ import annotations

import hashlib
import os
import re
import time
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class FolderPartition(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class ReplayReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.per_task = int(options.get("filespertask", "64"))

    def partitions(self) -> list[InputPartition]:
        names = sorted(n for n in os.listdir(self.folder) if n.endswith((".html", ".htm", ".txt")))
        return [FolderPartition(names[i : i + self.per_task]) for i in range(0, len(names), self.per_task)] or [FolderPartition([])]

    def read(self, partition: FolderPartition):
        for n in partition.files:
            with open(os.path.join(self.folder, n), "rb") as f:
                body = f.read()
            yield (n, body.decode("utf-8", "replace"), hashlib.sha256(body).hexdigest())


class ReplaySource(DataSource):
    """``spark.read.format("replay").option("path", folder)``: saved pages of a
    crawl as (name, html, content_hash), in place of the network."""

    @classmethod
    def name(cls) -> str:
        return "replay"

    def schema(self) -> str:
        return "name string, html string, content_hash string"

    def reader(self, schema) -> ReplayReader:
        return ReplayReader(self.options)


def fetch(urls: DataFrame, get: Callable[[str], tuple[int, str]], rate: float, tries: int = 3, wait: float = 2.0, most: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(url, status, body, content_hash, error) of each address.

    ``get`` is called on the workers. All addresses of a host go through one
    task, which keeps ``1 / rate`` seconds between calls; failed calls are tried
    again after growing pauses; 429 and other codes from 400 on are errors of
    their row and never end the job.
    """
    if rate <= 0:
        raise ValueError("rate must be positive")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = 0.0
        for b in batches:
            rows = []
            for url in b["url"]:
                status, body, error = None, None, None
                for attempt in range(tries):
                    pause = last + 1 / rate - time.monotonic()
                    if pause > 0:
                        sleep(pause)
                    last = time.monotonic()
                    try:
                        status, body = get(url)
                        error = f"status {status}" if status >= 400 else None
                        break
                    except Exception as e:  # noqa: BLE001 - any failure of the network counts as a try
                        error = f"{type(e).__name__}: {e}"
                        if attempt + 1 < tries:
                            sleep(min(most, wait * 2**attempt))
                ok = error is None
                rows.append((url, status, body if ok else None, hashlib.sha256(body.encode()).hexdigest() if ok else None, error))
            yield pd.DataFrame(rows, columns=["url", "status", "body", "content_hash", "error"])

    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    return urls.select("url").where("url is not null").distinct().repartition(host).mapInPandas(run, "url string, status int, body string, content_hash string, error string")


class _Page(HTMLParser):
    """Text by block, links, and table rows of a page, however broken."""

    SKIP = frozenset(("script", "style", "nav", "noscript", "head"))
    BLOCK = frozenset(("p", "div", "li", "tr", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "br", "section", "article", "blockquote", "pre"))

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.skip, self.title, self.in_title = 0, "", False
        self.text: list[str] = []
        self.links: list[tuple[str, str]] = []
        self.rows: list[list[str]] = []
        self.cell: list[str] | None = None
        self.href: str | None = None
        self.words: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        self.in_title |= tag == "title"
        self.skip += tag in self.SKIP
        if tag in self.BLOCK:
            self.text.append("\n")
        if tag == "tr":
            self.rows.append([])
        if tag in ("td", "th"):
            self.cell = []
        if tag == "a" and a.get("href"):
            self.href, self.words = a["href"], []

    def handle_endtag(self, tag):
        self.in_title &= tag != "title"
        if tag in self.SKIP and self.skip:
            self.skip -= 1
        if tag in ("td", "th") and self.cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        if tag == "a" and self.href:
            self.links.append((self.href, " ".join("".join(self.words).split())))
            self.href = None
        if tag in self.BLOCK:
            self.text.append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if not self.skip:
            self.text.append(data)
            if self.cell is not None:
                self.cell.append(data)
            if self.href:
                self.words.append(data)


def _parsed(html: str) -> _Page:
    p = _Page()
    p.feed(html or "")
    p.close()
    return p


def parse_pages(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, title, text, links array<struct<href, label>>, rows array<array<string>>)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, h in zip(b["id"], b["html"]):
                p = _parsed(h)
                text = re.sub(r"\n\s*\n+", "\n", "\n".join(" ".join(x.split()) for x in "".join(p.text).split("\n"))).strip()
                out.append((i, " ".join(p.title.split()) or None, text, [{"href": x, "label": y} for x, y in p.links], p.rows))
            yield pd.DataFrame(out, columns=["id", "title", "text", "links", "rows"])

    src = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    return src.mapInPandas(run, f"id {dict(src.dtypes)['id']}, title string, text string, links array<struct<href: string, label: string>>, rows array<array<string>>")


def listing_links(parsed: DataFrame, pattern: str, cap: int) -> DataFrame:
    """Addresses of a search listing: links that match, without a trailing slash,
    each at its first place over pages in order, at most ``cap``."""
    e = parsed.select("id", F.posexplode("links").alias("pos", "l")).where(F.col("l.href").rlike(pattern))
    u = e.select(F.regexp_replace("l.href", "/+$", "").alias("url"), F.struct("id", "pos").alias("at"))
    return u.groupBy("url").agg(F.min("at").alias("at")).orderBy("at").limit(cap).select("url")


def browse_rows(parsed: DataFrame) -> DataFrame:
    """Rows of a browse table: (id, enacted, number, title) of rows with four
    cells and more; header rows have no date."""
    r = parsed.select("id", F.explode("rows").alias("r")).where("size(r) >= 4")
    return r.select("id", F.col("r")[0].alias("enacted"), F.col("r")[1].alias("number"), F.col("r")[2].alias("title")).where("enacted rlike '[0-9]'")


def pdf_link(links) -> object:
    """First link to a PDF whose label isn't mostly non-Latin letters."""
    letters = lambda s: F.length(F.regexp_replace(s, "[^\\p{L}]", ""))
    foreign = lambda s: F.length(F.regexp_replace(s, "[^\\p{L}]|[\\u0000-\\u024F]", ""))
    ok = F.filter(links, lambda x: F.lower(x["href"]).rlike("\\.pdf($|\\?)|bitstream") & (foreign(x["label"]) * 2 <= letters(x["label"])))
    return F.try_element_at(ok, F.lit(1))["href"]


def missing_downloads(wanted: DataFrame, cache_dir_files: DataFrame, most_bytes: int = 100 * 1024 * 1024) -> DataFrame:
    """Documents whose file isn't in the cache, or is empty or too large.

    ``cache_dir_files``: (path, length) as the ``binaryFile`` source lists them.
    """
    have = cache_dir_files.where(f"length > 0 and length <= {most_bytes}").select(F.regexp_extract("path", "([^/]+)\\.pdf$", 1).alias("document_id"))
    return wanted.join(have, "document_id", "left_anti")
