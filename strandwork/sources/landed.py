"""Responses and pages of services: fetching them once, and reading what has landed.

Nothing here needs a network but ``land``; all else reads files.
"""

from __future__ import annotations

import re
import time
import urllib.error
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reachable import reachable
from .lines import files_of

TRIES, FIRST_WAIT = 4, 2.0
#: How codes of the human and the veterinary list read.
HUMAN_CODE = r"^[A-Z]\d{0,2}[A-Z]{0,2}\d{0,2}$"
VETERINARY_CODE = r"^Q[A-Z]\d{0,2}[A-Z]{0,2}\d{0,2}$"
CODE_FIELDS = ("atc_code", "name", "ddd", "unit", "adm_r", "note")


def fetch(url: str, tries: int = TRIES, wait: float = FIRST_WAIT, get: Callable = urllib.request.urlopen, sleep: Callable = time.sleep) -> bytes | None:
    """The body of a URL, or None. Busy and failing servers are asked again, each time after twice the wait; a page that is not there is not."""
    for _ in range(tries):
        try:
            with get(url, timeout=20) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            if e.code != 429 and e.code < 500:
                return None
        except OSError:
            pass
        sleep(wait)
        wait *= 2
    return None


def land(requests: DataFrame, pause: float = 0.3, tries: int = TRIES) -> DataFrame:
    """(key, body) of the requests (key, url) that were answered.

    One task asks at a time, with a pause after each request, so that a service
    sees one client. Write the result; it is not to be asked for again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for key, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                body = fetch(url, tries)
                time.sleep(pause)
                if body is not None:
                    got.append((key, body.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.string()) for i in (0, 1)], names=["key", "body"])

    return requests.select("key", "url").coalesce(1).mapInArrow(run, "key string, body string")


def cached_copy(spark: SparkSession, source: str, copy: str, refresh: bool = False) -> str:
    """Copies a file to where it is kept, unless a copy is there already; gives the place of the copy."""
    conf, path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path
    a, b = path(source), path(copy)
    to = b.getFileSystem(conf)
    if refresh or not to.exists(b):
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, to, b, False, True, conf)
    return copy


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(key, body) of landed pages, one file each; the key is the file's name without its last suffix."""
    name = F.regexp_extract(F.url_decode(F.col("_metadata.file_name")), r"^(.*?)(\.[A-Za-z]+)?$", 1)
    return spark.read.text(path, wholetext=True).select(name.alias("key"), F.col("value").alias("body"))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def xml_records(pages: DataFrame, element: str, fields: Sequence[str]) -> DataFrame:
    """(key, place, fields…): every element of that name in the bodies, with the text of the first child of each field's name.

    Namespaces make no difference. A body that is no XML has no elements; a
    field that an element lacks is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    root = ET.fromstring(body or "")
                except ET.ParseError:
                    continue
                for place, e in enumerate(x for x in root.iter() if _local(x.tag) == element):
                    texts = {}
                    for child in e.iter():
                        texts.setdefault(_local(child.tag), (child.text or "").strip())
                    rows.append((key, place, *[texts.get(f, "") for f in fields]))
            columns = list(zip(*rows)) or [()] * (len(fields) + 2)
            kinds = [pa.string(), pa.int32(), *[pa.string()] * len(fields)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "place", *fields])

    return pages.select("key", "body").mapInArrow(run, ", ".join(["key string", "place int", *[f"`{f}` string" for f in fields]]))


class _Page(HTMLParser):
    """Links, and tables as rows of cells with the first link of each cell."""

    def __init__(self) -> None:
        super().__init__()
        self.links: list[str] = []
        self.tables: list[tuple[list[str], list[list[list]]]] = []
        self._open: list[tuple[list[str], list[list[list]]]] = []
        self._cell: str | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        href = dict(attrs).get("href")
        if tag == "a" and href:
            self.links.append(href)
            if self._cell == "td" and self._open and self._open[-1][1] and self._open[-1][1][-1]:
                cell = self._open[-1][1][-1][-1]
                cell[1] = cell[1] or href
        if tag == "table":
            self._open.append(([], []))
            self.tables.append(self._open[-1])
        elif self._open and tag == "tr":
            self._open[-1][1].append([])
        elif self._open and tag == "td":
            if not self._open[-1][1]:
                self._open[-1][1].append([])
            self._open[-1][1][-1].append(["", None])
            self._cell = "td"
        elif self._open and tag == "th":
            self._open[-1][0].append("")
            self._cell = "th"

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self._open:
            self._open.pop()
        if tag in ("td", "th", "table"):
            self._cell = None

    def handle_data(self, data: str) -> None:
        if not self._open or not data.strip():
            return
        headers, rows = self._open[-1]
        if self._cell == "th":
            headers[-1] = f"{headers[-1]} {data.strip()}".strip()
        elif self._cell == "td" and rows and rows[-1]:
            rows[-1][-1][0] = f"{rows[-1][-1][0]} {data.strip()}".strip()


def _code(href: str | None, pattern: re.Pattern) -> str | None:
    m = re.search(r"\?code=([^&]*)", href or "")
    code = m[1].strip().upper() if m else ""
    return code if code and pattern.match(code) else None


def code_page(html: str, parent: str, pattern: re.Pattern) -> tuple[list[str], list[tuple[str, ...]]]:
    """Codes below ``parent`` that a page links to, and the rows of its tables that begin with a code."""
    page = _Page()
    page.feed(html)
    below = [c for c in dict.fromkeys(_code(h, pattern) for h in page.links) if c and c != parent and c.startswith(parent)]
    rows = []
    for headers, cells in page.tables:
        named = " ".join(headers).lower()
        if headers and not any(word in named for word in ("atc", "ddd", "adm", "name")):
            continue
        for row in (r for r in cells if r):
            code = (_code(row[0][1], pattern) or row[0][0]).strip().upper()
            if code and pattern.match(code):
                texts = [c[0] for c in row[1:6]]
                rows.append((code, *texts, *[""] * (5 - len(texts))))
    return below, rows


def code_list(pages: DataFrame, seeds: DataFrame, pattern: str = HUMAN_CODE) -> DataFrame:
    """The code list that landed pages (key: their code, body) hold, from the seed codes downwards.

    Only pages that links from a seed lead to count, each once, however they
    are linked. Of rows of the same code and name the first counts, in the order
    of a walk from the top: a page before those below it.
    """
    shape = re.compile(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                below, rows = code_page(body or "", (key or "").upper(), shape)
                out += [((key or "").upper(), -1, c, *[None] * 5) for c in below] + [((key or "").upper(), i, *r) for i, r in enumerate(rows)]
            columns = list(zip(*out)) or [()] * 8
            kinds = [pa.string(), pa.int32(), *[pa.string()] * 6]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["page", "place", *CODE_FIELDS])

    parsed = pages.select("key", "body").mapInArrow(run, ", ".join(["page string", "place int", *[f"{c} string" for c in CODE_FIELDS]]))
    links = parsed.filter("place < 0").select(F.col("page").alias("id"), F.col("atc_code").alias("to"))
    visited = reachable(links, seeds.select(F.upper("id").alias("id")))
    rows = parsed.filter("place >= 0").join(visited.select(F.col("id").alias("page")), "page", "left_semi")
    first = F.min_by(F.struct(*CODE_FIELDS[2:]), F.struct("page", "place")).alias("v")
    return rows.groupBy("atc_code", "name").agg(first).select("atc_code", "name", "v.*").orderBy("atc_code", "name")


def read_code_lists(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(line_no, atc_code, name) of the code lists that are there, in the order given; any of them may be absent."""
    from .tables import read_quoted

    out = spark.createDataFrame([], "line_no struct<list:int,place:struct<file:string,row:bigint>>, atc_code string, name string")
    for rank, path in enumerate(p for p in paths if files_of(spark, p)):
        rows = read_quoted(spark, path, place="place").filter("trim(atc_code) <> '' AND trim(name) <> ''")
        out = out.unionByName(rows.select(F.struct(F.lit(rank).alias("list"), "place").alias("line_no"), F.trim("atc_code").alias("atc_code"), F.trim("name").alias("name")))
    return out


def read_panels(spark: SparkSession, path: str) -> DataFrame:
    """(panel, item): the items of each panel, those of panels it includes among them, to any depth.

    ``:Panel: name`` begins a panel, ``:Include: name`` takes over another one,
    other lines are items; blank lines and comments do not count. A panel file
    is small and read by one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, panel = [], None
            for text in batch.column(0).to_pylist():
                for line in (x.strip() for x in text.splitlines()):
                    m = re.match(r":(Panel|Include):\s*(.*)$", line)
                    if m and m[1] == "Panel":
                        panel = m[2]
                        rows.append((panel, None, None))
                    elif panel and line and not line.startswith("#"):
                        rows.append((panel, None, m[2]) if m else (panel, line, None))
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["panel", "item", "include"])

    parsed = spark.read.text(path, wholetext=True).mapInArrow(run, "panel string, item string, include string")
    links = parsed.filter("include IS NOT NULL").select(F.col("panel").alias("id"), F.col("include").alias("to"))
    names = parsed.select(F.col("panel").alias("id")).distinct()
    held = reachable(links, names.select("id", F.col("id").alias("start")), carry="start")
    return held.select(F.col("start").alias("panel"), F.col("id").alias("source")).join(parsed.filter("item IS NOT NULL").select(F.col("panel").alias("source"), "item"), "source").select("panel", "item").distinct()
