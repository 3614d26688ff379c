"""Main text of web pages: structure marks the blocks, and what a host repeats goes.

1. A page is cut into blocks of text, each marked by the elements around it: BODY lies in an article or main element, CHROME
   in menus, headers, footers, sidebars, notices, adverts, forms or comments, LOOSE in neither. Scripts, styles and
   markup have no text. A page's text is its body, or where it has none its loose blocks.
2. The host's suffix array. Each page has two token streams, its body and the rest. Suffixes of a host's streams that begin
   with the same RUN tokens stand together in its suffix array: they are a long substring that those streams share. The
   array is held as a relation that Spark groups by host and run, so no host meets in one task. Not every suffix is sent:
   of each WINDOWS neighbouring ones the one with the least hash is, so every shared run of RUN tokens sends one that
   all its streams choose alike. Runs that may be boilerplate by these hashes are then counted by their tokens.
3. A run is boilerplate if it is on at least LEAST distinct streams of its host and on more than SHARE of them. Streams that
   are equal count once. Tokens that such runs cover are removed, the unique runs stay. A body that would lose more than
   half of its tokens is an article that several pages carry, and stays; so does a text without body of which fewer than
   RUN tokens would be left.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import all_but, small, work_table

GRAM, WINDOWS = 5, 6
RUN = GRAM + WINDOWS - 1
LEAST, SHARE = 3, 0.5
BODY, LOOSE, CHROME = 0, 1, 2
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
MAIN = re.compile(r"""(?i)(?:^|\s)role\s*=\s*["']?main\b""")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose content is no text; those of TO_END hold all that follows if they are never closed.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "noframes"}
TO_END = {"script", "style", "iframe", "textarea", "title", "noframes"}
HARD_NAMES = {"nav", "footer", "aside", "menu", "button", "select", "dialog", "head"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "caption", "ul",
}
#: Elements that hold other blocks: what they are named tells of all that is in them.
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "article", "details", "fieldset", "figure", "center", "header", "td", "tbody"}
#: Elements that their next like ends, unless one of these was opened in between.
ENDED_BY_NEXT = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
#: Words in class, id and role that mark adverts and the like, comments, and the other parts around an article.
ADVERTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent", "newsletter"}
REMARKS = {"comment", "comments", "disqus", "replies"}
NAMES = ADVERTS | REMARKS | {
    "banner", "notice", "notices", "alert", "popup", "modal", "sidebar", "aside", "complementary", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer",
    "contentinfo", "header", "masthead", "form", "search",
}
_REGION, _SOFT, _HARD = 0, 1, 2


class _Mark:
    """An element that matters: its kind, the one around it, whether its own end tag came, whether it is for comments."""

    def __init__(self, kind: int, remark: bool):
        self.kind, self.remark, self.closed = kind, remark, False
        self.parent: _Mark | None = None

    def within(self, parent: _Mark | None) -> _Mark:
        self.parent = parent
        self.region = parent.region if parent and parent.region else self if self.kind == _REGION else None  # outermost one
        return self


def _mark(name: str, rest: str, inside: bool) -> _Mark | None:
    """What an element that opens means; inside: whether an article or main element is open."""
    named = {w for m in ATTRIBUTE.finditer(rest) for w in re.split(r"[^a-z0-9]+", (m[2] or m[3] or m[4] or "").lower())} & NAMES
    if name in ("article", "main") or MAIN.search(rest):
        if name == "article" and named & (REMARKS | ADVERTS - {"ad"}):
            return _Mark(_SOFT, bool(named & REMARKS))
        return _Mark(_REGION, False)
    if name in HARD_NAMES or (name == "header" and not inside):
        return _Mark(_HARD, False)
    if name in ("html", "body"):
        return None
    if inside:  # an article's own heading, and words of its text, are no chrome
        named = named - {"header"} if name in CONTAINERS else named & ADVERTS
    if name == "form" or named:
        return _Mark(_SOFT, bool(named & REMARKS))
    return None


def marked_pieces(page: str) -> tuple[list[tuple[int, str, _Mark | None]], list[_Mark]]:
    """The text of a page in pieces (number of the block, text, innermost mark around it), in its order, without empty
    ones, and all marks, outer ones first. Where an inline element is marked, its block has several pieces."""
    out: list[tuple[int, str, _Mark | None]] = []
    marks: list[_Mark] = []
    text: list[str] = []
    stack: list[tuple[str, _Mark | None]] = []
    names, around, number, at = Counter(), None, 0, 0

    def piece() -> None:
        words = html.unescape("".join(text)).split()
        if words:
            out.append((number, " ".join(words), around))
        text.clear()

    def close() -> None:
        nonlocal number
        piece()
        number += 1

    def pop_to(name: str, ended: bool) -> None:
        nonlocal around
        while True:
            top, mark = stack.pop()
            names[top] -= 1
            if mark:
                piece()
                around = mark.parent
                mark.closed = ended and top == name
            if top == name:
                return

    def lies_open(name: str, stop: set[str]) -> bool:
        if names[name]:
            for top, _ in reversed(stack):
                if top == name:
                    return True
                if top in stop:
                    return False
        return False

    while found := TAG.search(page, at):
        text.append(page[at : found.start()])
        at = found.end()
        end, name, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name, rest = name.lower(), rest or ""
        if name in ("br", "td", "th"):
            text.append(" ")
        elif name in BLOCKS:
            close()
        if end:
            if names[name]:
                pop_to(name, True)
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else len(page) if name in TO_END else at
            continue
        if name in BLOCKS and names["head"]:
            pop_to("head", True)
        if name in BLOCKS and lies_open("p", BLOCKS - {"p"}):
            pop_to("p", True)
        if name in ENDED_BY_NEXT and lies_open(name, ENDED_BY_NEXT[name]):
            pop_to(name, True)
        if name in VOID or rest.rstrip().endswith("/"):
            continue
        mark = _mark(name, rest, bool(around and around.region))
        if mark:
            piece()
            around = mark.within(around)
            marks.append(mark)
        stack.append((name, mark))
        names[name] += 1
    text.append(page[at:])
    close()
    return out, marks


def blocks(page: str) -> list[tuple[int, str]]:
    """(BODY, LOOSE or CHROME, text) of each block of a page.

    Articles within menus, sidebars and the like are no body if there are others, or if that element is properly closed. A
    form or a named element around an article is only its wrapper; in a page without one so is what was never closed,
    or a form or named element that isn't for comments, if it holds more than half of the words."""
    found, marks = marked_pieces(page)
    shut: set[_Mark] = set()  # within menus and the like that are properly closed
    for m in marks:
        if m.parent in shut or (m.kind == _HARD and m.closed):
            shut.add(m)
    outermost = [m for m in marks if m.region is m]
    through: set[_Mark] = set()  # wrappers
    chosen = {m for m in outermost if not m.parent}
    if not chosen:
        chosen = {m for m in outermost if m.parent not in shut}
        for m in chosen:
            while (m := m.parent) and m not in through:
                through.add(m)
    if not chosen:
        size: Counter = Counter()
        for _, text, m in found:
            if m not in shut:
                size[m] += text.count(" ") + 1
        total = sum(size.values())
        for m in reversed(marks):
            size[m.parent] += size[m] if m.parent else 0
        through = {m for m in marks if not m.remark and 2 * size[m] > total}
    chrome: set[_Mark | None] = set()
    body: set[_Mark | None] = set()
    for m in marks:
        if m.parent in chrome or (m.kind != _REGION and m not in through):
            chrome.add(m)
        if m.parent in body or m in chosen:
            body.add(m)

    def kind(m: _Mark | None) -> int:
        return CHROME if m in chrome else BODY if m in body else LOOSE

    joined: dict[tuple[int, int], list[str]] = {}
    for number, text, m in found:
        joined.setdefault((number, kind(m)), []).append(text)
    return [(k, " ".join(texts)) for (_, k), texts in joined.items()]


def streams(found: list[tuple[int, str]]) -> list[list[str]]:
    """The tokens of a page's body and of the rest of it."""
    body = [w for kind, text in found if kind == BODY for w in text.split(" ")]
    return [body, [w for kind, text in found if kind != BODY for w in text.split(" ")]]


def _digest(tokens: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(tokens))


def _suffixes(of: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each stream the places of its chosen suffixes and the hashes of their first GRAM tokens."""
    lens = [len(s) for s in of]
    code, kinds = pd.factorize(np.array([w for s in of for w in s] or [""], dtype=object))
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, kinds), "uint64", len(kinds))[code]
    with np.errstate(over="ignore"):
        gram = each.copy()
        for k in range(1, GRAM):
            gram[:-k] = gram[:-k] * np.uint64(0x9E3779B97F4A7C15) + each[k:]
        gram = (gram ^ (gram >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    out, at = [], 0
    for n in lens:
        if n >= RUN:
            mine = gram[at : at + n - GRAM + 1]
            places = np.unique(sliding_window_view(mine, WINDOWS).argmin(axis=1) + np.arange(n - RUN + 1))
            out.append((places, mine[places].view("int64")))
        else:
            out.append((np.zeros(0, "int64"), np.zeros(0, "int64")))
        at += n
    return out


def _text(value) -> str:
    return value.as_py() or ""


def _stream_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, part, stream) for each stream of pages (host, html) that is long enough to share a run."""
    for batch in batches:
        rows = [(h.as_py(), part, _digest(s)) for h, page in zip(batch.column("host"), batch.column("html"), strict=True) for part, s in enumerate(streams(blocks(_text(page)))) if len(s) >= RUN]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ([], [], []), (pa.string(), pa.int32(), pa.binary()), strict=True)], ["host", "part", "stream"])


def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, part, stream, runs): the distinct chosen suffixes of each stream."""
    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            one = batch.slice(a, 500)
            keys = [(h.as_py(), part, s) for h, page in zip(one.column("host"), one.column("html"), strict=True) for part, s in enumerate(streams(blocks(_text(page)))) if len(s) >= RUN]
            runs = [np.unique(h) for _, h in _suffixes([s for _, _, s in keys])]
            yield pa.record_batch(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([_digest(k[2]) for k in keys], pa.binary()), pa.array(runs, pa.list_(pa.int64()))],
                ["host", "part", "stream", "runs"],
            )


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, part, stream, runs): the distinct runs of RUN tokens, as text, that hold one of the suffixes to look at."""
    for batch in batches:
        out = []
        for host, page, marks in zip(batch.column("host"), batch.column("html"), batch.column("marks"), strict=True):
            looked = {(m["part"], m["run"]) for m in marks.as_py()}
            of = streams(blocks(_text(page)))
            for part, (tokens, (places, hashes)) in enumerate(zip(of, _suffixes(of), strict=True)):
                starts = {i for p, h in zip(places.tolist(), hashes.tolist(), strict=True) if (part, h) in looked for i in range(max(0, p - WINDOWS + 1), min(p, len(tokens) - RUN) + 1)}
                if starts:
                    out.append((host.as_py(), part, _digest(tokens), list({" ".join(tokens[i : i + RUN]) for i in starts})))
        types = (pa.string(), pa.int32(), pa.binary(), pa.list_(pa.string()))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else ([], [], [], []), types, strict=True)], ["host", "part", "stream", "runs"])


def unique_text(page: str, shared: list[tuple[int, str]]) -> str:
    """The text of a page without the tokens that shared runs (part, run) cover."""
    found = blocks(page)
    kind = BODY if any(k == BODY for k, _ in found) else LOOSE
    whole = "\n".join(text for k, text in found if k == kind)
    runs = {run for part, run in shared if part == (0 if kind == BODY else 1)}
    if not runs:
        return whole
    stream = [(w, n) for n, (k, text) in enumerate(found) if (k == BODY) == (kind == BODY) for w in text.split(" ")]
    tokens = [w for w, _ in stream]
    covered = np.zeros(len(tokens), bool)
    for i in range(len(tokens) - RUN + 1):
        if " ".join(tokens[i : i + RUN]) in runs:
            covered[i : i + RUN] = True
    own = [(w, n, c) for (w, n), c in zip(stream, covered, strict=True) if found[n][0] == kind]
    left: dict[int, list[str]] = {}
    for w, n, c in own:
        if not c:
            left.setdefault(n, []).append(w)
    n_left = sum(map(len, left.values()))
    if (kind == BODY and 2 * n_left < len(own)) or (kind == LOOSE and 0 < n_left < RUN):
        return whole
    return "\n".join(" ".join(words) for words in left.values())


@F.pandas_udf(T.StringType())
def _plain_text(pages: pd.Series) -> pd.Series:
    return pages.map(lambda p: unique_text(p or "", []), na_action=None)


@F.pandas_udf(T.StringType())
def _unique_text(pages: pd.Series, shared: pd.Series) -> pd.Series:
    return pd.Series([unique_text(p or "", [(x["part"], x["run"]) for x in s] if s is not None else []) for p, s in zip(pages, shared, strict=True)], dtype=object)


def host_boilerplate(pages: DataFrame, least: int = LEAST, share: float = SHARE, most_broadcast: int = 100_000) -> DataFrame:
    """(host, shared): for each host of pages (host, html) that has any, its boilerplate as an array of (part, run).

    A run must be on more than `share` of the streams, so a host has no more of them than 1 / share times the runs of its
    average page. most_broadcast: rows up to which a side of a join is broadcast, if its files are small too; beyond that both
    are shuffled."""
    found = work_table(pages.mapInArrow(_stream_rows, "host string, part int, stream binary").groupBy("host", "part", "stream").agg(F.count("*").alias("copies")))
    totals = work_table(found.groupBy("host", "part").agg(F.count("*").alias("of")))
    totals = small(totals.filter(F.col("of") >= least), most_broadcast)
    copied = small(work_table(found.filter("copies > 1")), most_broadcast)
    once = F.coalesce(1 / F.col("copies"), F.lit(1.0))  # equal streams together count as one

    def often(rows: DataFrame) -> DataFrame:
        """(host, part, run) that are on enough of the streams of rows (host, part, stream, runs)."""
        rows = rows.join(copied, ["host", "part", "stream"], "left").select("host", "part", F.explode("runs").alias("run"), once.alias("n"))
        rows = rows.groupBy("host", "part", "run").agg(F.sum("n").alias("n")).filter(F.col("n") > least - 0.5)
        return rows.join(totals, ["host", "part"]).filter(F.col("n") > share * F.col("of") + 1e-6).select("host", "part", "run")

    marks = work_table(often(pages.mapInArrow(_suffix_rows, "host string, part int, stream binary, runs array<long>")))
    marks = marks.groupBy("host").agg(F.collect_list(F.struct("part", "run")).alias("marks"))
    looked = pages.join(small(marks, most_broadcast), "host")
    runs = work_table(often(looked.mapInArrow(_run_rows, "host string, part int, stream binary, runs array<string>")))
    return runs.groupBy("host").agg(F.collect_list(F.struct("part", "run")).alias("shared"))


def extract_text(pages: DataFrame, host: Column, page: str = "html", most_broadcast: int = 100_000, **options) -> DataFrame:
    """pages with the column `text`.

    A null or empty page has an empty text; a null host is a host called ''. Copies of a page, and pages with the same
    article, count once when runs are counted, so they don't take each other's text. A paragraph of RUN tokens or more goes
    from an article too, if over half of the host's articles have it. Very long pages are read whole. Repeated rows stay,
    each with its text; no ties arise. An empty table gives no rows. Other columns, of any name, stay; one called `text`
    is replaced.
    """
    at = F.coalesce(host, F.lit(""))
    shared = work_table(host_boilerplate(pages.select(at.alias("host"), F.col(page).alias("html")), most_broadcast=most_broadcast, **options))
    rows = pages.select(F.struct("*").alias("row"), at.alias("host"), F.col(page).alias("html"))
    kept = all_but("row", pages, "text")
    if shared.isEmpty():
        return rows.select(*kept, _plain_text(F.col("html")).alias("text"))
    rows = rows.join(small(shared, most_broadcast), "host", "left")
    return rows.select(*kept, _unique_text(F.col("html"), F.col("shared")).alias("text"))


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    from .url_filter import host_of

    got = extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), host_of(F.col("url")))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
