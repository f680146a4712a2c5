"""Main text of web pages by nearest-URL page differencing.

A page is cut into text lines (blocks). Markup that names itself as chrome
(menus, headers, footers, asides, forms, adverts, notices, comments) is
left out, unless it wraps the page's own text. The remaining lines of a page are aligned with those of its nearest
page, the neighbour in URL path order within the host with the smaller edit
distance of paths, by a longest common subsequence; shared lines are template
text and are deleted. Prose inside the page's own article element stays even
if a neighbour has it too (quoted and copied passages are not template), and
between two copies of one page nothing is deleted.

Neighbours come from one range sort of the keys, whatever the size of a host:
each range finds its own neighbours, and the first and last key of each
range, a row per range, give the rest. Only line hashes are exchanged between
pages; page sources are read twice and not shuffled, except to attach the
deletions where there are too many to broadcast.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotline.llm.common import shared_table

#: The inside of a tag: a quote opens a value only after an equals sign and if it is
#: closed again; a tag does not go over the start of another. Nothing here is tried
#: twice, so that a page of broken quotes takes time in proportion to its length.
INSIDE = r"""(?>[^<>=]+|=\s*+(?:"[^"]*"|'[^']*')?+)*+"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)"
    r"|<(script|style|noscript|template|svg|math|textarea|select|object|iframe|title)(?=[\s/>])" + INSIDE + r">.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)(" + INSIDE + r")>|<[!?][^<>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-hidden|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CHROME_TAGS = set("nav header footer aside form button menu dialog".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar".split())
#: Words of class and id values that name chrome.
CHROME_NAMES = set(
    """ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie
    cookies disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices
    pagination pager paywall popup promo promotion recommended related replies respond share sharing sidebar signup
    social sponsor sponsored subscribe subscription toolbar widget widgets""".split()
)
MAIN_TAGS = {"article", "main"}
#: Words that say which or where beside such a name; any other word makes the
#: whole class or id mean something else (no-comments, has-sidebar).
WHICH = set(
    """area bar block bottom box column container first footer global group inner item items lead left link links list
    main middle outer page post posts primary right row second secondary section site slot sticky story stories text
    top unit wrap wrapper""".split()
)
#: Chrome elements and names that never wrap a page's own text.
NO_WRAPPER = CHROME_TAGS - {"form", "header", "dialog"}
NO_WRAPPER_NAMES = set(
    """ad ads advert advertisement adverts advertising comment comments consent cookie cookies disqus gdpr newsletter
    replies respond""".split()
)
#: Names that inside an article belong to it (its title block, lead picture).
OWN_NAMES = {"header", "banner"}
#: A line inside the article stays unless this share of it is link text.
LINKED = 0.5
#: Two pages are copies if their shared lines hold this share of the text.
COPY = 0.8


@dataclass
class Line:
    text: str
    inside: bool
    linked: float

    @property
    def loose(self) -> bool:
        """May be deleted when the nearest page has it too."""
        return not self.inside or self.linked > LINKED


def is_chrome(tag: str, attributes: str, inside: bool) -> bool:
    if tag in ("body", "html") or tag in MAIN_TAGS and not inside:
        return False
    if tag in CHROME_TAGS and not (tag == "header" and inside):
        return True
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "role" and value in CHROME_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id"):
            found = chrome_names(value)
            if found - OWN_NAMES if inside else found:
                return True
    return False


def chrome_names(value: str) -> set[str]:
    """The chrome names in a class or id value, of whole classes only."""
    found: set[str] = set()
    for token in value.split():
        words = {w for w in re.split(r"[^a-z]+", token) if w}
        if words <= CHROME_NAMES | WHICH:
            found |= words & CHROME_NAMES
    return found


def closings(marks: list[re.Match]) -> dict[int, int]:
    """Number of the opening mark -> number of the mark that closes it."""
    opened: dict[str, list[int]] = {}
    out: dict[int, int] = {}
    for i, m in enumerate(marks):
        if m[3]:
            tag = m[3].lower()
            if not m[2]:
                opened.setdefault(tag, []).append(i)
            elif opened.get(tag):
                out[opened[tag].pop()] = i
    return out


class Wrappers:
    """Tells whether a chrome element wraps the page's own text: the first
    article, or more than half of the text that is no link (a named element
    only where the page has no article)."""

    def __init__(self, source: str, marks: list[re.Match]):
        self.close, self.last = closings(marks), len(marks)
        self.mains = [i for i, m in enumerate(marks) if m[3] and not m[2] and m[3].lower() in MAIN_TAGS]
        self.plain, at, link = [0], 0, False  # characters before each mark
        for m in marks:
            self.plain.append(self.plain[-1] + (0 if link else len(source[at : m.start()].strip())))
            at = m.end()
            if m[3]:
                link = not m[2] if m[3].lower() == "a" else link and m[3].lower() in INLINE
        self.total = self.plain[-1] + (0 if link else len(source[at:].strip()))

    def __call__(self, i: int, tag: str, attributes: str, begun: bool) -> bool:
        if tag in NO_WRAPPER or tag in ("p", "li"):
            return False
        end = self.close.get(i, self.last)
        k = bisect_left(self.mains, i + 1)
        if not begun and k < len(self.mains) and self.mains[k] < end:
            return True
        values = " ".join((m[2] or "").strip("\"'").lower() for m in ATTRIBUTE.finditer(attributes) if m[1].lower() in ("class", "id"))
        if tag != "form" and self.mains or chrome_names(values) & NO_WRAPPER_NAMES:
            return False
        inside = (self.plain[end + 1] if end < self.last else self.total) - self.plain[i + 1]
        return 2 * inside > self.total


def page_lines(source: str | None) -> list[Line]:
    """The lines of a page outside chrome, in page order. If article or main
    elements hold the larger part of that text, only their lines."""
    source = source or ""
    lines: list[Line] = []
    parts: list[str] = []
    state = {"linked": 0, "link": 0, "main": 0}
    skip, depth = "", 0  # open chrome element, and how many of its tag are open
    begun = False  # an article has begun
    at = 0

    def text(raw: str) -> None:
        if raw and not skip:
            found = html.unescape(raw)
            parts.append(found)
            if state["link"]:
                state["linked"] += len(found.strip())

    def flush() -> None:
        whole = " ".join("".join(parts).split())
        if whole:
            lines.append(Line(whole, state["main"] > 0, state["linked"] / len(whole)))
        parts.clear()
        state["linked"] = 0

    marks = list(TOKEN.finditer(source))
    wraps = None
    for i, m in enumerate(marks):
        text(source[at : m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if skip:
            if tag == skip:
                depth += -1 if closing else 1
            if depth == 0 or skip in ("p", "li") and tag not in INLINE and tag not in VOID and tag != skip:
                skip, depth = "", 0
            continue
        if tag == "a":
            state["link"] = 0 if closing else 1
        if tag in INLINE and closing:
            continue
        if not closing and tag not in VOID and is_chrome(tag, m[4], state["main"] > 0):
            wraps = wraps or Wrappers(source, marks)
            if not wraps(i, tag, m[4], begun):
                if tag not in INLINE:
                    flush()
                skip, depth = tag, 1
                continue
        if tag in INLINE:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        state["link"] = 0
        if tag in MAIN_TAGS:
            begun = True
            state["main"] = max(0, state["main"] + (-1 if closing else 1))
    text(source[at:])
    flush()
    own = [x for x in lines if x.inside]
    return own if 2 * sum(len(x.text) for x in own) >= sum(len(x.text) for x in lines) else lines


def line_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - 2**63


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    ends: list[int] = []  # last position in b of the best subsequence of each length
    chains: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            k = bisect_left(ends, j)
            chain = (i, chains[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                chains.append(chain)
            elif j < ends[k]:
                ends[k], chains[k] = j, chain
    out, chain = [], chains[-1] if chains else None
    while chain:
        out.append(chain[0])
        chain = chain[1]
    return out[::-1]


def deletions(own: list[int], size: list[int], loose: list[int], other: list[int]) -> list[int]:
    """Numbers of the loose lines shared with the nearest page; none if the
    pages are copies."""
    shared = common_lines(own, other)
    if sum(size[i] for i in shared) >= COPY * sum(size):
        return []
    return sorted(set(shared) & set(loose))


def row_key() -> list:
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in ("page_id", "url", "html")]
    return [F.xxhash64(*cells).alias("_k"), F.xxhash64(F.lit("2"), *cells).alias("_k2")]


def hashed_lines(pages: DataFrame) -> DataFrame:
    """One row per distinct page: key, host, path, hashes and sizes of its
    lines, and which are loose."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [page_lines(h) for h in b["html"]]
            yield b.drop(columns="html").assign(
                lines=[[line_hash(x.text) for x in f] for f in found],
                size=[[len(x.text) for x in f] for f in found],
                loose=[[i for i, x in enumerate(f) if x.loose] for f in found],
            )

    url = F.coalesce("url", F.lit(""))
    start = "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//"
    host = F.lower(F.regexp_extract(url, f"{start}([^/?#]*)", 1))
    path = F.regexp_extract(url, f"^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    rows = pages.select(*row_key(), host.alias("host"), path.alias("path"), "html")
    schema = "_k long, _k2 long, host string, path string, lines array<long>, size array<int>, loose array<int>"
    return rows.mapInPandas(run, schema).dropDuplicates(["_k", "_k2"])


def neighbours(keys: DataFrame) -> DataFrame:
    """``keys`` (_k, _k2, host, path) with ``near``: key and path of the page
    of the same host that is next to it in path order and nearer by edit
    distance (the earlier one if equal); null if the host has one page."""
    order = ["host", "path", "_k", "_k2"]
    ranged = keys.select(*order).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = shared_table(ranged, "ranges").withColumn("row", F.struct(*order))
    edges = ranged.groupBy("part").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    parts = Window.partitionBy(F.lit(0)).orderBy("part")
    edges = edges.select("part", F.lag("last").over(parts).alias("before"), F.lead("first").over(parts).alias("after"))
    inside = Window.partitionBy("part").orderBy("row")
    rows = (
        ranged.withColumn("prev", F.lag("row").over(inside)).withColumn("next", F.lead("row").over(inside))
        .join(edges, "part")
        .withColumn("prev", F.coalesce("prev", "before")).withColumn("next", F.coalesce("next", "after"))
    )
    far = F.lit(2**30)

    def distance(c: str) -> F.Column:
        return F.when(F.col(f"{c}.host") == F.col("host"), F.levenshtein(F.col(f"{c}.path"), F.col("path"))).otherwise(far)

    rows = rows.withColumn("dp", F.coalesce(distance("prev"), far)).withColumn("dn", F.coalesce(distance("next"), far))
    near = F.when((F.col("dp") == far) & (F.col("dn") == far), None).when(F.col("dp") <= F.col("dn"), F.col("prev")).otherwise(F.col("next"))
    return rows.select("_k", "_k2", near.alias("near"))


def shared_line_numbers(pages: DataFrame) -> DataFrame:
    """_k, _k2, gone (numbers of the lines to delete) of the pages that lose
    lines."""
    lines = shared_table(hashed_lines(pages), "lines")
    pairs = neighbours(lines).where("near is not null").select("_k", "_k2", F.col("near._k").alias("nk"), F.col("near._k2").alias("nk2"))
    own = lines.where("size(loose) > 0").select("_k", "_k2", "lines", "size", "loose")
    other = lines.select(F.col("_k").alias("nk"), F.col("_k2").alias("nk2"), F.col("lines").alias("other"))

    @F.pandas_udf("array<int>")
    def gone(own: pd.Series, size: pd.Series, loose: pd.Series, other: pd.Series) -> pd.Series:
        return pd.Series([deletions(list(a), list(s), list(k), list(b)) for a, s, k, b in zip(own, size, loose, other, strict=True)])

    found = own.join(pairs, ["_k", "_k2"]).join(other, ["nk", "nk2"])
    return found.select("_k", "_k2", gone("lines", "size", "loose", "other").alias("gone")).where("size(gone) > 0")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url,
    html): lines joined by an empty line. A null page, or one without text,
    has an empty text; a page without URL belongs to a nameless host; rows
    equal in all three columns get equal texts."""
    gone = shared_table(shared_line_numbers(pages), "gone")
    rows = pages.select("page_id", "url", "html", *row_key()).join(gone, ["_k", "_k2"], "left").select("page_id", "url", "html", "gone")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = []
            for source, drop in zip(b["html"], b["gone"], strict=True):
                lines = page_lines(source)
                drop = set() if drop is None else set(drop)
                texts.append("\n\n".join(x.text for i, x in enumerate(lines) if i not in drop))
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
