"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: an element node is the path of tags and class names from the root, equal
neighbours counted once; its styles are the sequences of children it has on different pages; what its text blocks hold are
its contents. A node with many styles, or contents that differ from page to page, is important; one that looks and
reads the same on all pages is not:

    presentation(E) = entropy of its styles over its m pages, to the base m (1 if m is 1)
    content(E)      = mean over the different blocks below E of 1 - log(pages with the block) / log(pages with its node)
    importance(E)   = (1 - 0.9 ** styles) * presentation(E) + 0.9 ** styles * content(E)    (a leaf: content(E) alone)

A branch whose importance is at most ``LEAST`` is removed from each page that has it. What HTML or a class name calls by name
(nav, footer, sidebar, comments, ...) has no importance, however its texts vary, for a small site cannot show that
they repeat; the flow of an article or main element (paragraphs, headings, lists) always has. Where a page has such an element,
what stands outside has none. Pages that are equal byte by byte count once, and a node on fewer than ``FEW`` different
pages is not judged: one page proves nothing about a site.

Spark counts; a task parses one page at a time. First pass: nodes and hashes of blocks, which are added up by (host, node,
content), so that a host with a third of all pages is spread by its nodes and contents. Second pass: pages that have a removed
branch meet its names by a join, and every page is written out.

Defined results: NULL html is empty text. Pages without a host, or without url, make one site. White space is what Unicode calls so.
Elements nested deeper than ``DEPTH`` lie beside each other at that depth, as in browsers. A page that would lose everything to
entropy keeps it. Equal rows have equal results. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm import scratch

LEAST = 0.6
DECAY = 0.9
FEW = 3
DEPTH = 512

# Element names of HTML and what they stand for.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
FLOW = set("article main section div p h1 h2 h3 h4 h5 h6 hgroup header ul ol li dl dt dd blockquote pre table tbody thead tfoot tr td th caption figure figcaption".split())
CLOSES = {  # an element of the first kind ends an open one of the second, looked for up to one of the third
    **{name: ({"p"}, set()) for name in BLOCKS - {"body", "html", "option", "optgroup"}},
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}),
    "article": ({"p", "nav", "header", "footer"}, {"article", "aside"}), "main": ({"p", "nav", "header", "footer"}, {"aside"}),
}
BOILERPLATE = set("nav footer aside form dialog menu search button select label fieldset noscript template object svg math canvas audio video map head".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
NAMED = set(  # anywhere in a class name or id
    "comment comments commentlist disqus sidebar cookie cookies consent gdpr advert adverts advertisement advertising adsense sponsor sponsored "
    "promo promotion newsletter breadcrumb breadcrumbs navbar navigation masthead pagination popup paywall".split()
)
NAMED_ENDS = set(  # first or last in it
    "ad ads banner nav menu menubar footer header topbar toolbar notice notices notification alert modal overlay subscribe signup login "
    "search share sharing social related recommended replies responses discussion pager widget copyright disclaimer form skip teaser".split()
)
IN_HEAD = set("head title style script meta link base noscript template br".split())
CONTENT = set("content article main post entry story body text".split())

TOKEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>)")
TAG_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): text, start tags with their attributes, end tags. Comments, declarations and the content of raw
    elements are skipped. A tag cut off by the end of the page is dropped; one with an open quote ends at the next ``>``."""
    at = 0
    while True:
        opened = html.find("<", at)
        if opened < 0:
            yield "text", "", html[at:]
            return
        match = TOKEN.match(html, opened)
        if match is None:
            start = TAG_START.match(html, opened)
            if start is None:  # a bare less-than sign
                yield "text", "", html[at : opened + 1]
                at = opened + 1
                continue
            if at < opened:
                yield "text", "", html[at:opened]
            end = html.find(">", start.end())
            if end < 0:
                return
            slash, name, rest = start[1], start[2].lower(), html[start.end() : end]
            end += 1
        else:
            if at < opened:
                yield "text", "", html[at:opened]
            if match[1] or match[2]:
                close = "-->" if match[1] else ">"
                end = html.find(close, match.end() - (2 if match[1] else 0))
                if end < 0:
                    return
                at = end + len(close)
                continue
            slash, name, rest, end = match[3], match[4].lower(), match[5], match.end()
        at = end
        yield ("end" if slash else "start"), name, rest
        if not slash and name in RAW:
            close = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            if close is None:
                return
            at = close.start()


@lru_cache(1 << 16)
def attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(rest):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


@dataclass(frozen=True)
class Look:
    """Presentation of an element: its key (tag and class names, long numbers left out), whether its name says boilerplate, whether only
    class names do that may as well stand around an article, and whether it is a heading part."""

    key: str
    boilerplate: bool = False
    doubtful: bool = False
    heading: bool = False


@lru_cache(1 << 16)
def look(name: str, rest: str) -> Look:
    found = attributes(rest)
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    parts = [[p.lower() for p in PARTS.findall(n)] for n in names]
    parts = [p for p in parts if p and p[0] not in ("has", "with", "no", "is")]
    key = ".".join([name, *sorted({re.sub(r"\d{3,}", "#", n) for n in names})])
    heading = name == "header" or any(p[-1] == "header" for p in parts)
    if name in BOILERPLATE or found.get("role", "").lower() in ROLES:
        return Look(key, True, name == "form", heading)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or HIDDEN.search(found.get("style", "")):
        return Look(key, True)
    if name in ("html", "body"):
        return Look(key)
    if any(NAMED.intersection(p) for p in parts):
        return Look(key, True)
    if name in ("main", "article") or CONTENT.intersection(n.lower() for n in names):
        return Look(key, heading=heading)
    if name == "header" or any(NAMED_ENDS.intersection((p[0], p[-1])) and not (p[-1] == "header" and p[0] in CONTENT) for p in parts):
        return Look(key, True, True, heading)
    return Look(key)


def hash_of(*parts: object) -> int:
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(1 << 16)
def child_of(parent: int, key: str) -> int:
    return hash_of(parent, key)


@dataclass
class Element:
    name: str
    node: int
    boilerplate: bool
    doubtful: bool
    classed: bool
    children: list[str] = field(default_factory=list)


@dataclass
class Block:
    text: str
    path: list[Element]

    @property
    def node(self) -> int:
        return self.path[-1].node if self.path else 0


@dataclass
class Page:
    """Text blocks of a page in order, and the sequences of children of each node."""

    blocks: list[Block] = field(default_factory=list)
    styles: dict[int, set[tuple[str, ...]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.stack: list[Element] = []
        self.pieces: list[str] = []

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces = []
        if text:
            self.blocks.append(Block(text, list(self.stack)))

    def close(self, at: int) -> None:
        """Ends the open elements from ``at`` on."""
        self.flush()
        for e in self.stack[at:]:
            self.styles.setdefault(e.node, set()).add(tuple(e.children))
        del self.stack[at:]

    def start(self, name: str, rest: str) -> None:
        if name == "br":
            self.pieces.append(" ")
        if name not in IN_HEAD:
            self.end("head")
        closes, bounds = CLOSES.get(name, (set(), set()))
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].name in closes:
                self.close(i)
            elif self.stack[i].name in bounds:
                break
        if name in BLOCKS:
            self.flush()
        seen = look(name, rest)
        if name in VOID or not (name in BLOCKS or seen.boilerplate):
            return
        if len(self.stack) >= DEPTH:
            self.close(DEPTH - 1)
        above = self.stack[-1] if self.stack else None
        # An article's own heading is part of it, the page's is not.
        boilerplate = seen.boilerplate and not (seen.heading and any(e.name in ("article", "main") for e in self.stack))
        if above is not None and (not above.children or above.children[-1] != seen.key):
            above.children.append(seen.key)
        node = child_of(above.node if above else 0, seen.key)
        self.flush()
        self.stack.append(Element(name, node, boilerplate, seen.doubtful, "." in seen.key))

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].name == name:
                self.close(i)
                return


def parse(html: str | None) -> Page:
    page = Page()
    for kind, name, rest in tokens(html or ""):
        if kind == "text":
            page.pieces.append(unescape(rest))
        elif kind == "start":
            page.start(name, rest)
        else:
            page.end(name)
    page.close(0)
    page.flush()
    return page


def judged(page: Page) -> list[tuple[Block, bool, bool]]:
    """Each block, whether names leave it in, and whether it is plain flow of an article, which entropy does not judge.

    The main element is an article if the page has one that is not boilerplate, else ``main``. Doubtful class names do not count on
    elements around all of the page's articles.
    """
    ignored: set[int] = set()
    named = lambda b: any(e.boilerplate and id(e) not in ignored for e in b.path)
    held = lambda b, kinds: any(e.name in kinds for e in b.path)
    if not any(held(b, ("article", "main")) and not named(b) for b in page.blocks):
        ignored = {id(e) for b in page.blocks for i, e in enumerate(b.path) if e.doubtful and any(x.name in ("article", "main") for x in b.path[i + 1 :])}
    kinds = [kind for kind in ("article", "main") if any(held(b, (kind,)) and not named(b) for b in page.blocks)][:1]
    out = []
    for b in page.blocks:
        inner = max((i for i, e in enumerate(b.path) if e.name in kinds), default=None)
        flow = inner is not None and not any(e.classed or e.name not in FLOW for e in b.path[inner + 1 :])
        out.append((b, not named(b) and (inner is not None or not kinds), flow))
    return out


def text_of(html: str | None, removed: set[int]) -> str:
    """Text of a page without its boilerplate and without the branches named in ``removed``."""
    rows = judged(parse(html))
    kept = [b.text for b, left, flow in rows if left and (flow or not removed.intersection(e.node for e in b.path))]
    return "\n".join(kept or [b.text for b, left, _ in rows if left])


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port; empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def row_key() -> Column:
    """Hash of a row; equal rows share it and have equal results."""
    return F.xxhash64("page_id", "url", "html")


SEEN = "host string, rid long, page long, node long, above array<long>, content long, style long"


def style_rows(pages: DataFrame) -> DataFrame:
    """(host, rid, page, node, above, content, style): for each page its nodes' styles, and the blocks that entropy may judge."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                rows = []
                for r in batch.slice(low, 64).to_pylist():
                    page = parse(r["html"])
                    open_ = [b for b, left, flow in judged(page) if left and not flow]
                    seen = {(b.node, hash_of(b.text)): b for b in open_}
                    same = (r["host"], r["rid"], r["page"])
                    rows += [(*same, node, [e.node for e in b.path], content, None) for (node, content), b in seen.items()]
                    wanted = {e.node for b in open_ for e in b.path}
                    rows += [(*same, n, None, None, hash_of(*sorted(s))) for n, s in page.styles.items() if n in wanted and s != {()}]
                columns = list(zip(*rows)) or [[]] * 7
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in SEEN.split(", ")])

    rows = pages.select(host_of(F.col("url")).alias("host"), row_key().alias("rid"), F.xxhash64("html").alias("page"), "html")
    return rows.mapInArrow(read, SEEN)


def importance(seen: DataFrame) -> DataFrame:
    """(host, node, pages, presentation, content, importance) of every node that entropy judges."""
    site = ["host", "node"]
    blocks = seen.where(F.col("content").isNotNull()).select(*site, "above", "content", "page")
    held = blocks.groupBy(*site, "above", "content").agg(F.count_distinct("page").alias("n"))
    pages = blocks.groupBy(*site).agg(F.count_distinct("page").alias("m"))
    share = F.when(F.col("m") > 1, 1 - F.log("n") / F.log("m")).otherwise(1.0)
    leaf = held.join(pages, site).groupBy(*site, "above").agg(F.sum(share).alias("worth"), F.count(F.lit(1)).alias("blocks"), F.max("m").alias("m"))
    # A leaf's contents count for every node above it, the leaf included.
    spread = leaf.select("host", F.explode("above").alias("node"), "worth", "blocks", "m")
    content = spread.groupBy(*site).agg((F.sum("worth") / F.sum("blocks")).alias("content"), F.max("m").alias("pages"))
    styles = seen.where(F.col("style").isNotNull()).groupBy(*site, "style").agg(F.count_distinct("page").alias("n"))
    total, logs = F.sum("n"), F.sum(F.col("n") * F.log("n"))
    looks = styles.groupBy(*site).agg(F.when(total > 1, 1 - logs / (total * F.log(total))).otherwise(1.0).alias("presentation"), F.count(F.lit(1)).alias("styles"))
    decay = F.pow(F.lit(DECAY), F.col("styles"))
    value = F.coalesce((1 - decay) * F.col("presentation") + decay * F.col("content"), F.col("content"))
    return content.join(looks, site, "left").select(*site, "pages", "presentation", "content", value.alias("importance"))


def removed_branches(seen: DataFrame, least: float = LEAST, few: int = FEW) -> DataFrame:
    """(rid, nodes): for each page that has one, the nodes whose importance is at most ``least``."""
    low = importance(seen).where((F.col("pages") >= few) & (F.col("importance") <= least)).select("host", "node")
    own = seen.where(F.col("content").isNotNull()).select("host", "rid", F.explode("above").alias("node")).distinct()
    return own.join(low, ["host", "node"]).groupBy("rid").agg(F.collect_set("node").alias("nodes"))


def extract(pages: DataFrame, least: float = LEAST, few: int = FEW) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    seen = scratch.written(style_rows(pages), "styles")
    rows = pages.select("page_id", "url", "html", row_key().alias("rid")).join(removed_branches(seen, least, few), "rid", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("nodes").to_pylist()
            texts = [text_of(h, set(n or ())) for h, n in zip(batch.column("html").to_pylist(), nodes)]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).dtypes)
    rows = rows.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", "nodes")
    return rows.mapInArrow(write, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
