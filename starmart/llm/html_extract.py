"""Main text of HTML pages by tag-path ratios.

A page is read once into blocks (runs of inline text between block-level tags),
each with its root-to-leaf tag path.  Per path, text length and punctuation are
aggregated and divided by the number of blocks with that path (text and
punctuation to path ratios); each block takes its path's ratios, the two
sequences are smoothed in page order by a Gaussian, fused by their geometric
mean, and paths whose mean reaches ``LAMBDA`` standard deviations are content
paths.  The content region is the article or main element that holds most of the
selected score, and the whole page if there is none; inside it blocks of content
paths are kept, and so are headings and paragraphs whose own path is too rare to
pass, unless (outside of articles) mostly links or opening like a copyright notice.

Subtrees whose element or class names say menu, header, footer, sidebar, notice,
advert, form, comments and the like score nothing and are never kept.  A class
name or a form that wraps the article itself (contains an article, main or h1
element) does not count, nor does a reader-comment name around the page's first
of these if no paragraph comes before it; of a class name the whole, the first and the last part are looked at, and
names of a state (``no-sidebar``, ``comments-open``) say nothing.  Inside an
article only a whole name counts, or a part that says readers' comments, advert,
form or navigation: linked titles, lists of references, the article's own header
and sections with telling names (``related-work``) belong to it.

A page costs time and memory in proportion to its length, however deep its
elements nest: paths are numbers, and what a subtree holds is summed once.

Parsing follows how browsers read broken markup: raw-text elements, implied end
tags, unclosed and stray tags, unquoted or unclosed attributes, comments.

Defined cases: null or empty html gives empty text; a page without content
gives empty text; pages of any length are read whole; repeated rows are each
extracted; extra columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import bounded_batches

LAMBDA = 0.5
REGION_SHARE = 0.8
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)

# Element and class names as HTML and web pages use them.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"head", "script", "style", "noscript", "template", "nav", "footer", "aside", "button", "select", "option", "textarea",
           "iframe", "svg", "canvas", "object", "dialog", "menu", "title", "datalist", "annotation", "audio", "video"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
          "tt", "u", "var", "wbr", "br", "input", "nobr",
          "math", "mi", "mn", "mo", "ms", "mrow", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot", "mtext", "mover", "munder",
          "munderover", "mstyle", "mfenced", "semantics"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BODY_TEXT = HEADINGS | {"p", "blockquote", "pre", "li", "dd", "dt", "td", "th", "figcaption", "caption"}
ARTICLES = {"article", "main"}
WRAPS = {"html", "body", "article", "main"} | HEADINGS
BOILERPLATE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs",
               "comment", "comments", "commentlist", "consent", "cookie", "cookies", "copyright", "disclaimer", "disqus", "footer",
               "gdpr", "hidden", "legal", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
               "pager", "pagination", "popup", "promo", "promoted", "promotion", "related", "recommended", "replies", "reply",
               "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe",
               "toolbar", "topbar", "widget", "header"}
READERS = {"comment", "comments", "commentlist", "disqus", "replies", "reply", "respond"}
#: names that count inside an article too when they are only a part of a class name
INSIDE = READERS | {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promoted",
                    "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pager", "pagination", "form", "newsletter",
                    "signup", "subscribe", "login", "share", "sharing", "social"}
#: first and last parts of class names that speak of a page's state, not of the element
STATE_FIRST = {"no", "non", "not", "has", "with", "without", "overflow"}
STATE_LAST = {"open", "opened", "closed", "enabled", "disabled"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "menubar", "form"}
#: an element closes these open elements first
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"}}
SCOPES = {"ul", "ol", "dl", "table", "select", "div", "article", "section", "body", "html"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)
|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>
|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?|"[^"]*"|'[^']*'""")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_NOTICE = re.compile(r"(?:©|\(c\)|copyright\b)", re.I)
_MARK = re.compile(r"[.,;:!?…、。，！？]")


@dataclass(eq=False, slots=True)
class Element:
    tag: str
    path: int
    parent: Element | None
    place: int = 0  # in the stack of open elements
    marked: set[str] = field(default_factory=set)  # class names that say boilerplate
    dropped: bool = False  # for certain
    wraps: bool = False  # contains an article, main or h1
    holds: bool = False  # contains the page's first of them, no reader's comment and with no paragraph before
    article: bool = False  # is or lies in an article or main
    link: bool = False  # is or lies in a link, with inline elements between
    block: Element | None = None  # the nearest element that is not inline: itself or above
    kept: bool = True  # neither it nor an element above is boilerplate
    header: bool = False  # is or lies in a header
    score: float = 0.0
    fit: int = 0  # blocks that fit in the subtree
    fit_article: int = 0  # of them, in an article
    leads: bool = False  # a block of the subtree lies in an article
    children: list[Element] = field(default_factory=list)

    def out(self) -> bool:
        """Whether the subtree is boilerplate."""
        if self.dropped:
            return True
        if self.tag in WRAPS:
            return bool(self.marked & READERS) and self.tag == "article"
        if self.marked & READERS:
            return not self.holds
        return bool(self.marked) and not self.wraps


@dataclass(eq=False, slots=True)
class Block:
    element: Element
    path: int
    text: str
    links: int


def _names(value: str, article: bool) -> set[str]:
    """Boilerplate names that a class or id attribute gives: a whole class name, its first or its last part."""
    out = set()
    for name in value.split():
        parts = [x.lower() for x in _NAME.findall(name)]
        if parts and parts[0] not in STATE_FIRST and parts[-1] not in STATE_LAST:
            out |= {parts[0], parts[-1]} & (INSIDE if article else BOILERPLATE) | {"".join(parts)} & BOILERPLATE
    return out


def _attributes(raw: str, article: bool) -> tuple[set[str], bool, str]:
    """(boilerplate names, hidden, first class)."""
    marked, hidden, first = set(), False, ""
    for key, value in _ATTR.findall(raw):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id"):
            marked |= _names(value, article)
            if key == "class":
                first = value.split(" ")[0]
        elif key == "role":
            if value.lower() in ROLES:
                marked.add("nav")
        elif key == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif key == "aria-hidden":
            hidden |= value.lower() == "true"
        elif key == "hidden" and not value:
            hidden = True
    return marked, hidden, first


class Reader:
    """One pass over a page: blocks in page order."""

    def __init__(self, page: str):
        self.root = Element("", 0, None)
        self.root.block = self.root
        self.stack: list[Element] = [self.root]
        self.elements: list[Element] = [self.root]
        self.open_tags: dict[str, int] = {}
        self.paths: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.links, self.at, self.empty = 0, self.root, True
        self.found, self.paragraph = False, False
        pos, size = 0, len(page)
        while pos < size:
            m = _TAG.search(page, pos)
            if m is None:
                self.text(page[pos:])
                break
            if m.start() > pos:
                self.text(page[pos:m.start()])
            pos = m.end()
            name = m["name"] or m["name2"]
            if not name:
                if m.group().startswith("<![CDATA["):
                    self.text(m.group()[9:].removesuffix("]]>"))
                continue
            tag = name.lower()
            if m["end"] or m["end2"]:
                self.close(tag)
                continue
            raw = m["attrs"] or m["attrs2"] or ""
            if tag in RAW:
                end = re.compile(rf"</{tag}\s*[^>]*(?:>|\Z)", re.I).search(page, pos)
                pos = end.end() if end else size
                continue
            self.open(tag, raw)
        self.flush()

    def text(self, raw: str) -> None:
        if not raw.isspace():
            if self.stack[-1].link:
                self.links += len(raw)
            if self.empty:
                self.at, self.empty = self.stack[-1], False
        self.parts.append(raw)

    def flush(self) -> None:
        text = "" if self.empty else " ".join(html_lib.unescape("".join(self.parts)).split())
        if text:
            e = self.at.block
            self.blocks.append(Block(e, self.at.path, text, self.links))
            if e.tag == "p" and not self.found and not self.paragraph:
                self.paragraph = not _outside(e)
        self.parts, self.links, self.at, self.empty = [], 0, self.root, True

    def drop(self, k: int) -> None:
        """The open elements from place ``k`` on end."""
        for e in self.stack[k:]:
            self.open_tags[e.tag] -= 1
        del self.stack[k:]

    def open(self, tag: str, raw: str) -> None:
        if tag in INLINE:
            if tag == "br":
                self.parts.append("\n")
        else:
            self.flush()
            near = self.stack[-1].block
            if near.tag == "p":  # a block-level tag ends a paragraph
                self.drop(near.place)
            if tag in CLOSES:
                self.pop(CLOSES[tag], SCOPES)
            if tag in HEADINGS:
                self.pop(HEADINGS, SCOPES)
        if tag in VOID or raw.endswith("/") and tag not in INLINE and tag not in ("div", "p"):
            return
        parent = self.stack[-1]
        marked, hidden, first = _attributes(raw, parent.article) if raw else (set(), False, "")
        step = (parent.path, f"{tag}.{first}" if first and tag not in INLINE else tag)
        e = Element(tag, self.paths.setdefault(step, len(self.paths) + 1), parent, len(self.stack), marked)
        e.dropped = hidden or tag in DROPPED
        e.article = parent.article or tag in ARTICLES
        e.block = parent.block if tag in INLINE else e
        e.link = tag == "a" or tag in INLINE and parent.link
        e.header = parent.header or tag == "header"
        if tag == "header":
            e.dropped = e.dropped or not parent.article
        elif tag == "form":
            e.marked = e.marked | {"form"}
        if tag in ("article", "main", "h1"):
            first_one = not self.found and not (tag == "article" and marked & READERS) and not self.paragraph
            self.found |= first_one
            for x in reversed(self.stack):
                if x.wraps and not first_one:
                    break  # so are all above
                x.wraps = True
                x.holds |= first_one
        self.stack.append(e)
        self.elements.append(e)
        parent.children.append(e)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def pop(self, tags: set[str], stop: set[str]) -> None:
        """Close open elements down to the lowest one named in ``tags``, if no ``stop`` lies above it."""
        if not any(self.open_tags.get(t) for t in tags):
            return
        e = self.stack[-1].block
        while e.place and e.tag not in stop:
            if e.tag in tags:
                self.drop(e.place)
                return
            e = e.parent.block

    def close(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if not self.open_tags.get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self.drop(i)
                return
            if tag in INLINE and self.stack[i].tag not in INLINE:
                return  # an inline end tag does not cross its block


def _outside(e: Element | None) -> bool:
    """Whether an element, as far as the page is read, lies in boilerplate."""
    while e is not None:
        if e.out() or e.tag == "header":
            return True
        e = e.parent
    return False


def smooth(x: np.ndarray) -> np.ndarray:
    """Gaussian smoothing in page order; at the ends the kernel's weights that lie inside count."""
    side = len(KERNEL) // 2
    full = lambda v: np.convolve(v, KERNEL)[side:len(v) + side]
    return full(x) / full(np.ones(len(x)))


def extract(page: str | None) -> str:
    """Main text of one page: kept blocks in page order, joined by newlines."""
    if not page:
        return ""
    reader = Reader(page)
    for e in reader.elements:  # parents first
        e.kept = (e.parent is None or e.parent.kept) and not e.out()
    # of an article's own header only headings and paragraphs
    blocks = [b for b in reader.blocks if b.element.kept and (not b.element.header or b.element.tag in HEADINGS or b.element.tag == "p")]
    if not blocks:
        return ""
    # ratios of each path, given to its blocks
    paths, which, count = np.unique([b.path for b in blocks], return_inverse=True, return_counts=True)
    length = np.array([len(b.text) for b in blocks], float)
    plain = np.array([len(b.text) - b.links for b in blocks], float).clip(0)
    marks = np.array([len(_MARK.findall(b.text)) if b.links < len(b.text) else 0 for b in blocks], float)
    ratio = np.bincount(which, plain) / count
    points = np.bincount(which, marks) / count
    fused = np.sqrt(smooth(ratio[which]) * (smooth(points[which]) + 0.1))
    mean = np.bincount(which, fused) / count
    content = mean >= LAMBDA * fused.std()
    chosen = content[which] & (plain > 0)
    fits = [bool(chosen[i]) or b.element.tag in BODY_TEXT and (b.element.article or b.links < 0.5 * len(b.text)) for i, b in enumerate(blocks)]
    fits = [f and (b.element.article or not _NOTICE.match(b.text)) for f, b in zip(fits, blocks)]
    # region: from the root down while one child holds most of the selected score, to an article or main if there is one;
    # only blocks outside all articles are left behind, and none on a page without any
    for i, b in enumerate(blocks):
        e = b.element
        e.leads |= e.article
        e.fit += fits[i]
        e.fit_article += fits[i] and e.article
        if chosen[i]:
            e.score += float(fused[i] * length[i])
    for e in reversed(reader.elements):  # children first: sums of subtrees
        if e.parent is not None:
            e.parent.score += e.score
            e.parent.fit += e.fit
            e.parent.fit_article += e.fit_article
            e.parent.leads |= e.leads
    region, total = reader.root, reader.root.score
    while total and region.tag not in ARTICLES:
        best = max(region.children, key=lambda e: e.score, default=None)
        if best is None or best.tag in BODY_TEXT or best.score < REGION_SHARE * total:
            break
        if region.fit_article > best.fit_article or not best.leads and region.fit > best.fit:
            break
        region = best
    inside = {id(region)}
    for e in reader.elements:
        if e.parent is not None and id(e.parent) in inside:
            inside.add(id(e))
    return "\n".join(b.text for f, b in zip(fits, blocks) if f and id(b.element) in inside)


def extract_column(page: Column) -> Column:
    def run(p: pa.Array) -> pa.Array:
        return pa.array([extract(x.as_py()) for x in p], pa.string())

    return F.arrow_udf(run, "string")(page)


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, text and n_chars (code points) of every page."""
    bounded_batches(pages.sparkSession)
    got = pages.select(*keep, extract_column(F.col(html_col)).alias("text"))
    return got.select(*keep, "text", F.length("text").cast("long").alias("n_chars"))
