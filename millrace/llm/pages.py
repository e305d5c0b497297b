"""HTML extraction with a site style tree.

The DOMs of all pages of a host are merged: elements with the same path of tags and classes are one
node of the host's tree. A node's importance weighs two entropies over the host's pages. Presentation:
the sequences of child tags found in the node; one layout on all pages says nothing. Content: the
blocks of text below the node; a block spread evenly over all pages counts nothing, one found on a
single page counts fully. Branches of low importance are removed from each page, besides those whose
tags, roles or names declare them to be something else than text.

The tree also tells where the text stands: the mass of a node is the characters below it per page, each
block weighed by its content importance. From the root down, the child that holds nearly all the mass of
its parent is followed, so that short unique texts beside the article (adverts, link lists) stay out
whatever their elements are called.

A tree is kept as rows (host, path, signature) and never in one place; what a page needs of it are the
short lists of its host's unimportant and of its main paths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import discard, filled, stored, strings, unused

PRESENTATION = 0.3  # weight of presentation against content
LEAST = 0.3  # nodes below this importance go
SHARE = 0.2  # of the host's pages that must hold a node before it is judged
PAGES = 3  # fewer pages of a host say nothing
MAIN = 0.75  # of the mass of its parent that a main node holds

# Elements by what HTML makes of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
INLINE_ROOTS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td th dd dt figcaption b i em strong a span".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
    "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",),
}
BARRIER = frozenset("table ul ol dl div section article main aside nav body html select".split())

# Elements, roles and name parts that declare something else than main text.
OTHER_TAGS = frozenset(
    "script style head title nav footer aside form noscript template iframe button select option input textarea "
    "svg canvas object dialog menu audio video map datalist xmp noembed noframes".split()
)
OTHER_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination popup promo promotion recommended related replies reply respond search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar widget".split()
)
COMMENT_NAMES = frozenset("comment comments reply replies ad ads advert promo sponsored related teaser".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^\"'>]*(?:\"[^\"]*\"[^\"'>]*|'[^']*'[^\"'>]*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Element:
    __slots__ = ("tag", "path", "other", "low", "article", "level", "open", "children", "blocks")

    def __init__(self, tag: str, path: int, other: bool, low: bool, article: bool, level: int, main: bool):
        self.tag, self.path, self.other, self.low, self.article = tag, path, other, low, article
        self.level = level  # of the innermost main node around
        self.open = main  # whether main nodes may lie directly below
        self.children: list[str] = []
        self.blocks: list[tuple[int, int]] = []


def _declared(tag: str, attributes: str, article: bool) -> tuple[bool, str]:
    """Whether an element declares itself not to be text, and its classes for the path."""
    other = tag in OTHER_TAGS or (tag == "header" and not article)
    if not attributes.strip():
        return other, ""
    found = {}
    for name, value in ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), unescape(value.strip("\"'")))
    names = {n.lower() for a in ("class", "id") if a in found for n in NAME.findall(found[a])}
    if tag in ("article", "main", "body", "html"):
        other = other or (tag == "article" and not names.isdisjoint(COMMENT_NAMES))
    else:
        other = other or not names.isdisjoint(OTHER_NAMES) or ("header" in names and not article)
    other = other or found.get("role", "").lower() in OTHER_ROLES or "hidden" in found
    other = other or found.get("aria-hidden", "").lower() == "true"
    other = other or "display:none" in found.get("style", "").replace(" ", "").lower()
    return other, " ".join(sorted(found.get("class", "").split()))


class Page:
    """One pass over a page: texts of its blocks, and if wanted the rows of its style tree.

    A row is a path, 0 and the hash of a layout, and the path of the parent; or a path, 1 and the hash of
    a block below it, and the block's characters (0 if declared to be no text).
    """

    def __init__(self, html: str, low: frozenset[int] = frozenset(), main: frozenset[int] = frozenset(), collect: bool = False):
        self.low, self.main, self.collect = low, main, collect
        self.stack = [Element("", 0, False, False, False, 0, True)]
        self.kept: list[tuple[int, bool, str]] = []  # level, whether in an article, text
        self.run: list[str] = []  # text of the open block
        self.rows: dict[tuple[int, int, int], int] = {}
        self._read(html)

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            found = TOKEN.search(html, at)
            start = found.start() if found else size
            if start > at:
                self._text(html[at:start])
            if not found:
                break
            at = found.end()
            tag = found[2] or found[5]
            if not tag:
                continue
            tag = tag.lower()
            if found[1] or found[4]:
                self._close(tag)
                continue
            attributes = found[3] or found[6] or ""
            self._open(tag, attributes)
            if tag in RAW and self.stack[-1].tag == tag:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
                at = end.start() if end else size
                if not end:
                    break
        self._flush()
        while len(self.stack) > 1:
            self._pop()
        if self.collect:
            self._note(self.stack[0], 0)

    def _text(self, text: str) -> None:
        top = self.stack[-1]
        if self.collect or not (top.other or top.low):
            self.run.append(unescape(text) if "&" in text else text)

    def _flush(self) -> None:
        if not self.run:
            return
        text = " ".join("".join(self.run).split())
        self.run.clear()
        if not text:
            return
        top = self.stack[-1]
        if self.collect:
            top.blocks.append((_hash(text), 0 if top.other else len(text)))
        if not (top.other or top.low):
            self.kept.append((top.level, top.article, text))

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._flush()
            if tag != "br":
                self._imply("p", BARRIER)
        for closed in CLOSES.get(tag, ()):
            self._imply(closed, BARRIER)
        top = self.stack[-1]
        top.children.append(tag)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            return
        other, classes = _declared(tag, attributes, top.article)
        path = _hash(f"{top.path} {tag} {classes}")
        article = tag in ("article", "main") and not other
        main = top.open and path in self.main and not other and tag not in INLINE_ROOTS
        # an article is text even where all pages of a host hold the same one, and so are its paragraphs
        low = not article and not main and (top.low or path in self.low and not (top.article and tag in INLINE_ROOTS))
        # an article is taken whole: nothing below it is preferred to the rest of it
        self.stack.append(Element(tag, path, top.other or other, low, top.article or article, top.level + main, main and not article))

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            if self.stack[depth].tag in BARRIER and tag not in BARRIER:
                return

    def _imply(self, tag: str, barrier: frozenset[str]) -> None:
        """Close the nearest open ``tag`` unless a barrier stands between."""
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                while len(self.stack) > depth:
                    self._pop()
                return
            if self.stack[depth].tag in barrier:
                return

    def _pop(self) -> None:
        if self.stack[-1].tag in BLOCK:
            self._flush()
        done = self.stack.pop()
        if self.collect:
            self._note(done, self.stack[-1].path)
            self.stack[-1].blocks += done.blocks

    def _note(self, done: Element, parent: int) -> None:
        self.rows[done.path, 0, _hash(" ".join(done.children))] = parent
        for block, chars in done.blocks:
            self.rows[done.path, 1, block] = max(chars, self.rows.get((done.path, 1, block), 0))

    @property
    def text(self) -> str:
        """What stands in the innermost main node that holds text; its article, where the tree goes no further."""
        level = max((k[0] for k in self.kept), default=0)
        own = [k for k in self.kept if k[0] == level]
        return " ".join(text for _, _, text in [k for k in own if k[1]] or own)


def _hash(text: str) -> int:
    found = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
    return found - (1 << 64) if found >> 63 else found


def host_of(url: Column) -> Column:
    """The lower-case host of a URL column, empty where there is none."""
    return F.lower(F.regexp_extract(filled(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _tree_rows(pages: pa.Array) -> pa.Array:
    names = ("path", "kind", "signature", "extra")
    kind = pa.list_(pa.struct([("path", pa.int64()), ("kind", pa.int32()), ("signature", pa.int64()), ("extra", pa.int64())]))
    found = [[dict(zip(names, (*r, x), strict=True)) for r, x in Page(h, collect=True).rows.items()] for h in strings(pages)]
    return pa.array(found, kind)


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host``, ``path``, ``parent``, ``pages`` with the node, ``of`` all pages of the host, its
    ``importance`` and its ``mass``: characters below it per page with the node, weighed by importance.

    Equal pages of one host count as often as they come. The root has the path 0.
    """
    named = pages.select(host_of(F.col(url)).alias("host"), filled(html).alias("html"))
    read = F.arrow_udf(_tree_rows, "array<struct<path: bigint, kind: int, signature: bigint, extra: bigint>>")
    rows = named.select("host", F.inline(read("html")))
    counted = rows.groupBy("host", "path", "kind", "signature").agg(F.count("*").alias("n"), F.max("extra").alias("extra"))
    counted = stored(counted)
    pages_of = named.groupBy("host").agg(F.count("*").alias("of"))
    total = F.sum("n")
    spread = F.sum(F.col("n") * F.log(F.col("n")))
    chars = F.col("n") * F.col("extra")
    node = counted.groupBy("host", "path", "kind").agg(
        total.alias("total"),
        spread.alias("spread"),
        F.max("extra").alias("extra"),
        F.sum(F.when(F.col("kind") == 1, chars)).alias("chars"),
        F.sum(F.when(F.col("kind") == 1, chars * F.log("n"))).alias("shared"),
    )
    # children: every page has one or more layouts, entropy of their shares; blocks: mean entropy of each over pages
    layout, content = F.col("kind") == 0, F.col("kind") == 1
    merged = node.groupBy("host", "path").agg(
        F.sum(F.when(layout, F.col("total"))).alias("pages"),
        F.sum(F.when(layout, F.log("total") - F.col("spread") / F.col("total"))).alias("layouts"),
        F.sum(F.when(content, F.col("spread") / F.col("total"))).alias("blocks"),
        F.max(F.when(layout, F.col("extra"))).alias("parent"),
        F.sum("chars").alias("chars"),
        F.sum("shared").alias("shared"),
    )
    joined = merged.join(pages_of, "host")
    base = F.log(F.col("of"))
    presentation = F.least(F.col("layouts") / base, F.lit(1.0))
    text = F.coalesce(1 - F.col("blocks") / base, F.lit(0.0))
    weighed = PRESENTATION * presentation + (1 - PRESENTATION) * text
    few = F.col("of") < PAGES
    mass = F.coalesce(F.col("chars") - F.when(few, 0.0).otherwise(F.col("shared") / base), F.lit(0.0)) / F.col("pages")
    importance = F.when(few, 1.0).otherwise(weighed)
    return joined.select("host", "path", "parent", "pages", "of", importance.alias("importance"), mass.alias("mass"))


def _extracted(pages: pa.Array, low: pa.Array, main: pa.Array) -> pa.Array:
    known = lambda paths: frozenset(paths.as_py() or ())
    texts = [Page(html, known(a), known(b)).text for html, a, b in zip(strings(pages), low, main, strict=True)]
    return pa.array(texts, pa.string())


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with the main ``text`` and its length ``n_chars`` in code points; columns of these names
    are replaced.

    One row per input row, repeated rows alike. NULL and empty pages have an empty text; pages with no
    host in their URL, or a NULL URL, form one host. The text is that of the main branch of the host's
    tree; where no branch holds MAIN of the mass, or the host has too few pages, it is the page's article
    or main element, or what is left of its body if it has none.
    """
    # a host has at most (nodes of a page) / SHARE such paths, and a parent is on all pages of its child
    tree = style_tree(pages, url, html).filter((F.col("pages") >= SHARE * F.col("of")) & (F.col("of") >= PAGES))
    tree = stored(tree)
    above = tree.select("host", F.col("path").alias("parent"), F.col("mass").alias("whole"))
    low = F.when(F.col("importance") < LEAST, F.col("path"))
    main = F.when((F.col("mass") >= MAIN * F.col("whole")) & (F.col("mass") > 0) & (F.col("path") != 0), F.col("path"))
    lists = tree.join(above, ["host", "parent"], "left").groupBy("host")
    lists = stored(lists.agg(F.collect_set(low).alias("_low"), F.collect_set(main).alias("_main")))
    discard(tree)
    host, low_, main_, found = unused(pages, "host", "low", "main", "found")
    lists = lists.select(F.col("host").alias(host), F.col("_low").alias(low_), F.col("_main").alias(main_))
    joined = pages.join(lists, host_of(F.col(url)) == F.col(host), "left")
    texts = F.arrow_udf(_extracted, "string")
    joined = joined.withColumn(found, texts(filled(html), low_, main_)).drop(host, low_, main_)
    return joined.withColumns({"text": F.col(found), "n_chars": F.char_length(found).cast("long")}).drop(found)
