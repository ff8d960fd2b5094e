"""Main text of web pages by composite text density.

A page becomes a tree of elements. Each node gets its characters per tag, adjusted by the
share of link characters and link tags in it and in the body (composite text density). The
densities of a node's children are added up; the container with the largest sum holds the article.
The smallest density on the path from the body to that container is the threshold: the result is
the article element around the container if there is one, otherwise the container and every
neighbouring block that reaches the threshold. Elements that are never part of an article (menus,
headers outside an article, footers, sidebars, notices, adverts, forms, scripts, styles, comments)
take no part in any density.

A name alone never removes the article: a form, or an element with such a word inside a longer name
(``with-sidebar``, ``comments-open``), that holds more than half of the body's characters outside links
takes part like any other, and so does any labelled element when nothing else of the body has text. An
unlabelled article or main element with text settles it: then labels stand.

Text: character references decoded, white space inside a block one space, trimmed, blocks in page
order joined by a line feed. A ``<br>`` is white space inside its block.

Cases: a null or empty page, or one without any text, gives an empty text and 0 characters. Broken
markup (unclosed or stray tags, an unclosed comment) never fails. Rows are independent, so repeated
rows repeat their result; null ids and urls are handed through; no rows give no rows.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*>",
    re.S,
)
_LABELS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HREF = re.compile(r"\bhref\s*=", re.I)
_PART = re.compile(r"[a-z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe template svg select annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr object math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot "
    "mover munder munderover mstyle mpadded mphantom menclose semantics mtable mtr mtd".split()
)
CONTAINER = frozenset("html body main article section div td center blockquote".split())
#: Elements that close an open paragraph.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",),
}
SCOPE = frozenset("html body table ul ol dl article section div main aside nav footer header td th form".split())
NEVER = frozenset("head nav footer aside form button dialog menu".split())
LABELS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies "
    "consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription nav navbar navigation "
    "menu menus breadcrumb breadcrumbs sidebar aside footer masthead topbar comment comments disqus replies related share "
    "sharing social widget pagination pager complementary contentinfo".split()
)


#: How sure a mark is that its element is no part of an article.
PART, NAMED = 1, 2


class _Node:
    __slots__ = (
        "tag", "parent", "block", "mark", "drop", "link", "chars", "tags", "link_chars", "link_tags", "density", "total",
        "children", "holds",
    )

    def __init__(self, tag: str, parent: "_Node | None", mark: int, link: bool = False):
        self.tag, self.parent, self.mark, self.drop, self.link = tag, parent, mark, mark > 0, link
        #: The block whose text this is: an inline element belongs to the block around it.
        self.block: _Node = parent.block if parent is not None and tag in INLINE else self
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.children: list[_Node] = []
        self.holds = False  # an article or main element somewhere inside
        if parent is not None:
            parent.children.append(self)


class _Open:
    """The open elements; where each tag stands is kept, so that no end tag searches the stack."""

    def __init__(self, root: _Node):
        self.stack = [root]
        self.at: dict[str, list[int]] = {root.tag: [0]}
        self.blocks = [0]  # places of elements that are not inline
        self.links = 0

    def push(self, node: _Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        if node.tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.links += node.link
        self.stack.append(node)

    def innermost(self, names) -> int:
        return max((self.at[x][-1] for x in names if self.at.get(x)), default=-1)

    def has(self, *names: str) -> bool:
        return self.innermost(names) >= 0

    def cut(self, place: int) -> None:
        """End the element at ``place`` and all inside it."""
        for node in reversed(self.stack[place:]):
            self.at[node.tag].pop()
            self.links -= node.link
            if node.tag not in INLINE:
                self.blocks.pop()
        del self.stack[place:]


def _mark(attributes: str) -> int:
    """NAMED if a class, id or role is one of the labels, PART if one of them is part of a longer name."""
    best = 0
    if "=" in attributes:
        for found in _LABELS.findall(attributes):
            for name in "".join(found).lower().split():
                if name in LABELS:
                    return NAMED
                if not LABELS.isdisjoint(_PART.findall(name)):
                    best = PART
    return best


def _tree(page: str) -> tuple[_Node, list[_Node], list[tuple[_Node, str, int]]]:
    """The root, all nodes in page order, and the text blocks (node, text, link characters)."""
    root = _Node("html", None, 0)
    opened, nodes, blocks = _Open(root), [root], []
    held: list[str] = []
    links = 0

    def flush():
        nonlocal links
        if held:
            text = " ".join("".join(held).split())
            if text:
                blocks.append((opened.stack[-1].block, text, min(links, len(text))))
            held.clear()
        links = 0

    def close(names, until=SCOPE) -> None:
        place = opened.innermost(names)
        if place > 0 and place >= opened.innermost(until):
            flush()
            opened.cut(place)

    def close_inline(name: str) -> None:
        """End the innermost such element of this block, if there is one; the text goes on."""
        place = opened.innermost((name,))
        if place > opened.blocks[-1]:
            opened.cut(place)

    raw_open = False
    at, size = 0, page.rfind(">") + 1  # behind that there is only text
    while at < size:
        found = _TOKEN.search(page, at, size)
        end = found.start() if found else size
        if end > at:
            text = page[at:end]
            if "&" in text:
                text = html.unescape(text)
            held.append(text)
            if opened.links:
                links += len(text.strip())
        if not found:
            break
        at = found.end()
        if found[0].startswith("<!--") and not found[0].endswith("-->"):
            raw_open = True
        closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            if name in VOID or name in ("html", "body"):
                continue
            if name in INLINE:
                close_inline(name)
            else:
                close((name,), ())
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else size
            raw_open = stop is None
            continue
        if name == "html":
            continue
        if name == "br" or name in VOID:
            held.append(" ")
            if name == "hr":
                flush()
            continue
        if name not in INLINE:
            flush()
            close(("p",))
            if name in CLOSES:
                close(CLOSES[name], ("ul", "ol", "dl", "table", "body") if name != "tr" else ("table", "body"))
        elif name == "a":
            close_inline("a")
        mark = PART if name == "form" else NAMED if name in NEVER else _mark(attributes)
        if name == "header":
            mark = 0 if opened.has("article", "main") else NAMED
        if name == "body":
            if opened.has("body"):
                continue
            mark = 0
        node = _Node(name, opened.stack[-1], mark, name == "a" and _HREF.search(attributes) is not None)
        if name in ("article", "main") and not mark or name == "body":
            up = node
            while up is not None and not up.holds:
                up.holds = True
                up = up.parent
        nodes.append(node)
        opened.push(node)
    if not raw_open:
        held.append(html.unescape(page[size:].partition("<!--")[0]))
    flush()
    return root, nodes, blocks


def _lift(root: _Node, nodes: list[_Node], blocks: list[tuple[_Node, str, int]]) -> None:
    """Take the mark from elements that hold most of the body's characters outside links, as the module says."""
    own = dict.fromkeys(map(id, nodes), 0)
    for node, text, links in blocks:
        own[id(node)] += len(text) - links
    every, free, plain = dict(own), dict(own), {id(root): True}
    for node in nodes[1:]:
        plain[id(node)] = plain[id(node.parent)] and not node.mark
    for node in reversed(nodes[1:]):
        every[id(node.parent)] += every[id(node)]
        if not node.mark:
            free[id(node.parent)] += free[id(node)]
    if any(n.tag in ("article", "main") and plain[id(n)] and free[id(n)] for n in nodes):
        return
    node, outside = root, 0
    while True:
        heavy = next((n for n in node.children if 2 * every[id(n)] > every[id(root)]), None)
        outside += free[id(node)] - (free[id(heavy)] if heavy is not None and not heavy.mark else 0)
        if heavy is None:
            return
        if heavy.mark == NAMED and outside and heavy.tag not in ("article", "main"):
            return
        heavy.mark, node = 0, heavy


def _measure(root: _Node, nodes: list[_Node], blocks: list[tuple[_Node, str, int]]) -> None:
    """Characters, tags and densities of every node; what never counts is marked on all its nodes."""
    _lift(root, nodes, blocks)
    for node in nodes[1:]:  # parents come first
        node.drop = node.mark > 0
        if node.parent.drop and not (node.parent.holds and node.tag in ("article", "main")):
            node.drop = True
        elif node.drop and node.holds:
            node.drop = False  # a wrapper around the article
    for node, text, links in blocks:
        if not node.drop:
            node.chars += len(text)
            node.link_chars += links
    for node in reversed(nodes[1:]):
        if not node.drop:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.tags += node.tags + 1
            up.link_tags += node.link_tags + (node.tag == "a")
    body_share = root.link_chars / root.chars if root.chars else 0.0
    for node in nodes:
        if node.drop or not node.chars:
            continue
        plain = max(node.chars - node.link_chars, 1)
        base = math.log(node.chars / plain * node.link_chars + body_share * node.chars + math.e)
        ratio = node.chars / max(node.link_chars, 1) * max(node.tags, 1) / max(node.link_tags, 1)
        node.density = node.chars / max(node.tags, 1) * math.log(max(ratio, 1.0)) / max(math.log(max(base, math.e)), 1.0)
    for node in nodes[1:]:
        if not node.drop:
            node.parent.total += node.density


def extract(page: str | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    root, nodes, blocks = _tree(page)
    _measure(root, nodes, blocks)
    if not root.chars:
        return ""
    best = max((n for n in nodes if n.tag in CONTAINER and not n.drop and n.chars), key=lambda n: n.total)
    threshold, node, around = best.density, best, None
    while node is not None:
        if node.chars:
            threshold = min(threshold, node.density)
        if node.tag in ("article", "main") and around is None:
            around = node
        node = node.parent
    keep: set[int] = set()
    if around is not None:
        keep.add(id(around))
    else:
        keep.add(id(best))
        if best.parent is not None:
            keep.update(id(n) for n in best.parent.children if n.density >= threshold > 0 and not n.drop)
    inside: dict[int, bool] = {}
    for node in nodes:
        inside[id(node)] = not node.drop and (id(node) in keep or node.parent is not None and inside[id(node.parent)])
    return "\n".join(text for node, text, _ in blocks if inside[id(node)])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row for every page."""

    def run(batches):
        for part in slices(batches, "html"):
            texts = [extract(x) for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
