"""Main text of web pages by composite text density.

Every node of a page's element tree gets its characters per tag, adjusted for links; a node's density sum adds up its
children. The subtree with the largest density sum holds the article; the smallest density on the path from it to the body
is the threshold at which further subtrees belong to it too. Elements that are never part of an article (menus, forms,
scripts, notices, comments and the like, by tag or by the words of class, id and role) are left out beforehand.

Text inside a block has single spaces and no edges; blocks follow each other in page order, two line feeds apart. Null and
empty pages give the empty text, as do pages without text; unclosed and misnested tags are closed where browsers would;
repeated rows are rows of their own.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import Column, functions as F

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp template svg math".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NEVER = set("head script style noscript iframe template svg math nav footer aside form button select textarea input option dialog menu object embed canvas audio video map".split())
#: Words of class, id or role that mark what surrounds an article.
NEVER_WORDS = set(
    "ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments comment-list cookie cookies consent disqus footer form "
    "gdpr legal login masthead menu menubar modal nav navbar navigation newsletter notice pagination paywall popup promo promoted related replies search share sharing "
    "sidebar signup site-footer site-header skip social sponsor sponsored subscribe toolbar topbar widget complementary contentinfo".split()
)
CLOSES_P = BLOCK - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "summary", "figcaption"}
#: An opening tag ends these open elements, up to the nearest of the second set.
SIBLING = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


@dataclass(slots=True)
class Node:
    tag: str
    parent: Node | None
    never: bool = False
    parts: list = field(default_factory=list)  # texts and nodes
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    density_sum: float = 0.0


def _unwanted(tag: str, attributes: str, parent: Node) -> bool:
    if tag in NEVER or parent.never:
        return True
    up = parent
    while up and up.tag not in ("article", "main"):
        up = up.parent
    if tag == "header" and up is None:
        return True
    if attributes and tag not in ("body", "html", "article", "main"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                return True
            if name in ("class", "id", "role"):
                for w in value.split():
                    if w in NEVER_WORDS or (w in ("header", "page-header") and up is None) or not NEVER_WORDS.isdisjoint(re.split(r"[-_]+", w)):
                        return True
    return False


def parse(html: str) -> Node:
    """The element tree; a node knows whether it is left out."""
    root = Node("html", None)
    top, at, n = root, 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            top.parts.append(html[at:])
            break
        if m.start() > at:
            top.parts.append(html[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, close, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if close:
            if tag == "br":
                top.parts.append(" ")
                continue
            up = top
            while up.parent and up.tag != tag:
                if up.tag in BLOCK and tag not in BLOCK:  # an inline end tag does not close blocks
                    up = root
                    break
                up = up.parent
            if up.parent:
                top = up.parent
            continue
        if tag == "html":
            continue
        if tag == "body":
            while top.parent:
                top = top.parent
        elif tag in CLOSES_P:
            up = top
            while up.parent and up.tag not in ("p", "td", "th", "button", "object"):
                up = up.parent
            if up.tag == "p":
                top = up.parent
        if tag in SIBLING:
            ends, scope = SIBLING[tag]
            up, last = top, None
            while up.parent and up.tag not in scope:
                if up.tag in ends:
                    last = up
                up = up.parent
            if last:
                top = last.parent
        node = Node(tag, top, _unwanted(tag, attributes, top))
        top.parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            if tag == "title":
                node.never = True
        elif tag not in VOID and not attributes.endswith("/"):
            top = node
    return root


def _weigh(root: Node) -> list[Node]:
    """Counts and densities of the wanted nodes, children before parents; returned parents first."""
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        order.append(x)
        stack.extend(c for c in x.parts if isinstance(c, Node) and not c.never)
    for x in reversed(order):
        for c in x.parts:
            if isinstance(c, Node):
                if not c.never:
                    x.chars, x.tags = x.chars + c.chars, x.tags + c.tags + 1
                    x.link_chars, x.link_tags = x.link_chars + c.link_chars, x.link_tags + c.link_tags + (c.tag == "a")
            else:
                x.chars += len("".join(c.split()))
        if x.tag == "a":
            x.link_chars = x.chars
    body_c, body_l = max(1, root.chars), root.link_chars
    for x in reversed(order):
        c, t = x.chars, max(1, x.tags)
        if c:
            plain = max(1, c - x.link_chars)
            base = math.log(c / plain * x.link_chars + body_l / body_c * c + math.e)
            ratio = c / max(1, x.link_chars) * t / max(1, x.link_tags)
            x.density = c / t * max(0.0, math.log(max(1.0, ratio)) / base)
        x.density_sum = sum(k.density for k in x.parts if isinstance(k, Node) and not k.never) if any(isinstance(k, Node) and not k.never for k in x.parts) else 0.0
    return order


def _densest(top: Node) -> Node:
    best, stack = top, [top]
    while stack:
        x = stack.pop()
        if x.density_sum > best.density_sum:
            best = x
        stack.extend(reversed([c for c in x.parts if isinstance(c, Node) and not c.never]))
    return best


def main_nodes(root: Node) -> set[int]:
    """Ids of the subtrees that make up the article."""
    best = _densest(root)
    article, up = None, best
    while up:
        if up.tag in ("article", "main"):
            article = up
        up = up.parent
    if article is not None:  # the page says where the article ends
        return {id(article)}
    threshold, up = best.density, best
    while up.parent:
        threshold = min(threshold, up.density)
        up = up.parent
    found: set[int] = set()
    stack = [root]
    while stack:
        x = stack.pop()
        if id(x) in found or not x.chars:
            continue
        if x.density >= threshold and (x is not root or x is best):
            dense = _densest(x)
            found.add(id(dense if dense.density_sum else x))
            if dense is x or not dense.density_sum:
                continue
        stack.extend(c for c in x.parts if isinstance(c, Node) and not c.never)
    return found or {id(best)}


def extract(html: str | None) -> str:
    if not isinstance(html, str) or not html:
        return ""
    root = parse(html)
    _weigh(root)
    wanted = main_nodes(root)
    blocks: list[str] = []
    line: list[str] = []

    def close():
        text = " ".join(unescape("".join(line)).split())
        line.clear()
        if text:
            blocks.append(text)

    stack: list[tuple[object, bool]] = [(root, False)]
    while stack:
        x, inside = stack.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            if inside:
                line.append(x)
        elif not x.never:
            inside = inside or id(x) in wanted
            if x.tag == "br":
                line.append(" ")
            block = x.tag in BLOCK
            if block:
                close()
                stack.append((None, False))
            stack.extend((c, inside) for c in reversed(x.parts))
    close()
    return "\n\n".join(blocks)


def main_text(html: Column) -> Column:
    """The article of a page as text."""

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(x) for x in pages], dtype=object)

    return text(html)
