"""Blocks of text of an HTML page, with the containers that hold them. Any markup is read in one pass forwards."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_BARE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(\bhidden\b)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_ZEROS = re.compile(r"&#(?:(x)0+(?=[0-9a-f])|0+(?=[0-9]))", re.I)
#: Numbers too long for any character, but not for the regular decoding.
_BEYOND = re.compile(r"&#[0-9]{8,}")

# Element names of HTML
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "canvas", "object", "select", "button", "textarea",
       "head", "title", "audio", "video", "datalist", "dialog"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form", "fieldset",
              "ul", "ol", "dl", "menu", "table", "thead", "tbody", "tfoot", "figure", "blockquote", "center", "details"}
BLOCKS = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "caption", "pre", "hr", "address",
                       "figcaption", "summary", "legend", "option", "optgroup", "hgroup", "search"}
#: Cells of a row are parted by white space, as line breaks are.
GAPS = {"br", "td", "th", "wbr"}
#: Never the article's own text.
CHROME = {"nav", "footer", "aside", "menu", "search"}

# Words in class, id and role that mark what is not the article
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promotion",
         "sidebar", "sidebars", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar",
         "toolbar", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "banner", "popup", "modal", "overlay",
         "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended",
         "recommendations", "trending", "widget", "widgets", "comment", "comments", "disqus", "reply", "replies", "respond",
         "pagination", "pager", "skip", "search", "contentinfo", "complementary", "dialog", "form", "disclaimer"}
HEADERS = {"header", "hdr"}


@dataclass(slots=True)
class Node:
    """A container; `chars` and `heads` count its text and its article, main and h1 elements, inner containers' included."""

    tag: str
    parent: int
    marked: bool
    chars: int = 0
    heads: int = 0


@dataclass(slots=True)
class Block:
    """`linked` is the share of the text that stands in links."""

    text: str
    node: int
    tag: str
    linked: float


@dataclass(slots=True)
class Page:
    nodes: list[Node]
    blocks: list[Block]


def _marked(tag: str, attributes: str) -> bool:
    if not attributes or tag in ("html", "body", "main"):
        return False
    words: set[str] = set()
    for name, a, b, c, hidden in _ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if hidden or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and "display:none" in value.replace(" ", "").lower()):
            return True
        if name in ("class", "id", "role", "itemprop"):
            words.update(w.lower() for w in _WORD.findall(value))
    return bool(words & MARKS) or (bool(words & HEADERS) and bool(words & {"site", "page", "top", "global", "main"}))


def _decoded(text: str) -> str:
    """Character references resolved, white space as single spaces."""
    if "&#" in text:
        text = _BEYOND.sub("&#9999999", _ZEROS.sub(r"&#\1", text))
    return " ".join((entities.unescape(text) if "&" in text else text).split())


def parse(page: str) -> Page:
    """Blocks in page order. Scripts, styles, comments and form controls give none; unclosed ones hold the page's rest."""
    nodes, blocks = [Node("", -1, False)], []
    stack, opened = [0], {}
    text: list[str] = []
    tag_now, in_link, linked = "", False, 0
    at, size, pattern = 0, len(page), _TAG
    lower = None

    def flush() -> None:
        nonlocal linked
        if text:
            whole = _decoded("".join(text))
            if whole:
                blocks.append(Block(whole, stack[-1], tag_now, min(1.0, linked / len(whole))))
                nodes[stack[-1]].chars += len(whole)
            text.clear()
        linked = 0

    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            piece = page[at:start]
            text.append(piece)
            if in_link:
                linked += len(piece)
            if start == size:
                break
        after = page[start + 1:start + 4]
        if after.startswith(("!", "?")):
            end = page.find("-->", start + 4) + 2 if after == "!--" else page.find(">", start)
            if end < start + 2:
                break
            at = end + 1
            continue
        found = pattern.match(page, start)
        if not found and after[:1].isalpha() | after.startswith("/") and pattern is _TAG:
            # A quote is never closed: from here on a tag ends at the next bracket.
            pattern = _BARE_TAG
            found = pattern.match(page, start)
        if not found:
            if after.startswith("/") or after[:1].isalpha():
                end = page.find(">", start)
                if end < 0:
                    break
                at = end + 1
            else:
                text.append("<")
                at = start + 1
            continue
        at, closing, tag, attributes = found.end(), found[1], found[2].lower(), found[3]
        if tag in RAW:
            if closing:
                continue
            if tag in ("select", "button", "title", "head", "dialog"):
                flush()
            if attributes.endswith("/"):
                continue
            if tag == "head":
                continue
            if lower is None:
                lower = page.lower() if len(page.lower()) == size else re.sub("[A-Z]", lambda m: m[0].lower(), page)
            end = lower.find("</" + tag, at)
            if end < 0:
                break
            at = lower.find(">", end) + 1 or size
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag in GAPS:
            text.append(" ")
            continue
        if tag not in BLOCKS:
            continue
        flush()
        tag_now = "" if closing else tag
        if tag == "h1" and not closing:
            nodes[stack[-1]].heads += 1
        if tag not in CONTAINERS:
            continue
        if not closing:
            nodes.append(Node(tag, stack[-1], _marked(tag, attributes)))
            stack.append(len(nodes) - 1)
            opened[tag] = opened.get(tag, 0) + 1
        elif opened.get(tag):
            while True:
                last = nodes[stack.pop()].tag
                opened[last] -= 1
                if last == tag:
                    break
    flush()
    for i in range(len(nodes) - 1, 0, -1):
        node = nodes[i]
        node.heads += node.tag in ("article", "main") and not node.marked
        up = nodes[node.parent]
        up.chars += node.chars
        up.heads += node.heads
    return Page(nodes, blocks)
