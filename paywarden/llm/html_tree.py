"""Blocks of text of an HTML page, and the elements that hold them.

A small reader for pages as they are found: unclosed paragraphs, list items and
cells end where the next begins, an end tag closes what is open inside its
element, stray end tags are passed over, a tag that never ends takes the rest
of the page with it.  Time is linear in the page.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b
from html import unescape

# Elements of HTML by their part in a page.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp"}
CONTAINERS = {"body", "div", "article", "main", "section", "td", "th", "center"}
TEXT_BLOCKS = HEADINGS | {"p", "li", "dd", "dt", "blockquote", "pre", "figcaption", "caption", "address", "summary"}
BLOCKS = CONTAINERS | TEXT_BLOCKS | {
    "html", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "figure", "hr", "details", "hgroup",
    "head", "header", "footer", "nav", "aside", "menu", "form", "fieldset", "legend", "dialog", "search",
    "noscript", "template", "svg", "math", "object", "canvas", "audio", "video", "select", "option", "optgroup", "datalist", "button",
}
#: Never part of an article's text, whatever they hold.
APART = {
    "head", "nav", "aside", "footer", "menu", "search", "dialog", "noscript", "template", "svg", "math",
    "object", "canvas", "audio", "video", "select", "datalist", "button",
}
#: Cells of a row are parts of one block.
CELLS = {"td", "th"}
_CLOSED_BY = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": CELLS, "th": CELLS, "option": {"option"}}
_CLOSED_BY |= {h: HEADINGS for h in HEADINGS}
_INSIDE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
_SCOPES = {"table", "td", "th", "caption"}

#: Words of classes, ids and roles that name what is not the article.
LAYOUT_WORDS = {
    "nav", "navbar", "navigation", "menu", "submenu", "menubar", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar", "topbar",
    "header", "masthead", "footer", "contentinfo", "sidebar", "aside", "complementary", "rail", "widget", "widgets", "form", "search", "skip",
    "banner", "popup", "modal", "overlay", "dialog", "share", "sharing", "social", "follow", "subscribe", "subscription", "newsletter",
    "signup", "login", "related", "recommended", "recommendations", "popular", "trending",
}
STRANGE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "adsense", "adslot", "adbox", "sponsor", "sponsored", "promo",
    "promoted", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "disclaimer", "paywall",
    "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus",
}
ARTICLE_WORDS = {"article", "post", "entry", "content", "story", "main", "text"}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_TELLING = re.compile("class|id|role", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE) for tag in RAW}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_EMPTY_COMMENT = re.compile("<!---?>")
_DIGITS = re.compile(r"\d+")


@lru_cache(maxsize=1 << 14)
def _below(path: bytes, name: str) -> bytes:
    return blake2b(path + name.encode(), digest_size=16).digest()


@dataclass
class Page:
    """Elements in page order, each with its parent's place, and blocks of text."""

    tag: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    name: list[str] = field(default_factory=list)  # generalised tag and classes
    words: list[set[str]] = field(default_factory=list)  # of classes, ids and roles
    owner: list[int] = field(default_factory=list)  # of each block
    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)  # characters inside links

    def path(self, element: int) -> str:
        names = []
        while element >= 0:
            names.append(self.name[element])
            element = self.parent[element]
        return "/".join(reversed(names))

    def keys(self) -> list[bytes]:
        """A digest of each element's path."""
        out: list[bytes] = []
        for name, parent in zip(self.name, self.parent):
            out.append(_below(out[parent] if parent >= 0 else b"", name))
        return out


def _words(text: str) -> set[str]:
    return {m.lower() for m in _WORD.findall(text)}


def _described(tag: str, attributes: str) -> tuple[str, set[str]]:
    """Generalised name of a tag, and the words that tell what it is."""
    if "=" not in attributes or not _TELLING.search(attributes):
        return tag, set()
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    classes = found.get("class", "")
    words = _words(classes) | _words(found.get("role", ""))
    own = found.get("id", "")
    # Ids of headings and text blocks are made from their text.
    if own and tag not in TEXT_BLOCKS and (tag != "section" or own.lower() in LAYOUT_WORDS | STRANGE_WORDS):
        words |= _words(own)
    general = sorted({_DIGITS.sub("#", c.lower()) for c in classes.split()})
    return ".".join([tag, *general]), words


class _Reader:
    def __init__(self):
        self.page = Page()
        self.stack: list[int] = []
        self.count: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.in_links = 0
        self.link = False
        self.aside: list[str] = []  # open inline elements that are no text of the article

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.begin_body()
                page = self.page
                page.owner.append(self.stack[-1])
                page.text.append(text)
                page.linked.append(self.in_links)
            self.pieces.clear()
        self.in_links = 0
        self.aside.clear()

    def begin_body(self) -> None:
        """All that is shown lies in a body, also where the page doesn't say so."""
        if not self.count["html"]:
            self.push("html", "html", set())
        if not self.count["body"] and not self.count["head"]:
            self.push("body", "body", set())

    def add(self, text: str) -> None:
        if self.aside or not text:
            return
        if "&" in text:
            text = unescape(text)
        self.pieces.append(text)
        if self.link:
            self.in_links += len(text.strip())

    def push(self, tag: str, name: str, words: set[str]) -> None:
        page = self.page
        page.parent.append(self.stack[-1] if self.stack else -1)
        page.tag.append(tag)
        page.name.append(name)
        page.words.append(words)
        self.stack.append(len(page.tag) - 1)
        self.count[tag] += 1

    def pop_to(self, at: int) -> None:
        """Close the open elements from place ``at`` of the stack on."""
        self.flush()
        self.link = False
        for element in self.stack[at:]:
            self.count[self.page.tag[element]] -= 1
        del self.stack[at:]

    def close(self, tags: set[str], barrier: set[str]) -> None:
        """Close the innermost open element of ``tags`` unless it lies beyond a barrier."""
        if not any(self.count[t] for t in tags):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.page.tag[self.stack[at]]
            if tag in tags:
                return self.pop_to(at)
            if tag in barrier:
                return None

    def open(self, tag: str, attributes: str) -> None:
        if tag not in BLOCKS and "-" not in tag:
            return self.open_inline(tag, attributes)
        if tag in CELLS:
            # Cells are set apart by a space, not by a new block.
            if self.count["p"]:
                self.close({"p"}, _SCOPES)
            self.pieces.append(" ")
            return None
        self.flush()
        if tag == "hr":
            return None
        if self.count["p"]:
            self.close({"p"}, _SCOPES)
        if tag in _CLOSED_BY:
            self.close(_CLOSED_BY[tag], _INSIDE.get(tag, BLOCKS))
        if self.count["head"] and tag not in ("html", "head", "noscript", "template"):
            self.close({"head"}, set())
        if tag in ("html", "body"):
            # Their classes often are the page's own.
            if not self.count[tag]:
                self.begin_body() if tag == "body" else self.push(tag, tag, set())
            return None
        if tag == "head":
            if not self.count["html"]:
                self.push("html", "html", set())
        else:
            self.begin_body()
        self.push(tag, *_described(tag, attributes))
        return None

    def open_inline(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
        elif tag == "a":
            self.link = True
        if tag in VOID or attributes.endswith("/"):
            return
        if self.aside:
            if self.aside[0] == tag:
                self.aside.append(tag)
        elif "=" in attributes and _described(tag, attributes)[1] & STRANGE_WORDS:
            self.aside.append(tag)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = False
        if self.aside and self.aside[0] == tag:
            self.aside.pop()
        if tag in CELLS:
            self.pieces.append(" ")
        elif tag in ("html", "body"):
            self.flush()
        elif tag in BLOCKS or "-" in tag:
            if self.count[tag]:
                self.close({tag} if tag not in HEADINGS else HEADINGS, _SCOPES - {tag})
            else:
                self.flush()


def read_page(html: str) -> Page:
    reader = _Reader()
    at = 0
    while True:
        begin = html.find("<", at)
        if begin < 0:
            reader.add(html[at:])
            break
        reader.add(html[at:begin])
        after = html[begin + 1 : begin + 2]
        if after == "!" or after == "?" or html.startswith("</", begin) and not html[begin + 2 : begin + 3].isalpha():
            if html.startswith("<!--", begin):
                # An empty comment may be as short as this.
                short = _EMPTY_COMMENT.match(html, begin)
                end = html.find("-->", begin + 4)
                at = short.end() if short else end + 3 if end >= 0 else len(html)
            else:
                at = html.find(">", begin) + 1 or len(html)
            continue
        found = _TAG.match(html, begin) if after == "/" or after.isascii() and after.isalpha() else None
        if found is None:
            if after == "/" or after.isascii() and after.isalpha():
                break  # a tag that never ends
            reader.add("<")
            at = begin + 1
            continue
        at = found.end()
        tag = found[2].lower()
        if found[1]:
            reader.end(tag)
        elif tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else len(html)
        else:
            reader.open(tag, found[3])
    reader.flush()
    return reader.page
