"""A forgiving reader of HTML, linear in the page: block elements as a tree, inline markup dissolved into text."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

#: Fixed sets of HTML element names.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = HEADINGS | {
    "address", "article", "aside", "blockquote", "details", "dialog", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form",
    "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
#: Elements that hint at what stands around an article.
AROUND = {"nav", "header", "footer", "aside", "form", "button", "select", "template", "svg", "canvas", "dialog", "head", "menu", "object"}
#: Last words of a class, id or role that hint at it, whatever stands before but has, no, with or without.
AROUND_LAST = {
    "nav", "navbar", "navigation", "menu", "footer", "sidebar", "aside", "breadcrumb", "breadcrumbs", "pagination", "pager", "comment", "comments", "disqus",
    "newsletter", "advert", "adverts", "advertisement", "advertisements", "siteheader", "pageheader", "sitefooter", "pagefooter", "masthead", "contentinfo", "complementary",
}
#: Words that hint at it where all other words of the name are plain ones.
AROUND_WORDS = AROUND_LAST | {
    "ad", "ads", "banner", "promo", "sponsor", "sponsored", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay",
    "subscribe", "subscription", "signup", "share", "sharing", "social", "related", "recommended", "replies", "reply", "respond", "search", "login", "widget",
    "widgets", "copyright", "toolbar", "header", "side",
}
PLAIN_WORDS = {
    "site", "page", "top", "bottom", "main", "global", "left", "right", "inner", "outer", "box", "wrap", "wrapper", "container", "area", "section", "block",
    "list", "bar", "item", "items", "link", "links", "button", "buttons", "panel", "unit", "slot", "form", "posts", "articles", "stories", "user", "media",
}
NOT = {"has", "no", "with", "without"}
DEEPEST = 512  # as in browsers: what is nested deeper stands beside

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_QUOTE = re.compile(r"=\s*([\"'])|>")
_NAMES = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|href)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SPACE = re.compile(r"\s+")
_CLOSE = {tag: re.compile(rf"</{tag}\b[^>]*(?:>|\Z)|\Z", re.I) for tag in RAW}


class Link(str):
    """Text inside a link."""


def hints_around(name: str) -> bool:
    """Whether one class, id or role names what stands around articles: ``site-header``, not ``article-header`` or ``has-sidebar``."""
    words = [w.lower() for w in _WORD.findall(name)]
    words = [w for w in words if not w.isdigit()]
    if not words or not NOT.isdisjoint(words[:-1]):
        return False
    return words[-1] in AROUND_LAST or any(w in AROUND_WORDS for w in words) and all(w in AROUND_WORDS or w in PLAIN_WORDS for w in words)


class Node:
    """A block element: its name, a label of name and classes, whether name or classes hint at what stands around
    articles, whether it is hidden, its content."""

    __slots__ = ("tag", "label", "around", "hidden", "items")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.items = tag, []
        self.label, self.around, self.hidden = tag, tag in AROUND, False
        if attributes and ("=" in attributes or "hidden" in attributes):
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMES.finditer(attributes)}
            self.label = ".".join([tag, *sorted(set(re.findall(r"[a-z][a-z_-]*", found.get("class", "").lower())))])
            self.hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
            if tag not in ("body", "html", "article", "main") and tag not in HEADINGS:
                self.around |= any(hints_around(name) for k in ("class", "id", "role") for name in set(found.get(k, "").split()))


def _odd_tag(html: str, at: int, last: dict[str, int]) -> tuple[int, str] | None:
    """(end, attributes) of a tag at ``at`` that isn't plainly written: a value may hold < and >, a quote may be
    left open. ``last``: the last place of each kind of quote in the page."""
    start = at = _NAME.match(html, at).end()
    while m := _QUOTE.search(html, at):
        if not m[1]:
            return m.end(), html[start : m.start()]
        quote = m.end()
        if quote > last[m[1]]:
            at = quote  # never closed
            continue
        close = html.index(m[1], quote)
        up, down = html.find(">", quote, close), html.find("<", quote, close)
        if 0 <= up < down:  # the quote ends in another tag: it was left open here
            return up + 1, html[start:up]
        at = close + 1
    return None


def parse(html: str) -> Node:
    """The tree of a page; what is not closed ends with its parent. Scripts, styles and other raw elements are left out."""
    root = Node("#root")
    stack, is_open = [root], Counter()
    last = {'"': html.rfind('"'), "'": html.rfind("'")}
    link = 0  # depth of the stack at which a link was opened
    at, n = 0, len(html)

    def text(piece: str) -> None:
        if piece:
            piece = unescape(piece) if "&" in piece else piece
            stack[-1].items.append(Link(piece) if link else piece)

    def close_from(i: int) -> None:
        nonlocal link
        for node in stack[i:]:
            is_open[node.tag] -= 1
        del stack[i:]
        if len(stack) < link:
            link = 0

    while at < n:
        up = html.find("<", at)
        if up < 0:
            text(html[at:])
            break
        text(html[at:up])
        at = up
        m = _TAG.match(html, at)
        if m:
            closing, tag, attributes = m[1], m[2].lower(), m[3]
            at = m.end()
        elif name := _NAME.match(html, at):
            closing, tag = name[1], name[2].lower()
            found = _odd_tag(html, at, last)
            at, attributes = found or (n, "")
            if found is None:
                break  # the page ends within a tag
        elif html.startswith("<!--", at):
            end = html.find("-->", at)
            at = n if end < 0 else end + 3
            continue
        elif html[at + 1 : at + 2] in ("!", "?", "/"):
            end = html.find(">", at)
            at = n if end < 0 else end + 1
            continue
        else:
            text("<")
            at += 1
            continue
        if closing:
            if tag == "a":
                link = 0
            elif tag not in INLINE and is_open[tag]:
                if tag == "p" and stack[-1].tag != "p":  # </p> doesn't end other blocks
                    continue
                close_from(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag in RAW:
            at = _CLOSE[tag].search(html, at).end()
        elif tag == "a":
            link = len(stack) if "href" in attributes.lower() else 0
        elif tag == "br":
            text(" ")
        elif tag in INLINE or tag in VOID and tag != "hr":
            continue
        else:
            if tag in CLOSES_P and stack[-1].tag == "p":
                close_from(len(stack) - 1)
            if tag in SAME and any(is_open[t] for t in SAME[tag]):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in SAME[tag]:
                        close_from(i)
                        break
                    if stack[i].tag in LIMITS[tag]:
                        break
            if len(stack) > DEEPEST:
                close_from(len(stack) - 1)
            node = Node(tag, attributes)
            stack[-1].items.append(node)
            if tag != "hr" and not attributes.endswith("/"):
                stack.append(node)
                is_open[tag] += 1
    return root


def blocks(node: Node, left_out: set[int] = frozenset()) -> list[str]:
    """Texts of the blocks below a node in page order, without elements whose id() is in ``left_out``."""
    out: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        if buffer and (text := _SPACE.sub(" ", "".join(buffer)).strip()):
            out.append(text)
        buffer.clear()

    todo = [iter(node.items)]
    while todo:
        item = next(todo[-1], None)
        if item is None:
            todo.pop()
            flush()
        elif isinstance(item, str):
            buffer.append(item)
        else:
            flush()
            if not item.hidden and id(item) not in left_out:
                todo.append(iter(item.items))
    flush()
    return out
