"""A small tolerant reader of HTML: block elements, their text runs and their features."""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np

# The tokenizer states of the HTML standard: a quote opens a value only right after "=", an unquoted
# value goes on to white space or ">", and what is not closed goes on to the end of the page. No
# part of a tag is read twice (possessive repeats).
_WS = r"[ \t\n\f\r]"
_NAME = r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+"
_VALUE = r"""(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^ \t\n\f\r"'>][^ \t\n\f\r>]*+)"""
_TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|/[^a-zA-Z][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^ \t\n\f\r/>]*+)"
    rf"((?:[ \t\n\f\r/]++|{_NAME}(?:{_WS}*+={_WS}*+{_VALUE}?+)?+)*+)(?:>|\Z))", re.S)
_ATTR = re.compile(rf"({_NAME})(?:{_WS}*+={_WS}*+({_VALUE})?+)?+")
_NAMES = {"class", "id", "role"}
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
# fixed values: element classes of the HTML standard
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "select", "button"}
# a RAW element ends at its own closing tag, whatever its text looks like before
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
# fixed values: kinds of elements and words of class, id and role by what they usually hold
KINDS = [{"article", "main"}, {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "dialog"},
         {"section", "div", "body", "html"}, {"p", "blockquote", "pre"}, {"h1", "h2", "h3", "h4", "h5", "h6"},
         {"ul", "ol", "li", "dl", "dt", "dd"}, {"table", "tr", "td", "th", "tbody", "thead"}]
MAIN_WORDS = {"article", "content", "main", "post", "entry", "story", "body", "text", "page", "hentry"}
OTHER_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "nav",
               "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "side", "widget", "aside",
               "footer", "foot", "header", "masthead", "topbar", "cookie", "cookies", "consent", "notice", "gdpr",
               "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "form", "search", "share",
               "social", "related", "recommended", "tags", "comment", "comments", "reply", "replies", "discussion",
               "disqus", "copyright", "legal", "pagination", "pager", "complementary", "contentinfo", "alert"}


class Node:
    __slots__ = ("tag", "tokens", "parent", "children", "runs", "links", "begin", "end", "depth", "index")

    def __init__(self, tag: str, tokens: frozenset, parent: "Node | None") -> None:
        self.tag, self.tokens, self.parent = tag, tokens, parent
        self.children: list[Node] = []
        self.runs: list[tuple[int, str]] = []  # (place in the page, text) of the block's own text
        self.links = 0  # characters inside links
        self.depth = parent.depth + 1 if parent else 0
        self.index = len(parent.children) if parent else 0
        if parent:
            parent.children.append(self)


def parse(page: str) -> list[Node]:
    """The block elements of a page in page order; the first is the root."""
    root = Node("html", frozenset(), None)
    nodes, at, link = [root], root, 0
    inline: list[str] = []
    place, parts, linked = 0, [], 0

    def flush() -> None:
        nonlocal parts, linked, place
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                at.runs.append((place, text))
                at.links += min(linked, len(text))
                place += 1
            parts, linked = [], 0

    here = 0
    while m := _TAG.search(page, here):
        if m.start() > here:
            parts.append(page[here:m.start()])
            if link:
                linked += m.start() - here
        here = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if not m[1]:
            if tag in RAW:
                if not m[3].rstrip().endswith("/"):
                    close = _CLOSE[tag].search(page, here)
                    here = close.end() if close else len(page)
            elif tag == "br" or tag == "img":
                parts.append(" ")
            elif tag in VOID:
                flush()
            elif tag in INLINE:
                link += tag == "a"
            else:
                flush()
                while at.parent and (at.tag == "p" or at.tag in CLOSES.get(tag, ())):
                    at = at.parent
                tokens = frozenset(x.lower() for a in _ATTR.finditer(m[3]) if a[2] and a[1].lower() in _NAMES
                                   for x in _TOKEN.findall(a[2]))
                at = Node(tag, tokens, at)
                nodes.append(at)
        elif tag in INLINE:
            link = max(0, link - 1) if tag == "a" else link
        else:
            up = at
            while up.parent and up.tag != tag:
                up = up.parent
            if up.parent:
                flush()
                at = up.parent
    parts.append(page[here:])
    flush()
    return nodes


N_FEATURES = 2 * len(KINDS) + 20


def features(nodes: list[Node]) -> np.ndarray:
    """One row for each node: its own and its ancestors' kind and attribute words, depth,
    sibling statistics, and density of its subtree."""
    n = len(nodes)
    place = {id(v): i for i, v in enumerate(nodes)}
    up = np.array([place[id(v.parent)] if v.parent else 0 for v in nodes])
    own = np.array([sum(len(t) for _, t in v.runs) for v in nodes], float)
    words = np.array([sum(t.count(" ") + 1 for _, t in v.runs) for v in nodes], float)
    stops = np.array([sum(t.count(".") + t.count(",") for _, t in v.runs) for v in nodes], float)
    links = np.array([v.links for v in nodes], float)
    size, runs = np.ones(n), np.array([len(v.runs) for v in nodes], float)
    total, total_words, total_stops, total_links = own.copy(), words.copy(), stops.copy(), links.copy()
    for i in range(n - 1, 0, -1):  # children come after their parents
        j = up[i]
        size[j] += size[i]
        runs[j] += runs[i]
        total[j] += total[i]
        total_words[j] += total_words[i]
        total_stops[j] += total_stops[i]
        total_links[j] += total_links[i]
    kind = np.array([[v.tag in k for k in KINDS] for v in nodes], float)
    main = np.array([len(v.tokens & MAIN_WORDS) for v in nodes], float)
    other = np.array([len(v.tokens & OTHER_WORDS) for v in nodes], float)
    above, main_above, other_above = kind.copy(), main.copy(), other.copy()
    for i in range(1, n):
        above[i] = np.maximum(kind[i], above[up[i]])
        main_above[i] = max(main[i], main_above[up[i]])
        other_above[i] = max(other[i], other_above[up[i]])
    siblings = np.array([len(v.parent.children) if v.parent else 1 for v in nodes], float)
    index = np.array([v.index for v in nodes], float)
    depth = np.array([v.depth for v in nodes], float)
    tags = Counter((id(v.parent), v.tag) for v in nodes)  # once per parent
    alike = np.array([tags[id(v.parent), v.tag] for v in nodes], float)
    whole = max(total[0], 1)
    before = np.concatenate(([0], np.cumsum(own)[:-1])) / whole
    share_up = total / np.maximum(total[up], 1)
    cols = [main, other, main_above, other_above, depth, siblings, index / np.maximum(siblings, 1), alike / siblings,
            np.log1p(own), np.log1p(total), total / whole, share_up, before, total / size,
            total_links / np.maximum(total, 1), total_stops / np.maximum(total_words, 1),
            total / np.maximum(runs, 1), total_links[up] / np.maximum(total[up], 1), np.log1p(size),
            total / np.maximum(total_words, 1)]
    return np.column_stack((kind, above, *cols)).astype(np.float32)
