"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded as a tree.

Every block element of a page gets features (dom.features): its own and its ancestors' kind
and attribute words, depth, sibling statistics, and the density of text, links and
punctuation in its subtree. Boosted trees (histogram splits, logistic loss) give the log odds
that the element belongs to the article.

No page is labelled, so the trees learn from weak labels of a sample of at most SAMPLE of the pages
that hold an article or main element (the smallest hashes of url and id): text inside it counts as
article, unless an element between says otherwise by its kind or attribute words. Only where no
page of the table has such an element the sample is taken from all pages, and the article is the
element whose attribute words say so, or else the one with the most paragraph text outside links. Each sampled page is used again in
VARIANTS altered forms, with telling elements renamed to plain ones, attribute words taken
away, and blocks of other kinds (menus, notices, comments, forms) put in or around the
article, so that density, position and siblings have to tell as well.

Decoding: an element outside the article has no element of the article inside. Of all such
labellings the one with the greatest sum of log odds, weighted by own text, is found by one
pass up and one down the tree, so ancestors and descendants never contradict each other.

Defined cases: null html is empty; a page without kept text gives an empty string; repeated
rows are answered one by one; broken markup is read as far as it goes; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import common as c
from orderlens.llm import dom

SAMPLE = 300
VARIANTS = 4
TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 32
# fixed values: attribute words of elements that hold the article
_AREA_WORDS = {"article", "content", "main", "post", "entry", "story", "hentry"}
_OTHER_TAGS = {"nav", "menu", "header", "footer", "aside", "form", "fieldset", "dialog"}


# --- boosted trees ---------------------------------------------------------------------
class Trees:
    """Boosted regression trees of a fixed depth; each is arrays of splits and leaf values."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.base = float(np.log((weight @ y + 1) / (weight @ (1 - y) + 1)))
        cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
        binned = np.column_stack([np.searchsorted(q, col, "left") for q, col in zip(cuts, x.T, strict=True)])
        score, self.trees = np.full(len(y), self.base), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, values = self._grow(binned, cuts, weight * (y - p), weight * p * (1 - p))
            self.trees.append(tree)
            score += values

    def _grow(self, binned, cuts, grad, hess):
        feature = np.zeros(2 ** DEPTH - 1, int)
        cut = np.full(2 ** DEPTH - 1, np.inf, np.float32)
        at = np.zeros(len(grad), int)  # node of each row
        for level in range(DEPTH):
            for node in range(2 ** level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                best = (1e-6, 0, 0)
                for f, q in enumerate(cuts):
                    if not len(q) or len(rows) < 2:
                        continue
                    g = np.cumsum(np.bincount(binned[rows, f], grad[rows], len(q) + 1))
                    h = np.cumsum(np.bincount(binned[rows, f], hess[rows], len(q) + 1))
                    gain = (g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
                            - g[-1] ** 2 / (h[-1] + 1))
                    if gain.max() > best[0]:
                        best = (gain.max(), f, int(gain.argmax()))
                right = np.zeros(len(rows), bool)
                if best[0] > 1e-6:
                    feature[node], cut[node] = best[1], cuts[best[1]][best[2]]
                    right = binned[rows, best[1]] > best[2]
                at[rows] = 2 * node + 1 + right
        leaf = at - (2 ** DEPTH - 1)
        value = RATE * np.bincount(leaf, grad, 2 ** DEPTH) / (np.bincount(leaf, hess, 2 ** DEPTH) + 1)
        return (feature, cut, value), value[leaf]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - (2 ** DEPTH - 1)]
        return out


# --- weak labels and altered pages -----------------------------------------------------
def _other(v: dom.Node) -> bool:
    return v.tag in _OTHER_TAGS or bool(v.tokens & dom.OTHER_WORDS)


def areas(nodes: list[dom.Node]) -> list[dom.Node]:
    """The elements that hold the article by their kind, else by their attribute words, else by
    the paragraphs right inside them (text less links); none on a page without text."""
    if by_tag := [v for v in nodes if v.tag in ("article", "main")]:
        return by_tag
    if by_word := [v for v in nodes[1:] if v.tokens & _AREA_WORDS and not _other(v) and v.children]:
        return by_word
    best, most = None, 0
    clean = {id(nodes[0]): True}
    for v in nodes:
        clean[id(v)] = not _other(v) and (v.parent is None or clean[id(v.parent)])
        size = sum(sum(len(t) for _, t in w.runs) - w.links for w in v.children if w.tag == "p")
        if clean[id(v)] and size > most:
            best, most = v, size
    return [best] if best is not None else []


def weak_labels(nodes: list[dom.Node]) -> np.ndarray | None:
    """Share of each element's text that counts as article; None if nothing tells."""
    found = {id(v) for v in areas(nodes)}
    if not found:
        return None
    inside, place = np.zeros(len(nodes)), {id(v): i for i, v in enumerate(nodes)}
    good, size = np.zeros(len(nodes)), np.zeros(len(nodes))
    for i, v in enumerate(nodes):
        above = inside[place[id(v.parent)]] if v.parent else 0
        inside[i] = 0 if _other(v) else 1 if id(v) in found else above
        size[i] = sum(len(t) for _, t in v.runs)
        good[i] = size[i] * inside[i]
    for i in range(len(nodes) - 1, 0, -1):
        j = place[id(nodes[i].parent)]
        good[j] += good[i]
        size[j] += size[i]
    return np.where(size > 0, good / np.maximum(size, 1), inside)


def _altered(page: str, rng: np.random.Generator) -> tuple[list[dom.Node], np.ndarray]:
    """A page with weak labels, with its telling elements renamed and other blocks put in."""
    nodes = dom.parse(page)
    label = {id(v): g for v, g in zip(nodes, weak_labels(nodes), strict=True)}
    texts = [t for v in nodes for _, t in v.runs] or [""]
    hosts = areas(nodes)
    kinds = [("nav", "menu"), ("aside", "sidebar"), ("div", "comments"), ("div", "cookie"), ("form", "newsletter"),
             ("header", "header"), ("footer", "footer"), ("div", "ad"), ("div", "related")]
    for tag, word in [kinds[k] for k in rng.integers(0, len(kinds), 3)]:
        host = hosts[rng.integers(len(hosts))]
        if rng.random() < 0.7 and host.parent:
            host = host.parent
        box = dom.Node(tag, frozenset({word} if rng.random() < 0.8 else ()), host)
        for _ in range(rng.integers(1, 7)):
            words = texts[rng.integers(len(texts))].split(" ")
            n = int(rng.integers(1, 40 if word in ("comments", "sidebar", "related") else 12))
            child = dom.Node("li" if tag == "nav" else "p", frozenset(), box)
            child.runs = [(0, " ".join(words[:n]))]
            child.links = len(child.runs[0][1]) if tag == "nav" or rng.random() < 0.2 else 0
    order: list[dom.Node] = []
    todo = [(nodes[0], 1.0)]
    while todo:
        v, above = todo.pop()
        order.append(v)
        label.setdefault(id(v), 0.0)
        if rng.random() < 0.5 and v.tag in ("article", "main", "section"):
            v.tag, v.tokens = "div", frozenset({"content", "post", "entry", "story"} if rng.random() < 0.5 else ())
        elif rng.random() < 0.5 and v.tag in _OTHER_TAGS:
            v.tokens = frozenset(v.tokens | {v.tag}) if rng.random() < 0.7 else frozenset()
            v.tag = "div"
        for i, w in enumerate(v.children):
            w.index, w.depth = i, v.depth + 1
        todo.extend((w, above) for w in reversed(v.children))
    return order, np.array([label[id(v)] for v in order])


def train(pages: DataFrame) -> Trees | None:
    """Trees from the weak labels of at most SAMPLE pages; None if the table has no text to learn from."""
    pages = pages.select("url", "page_id", "html")
    telling = pages.filter(F.col("html").rlike(r"(?i)<(article|main)[\s/>]"))
    some = c.smallest_hashes(pages if telling.isEmpty() else telling, SAMPLE, "url", "page_id")
    rows = some.select("html", F.xxhash64("url", "page_id").alias("_k"))
    x, y = [], []
    for r in rows.toLocalIterator():
        rng = np.random.default_rng(r["_k"] & 0xFFFFFFFF)
        nodes = dom.parse(r["html"])
        share = weak_labels(nodes)
        if share is None:
            continue
        variants = [(nodes, share), *(_altered(r["html"], rng) for _ in range(VARIANTS))]
        for order, s in variants:
            x.append(dom.features(order))
            y.append(s)
    if not x:
        return None
    x, y = np.concatenate(x), np.concatenate(y)
    return Trees(x, (y >= 0.5).astype(float), 0.05 + np.abs(2 * y - 1))


# --- decoding --------------------------------------------------------------------------
def decode(nodes: list[dom.Node], odds: np.ndarray) -> np.ndarray:
    """The best consistent labelling: whether each element is of the article."""
    place = {id(v): i for i, v in enumerate(nodes)}
    gain = np.array([(0.2 + np.log1p(sum(len(t) for _, t in v.runs))) for v in nodes]) * odds
    inside, outside = gain.copy(), -gain
    for i in range(len(nodes) - 1, 0, -1):
        j = place[id(nodes[i].parent)]
        inside[j] += max(inside[i], outside[i])
        outside[j] += outside[i]
    keep = np.zeros(len(nodes), bool)
    keep[0] = True
    for i in range(1, len(nodes)):
        keep[i] = keep[place[id(nodes[i].parent)]] and inside[i] > outside[i]
    return keep


def main_text(nodes: list[dom.Node], keep: np.ndarray) -> str:
    runs = sorted(r for v, k in zip(nodes, keep, strict=True) if k for r in v.runs)
    return "\n\n".join(t for _, t in runs)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of pages."""
    c.for_workers(pages.sparkSession)
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    model = pages.sparkSession.sparkContext.broadcast(train(pages))

    def run(batches):
        trees = model.value
        for batch in batches:
            html = batch.column("html").to_pylist()
            out: list[str] = []
            for at in range(0, len(html), 64):
                parsed = [dom.parse(h) for h in html[at:at + 64]]
                if trees is None:  # nothing to learn from: all text
                    out += [main_text(n, np.ones(len(n), bool)) for n in parsed]
                    continue
                odds = trees.predict(np.concatenate([dom.features(n) for n in parsed]))
                ends = np.cumsum([len(n) for n in parsed])
                out += [main_text(n, decode(n, o)) for n, o in
                        zip(parsed, np.split(odds, ends[:-1]), strict=True)]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()),
                                   pa.array([len(t) for t in out], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
