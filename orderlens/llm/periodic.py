"""Periodic runs of words: stretches that repeat with a period, found by suffix-tree LCE.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that
no neighbouring word extends. It counts with length >= max(min_words, exponent * q).

Per document: words become numbers. Every counted run of length L holds, q words apart, two equal
windows of W = min_words - min_words // exponent words, and such windows cover all of it; so words
outside all windows that occur twice in the document belong to no run and are left out, each gap
as one symbol of its own. On what is left

1. Ukkonen's algorithm builds the suffix tree of the word numbers and of their reversal;
2. an Euler tour of each tree, with a sparse table of minima over string depths, answers the
   longest common extension of any two places in constant time (the depth of their LCA);
3. the longest Lyndon word that starts at each place, for the order of word numbers and for the
   inverse order, comes from the next smaller suffix in the tree's leaf order. Each run has such a
   Lyndon word as its root, so these at most 2n candidates are extended to both sides by LCE.

Everything of a document stays in one task and memory is in proportion to its repeated part;
documents are independent, so there is no shuffle and a lost executor costs its tasks only.

Defined cases: null, empty and blank texts have no words, no runs and an empty collapsed text;
runs may overlap, and a word is dropped if any run holds it after that run's first q words; ties
between runs are ordered by start, then period; a repeated row is answered for each of its rows;
rows without doc_id are answered with a null doc_id; a very long text needs memory for its
repeated part, about 700 bytes a word; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import common as c

MIN_WORDS = 24
EXPONENT = 3
Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # starts, lengths, periods


def suffix_tree(s: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ukkonen's suffix tree of s (numbers >= 0, the last one unique) as (parent, child, edge
    length) rows in the order of (parent, first symbol). Node 0 is the root."""
    n, k = len(s), max(s) + 1
    start, end, link, child_of = [0], [0], [0], {}
    node = edge = length = open_suffixes = 0
    for i, symbol in enumerate(s):
        unlinked = 0
        open_suffixes += 1
        while open_suffixes:
            if not length:
                edge = i
            key = node * k + s[edge]
            child = child_of.get(key)
            if child is None:
                child_of[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                unlinked = node
            else:
                at = start[child]
                span = min(end[child], i + 1) - at
                if length >= span:
                    edge += span
                    length -= span
                    node = child
                    continue
                if s[at + length] == symbol:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                middle = len(start)
                start += (at, i)
                end += (at + length, n)
                link += (0, 0)
                child_of[key] = middle
                child_of[middle * k + symbol] = middle + 1
                start[child] = at + length
                child_of[middle * k + s[at + length]] = child
                if unlinked:
                    link[unlinked] = middle
                unlinked = middle
            open_suffixes -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - open_suffixes + 1
    keys = np.fromiter(child_of.keys(), np.int64, len(child_of))
    order = np.argsort(keys)
    child = np.fromiter(child_of.values(), np.int64, len(child_of))[order]
    return keys[order] // k, child, (np.array(end) - np.array(start))[child]


class Extensions:
    """Longest common extensions of the suffixes of s, and the suffixes in both orders."""

    def __init__(self, s: np.ndarray) -> None:
        self.n = n = len(s)
        # the end is a symbol of its own, smaller than all others
        parent, child, size = suffix_tree([*(s + 1).tolist(), 0])
        nodes = len(child) + 1
        first = np.searchsorted(parent, np.arange(nodes + 1)).tolist()
        kids, sizes = child.tolist(), size.tolist()
        depth, tour, place, leaves = [0] * nodes, [], [0] * (n + 1), []
        stack = [0]
        while stack:
            x = stack.pop()
            if x < 0:  # back at a node after one of its children
                tour.append(~x)
                continue
            d = depth[x]
            a, b = first[x], first[x + 1]
            if a == b:
                place[n + 1 - d] = len(tour)
                leaves.append(n + 1 - d)
            tour.append(d)
            for j in range(b - 1, a - 1, -1):
                depth[kids[j]] = d + sizes[j]
                stack += (~d, kids[j])
        self.place, self.leaves = np.array(place), leaves
        self._children = first, kids, depth
        low = [np.array(tour, np.int32)]
        while 2 << (len(low) - 1) <= len(tour):  # low[j][i]: least depth of tour[i:i + 2**j]
            half = 1 << (len(low) - 1)
            low.append(np.minimum(low[-1][:-half], low[-1][half:]))
        self.low = low

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at i and j (different places) have in common."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b) + 1
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for x in np.unique(level).tolist():
            at = level == x
            out[at] = np.minimum(self.low[x][a[at]], self.low[x][b[at] - (1 << x)])
        return out

    def inverse_leaves(self) -> list[int]:
        """The suffixes in the order of inverted symbols; the end is smaller than all symbols."""
        first, kids, depth = self._children
        out, stack = [], [0]
        end = self.n + 1
        while stack:
            x = stack.pop()
            a, b = first[x], first[x + 1]
            if a == b:
                out.append(end - depth[x])
                continue
            # children come off the stack largest symbol first; a leaf one symbol down is the end,
            # the first child of its node, and comes before all
            stack += kids[a:b]
            if first[kids[a]] == first[kids[a] + 1] and depth[kids[a]] == depth[x] + 1:
                stack.append(stack.pop(a - b))
        return out


def next_smaller(leaves: list[int], n: int) -> np.ndarray:
    """For each place the next one whose suffix is smaller, n if there is none."""
    rank = [0] * (n + 1)
    for r, i in enumerate(leaves):
        rank[i] = r
    out, stack = [n] * n, []
    for i in range(n):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out)


def maximal_runs(s: np.ndarray, min_words: int, exponent: int) -> Runs:
    """All runs of s with length >= max(min_words, exponent * period), by start, then period."""
    n = len(s)
    forward = Extensions(s)
    place = np.arange(n)
    ends = [next_smaller(leaves, n) for leaves in (forward.leaves, forward.inverse_leaves())]
    i = np.concatenate([place, place])
    j = np.concatenate(ends)
    found = np.unique(i * (n + 1) + j)
    i, j = found // (n + 1), found % (n + 1)
    period = j - i
    some = exponent * period <= n
    i, j, period = i[some], j[some], period[some]
    right = np.zeros(len(i), np.int64)
    inside = j < n
    right[inside] = forward.lce(i[inside], j[inside])
    del forward
    backward = Extensions(s[::-1].copy())
    left = np.zeros(len(i), np.int64)
    inside = i > 0
    left[inside] = backward.lce(n - i[inside], n - j[inside])
    start, length = i - left, period + left + right
    some = length >= np.maximum(min_words, exponent * period)
    rows = np.unique(np.stack([start[some], period[some], length[some]], 1), axis=0)
    return rows[:, 0], rows[:, 2], rows[:, 1]


_NONE = (np.zeros(0, np.int64),) * 3


def runs_of(numbers: np.ndarray, min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> Runs:
    """The runs of a document's word numbers; see the module's text."""
    n, width = len(numbers), min_words - min_words // exponent
    if n < min_words:
        return _NONE
    h = c.window_hashes(c.mix(numbers.astype(np.uint64) + np.uint64(1)), width)
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order][1:] == h[order][:-1])
    if not len(same):
        return _NONE
    twice = np.zeros(n + 1, np.int64)
    at = np.unique(np.concatenate([order[same], order[same + 1]]))
    np.add.at(twice, at, 1)
    np.add.at(twice, at + width, -1)
    covered = np.cumsum(twice[:n]) > 0
    # each gap between covered stretches becomes one symbol that occurs nowhere else
    keep = covered.copy()
    keep[1:] |= ~covered[1:] & covered[:-1]
    at = np.flatnonzero(keep)
    s = numbers[at].copy()
    gaps = ~covered[at]
    _, s = np.unique(s, return_inverse=True)
    s[gaps] = s.max() + 1 + np.arange(gaps.sum())
    start, length, period = maximal_runs(s.astype(np.int64), min_words, exponent)
    return at[start], length, period


def collapsed(n: int, runs: Runs) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    drop = np.zeros(n + 1, np.int64)
    start, length, period = runs
    np.add.at(drop, start + period, 1)
    np.add.at(drop, start + length, -1)
    return np.cumsum(drop[:n]) == 0


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the period that the number of the document plants in every tenth."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[:n - a]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, exponent: int = EXPONENT,
                  rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period) and the collapsed text
    (words joined by one space) of each row of docs. ``rewrite`` may change a document's words."""

    def run(batches):
        for batch in batches:
            ids, text = c.columns(batch, "doc_id", "text")
            n_words, offsets, parts, out = [], [0], [], []
            for doc_id, t in zip(ids.to_pylist(), c.text_bytes(text), strict=True):
                words = t.split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                known: dict[bytes, int] = {}
                numbers = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
                runs = runs_of(numbers, min_words, exponent)
                if len(runs[0]):
                    words = [w for w, stays in zip(words, collapsed(len(words), runs).tolist(), strict=True) if stays]
                    parts.append(runs)
                n_words.append(len(numbers))
                offsets.append(offsets[-1] + len(runs[0]))
                out.append(b" ".join(words))
            fields = [pa.array(np.concatenate([p[x] for p in parts]) if parts else [], pa.int64()) for x in range(3)]
            found = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                             pa.StructArray.from_arrays(fields, fields=list(_RUN)))
            yield pa.record_batch([ids, pa.array(n_words, pa.int64()), found,
                                   pa.array(out, pa.binary()).view(pa.string())],
                                  names=["doc_id", "n_words", "runs", "collapsed"])

    return c.texts(docs).mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """Count, the run of the greatest exact exponent, and digests of the rows of periodic_runs."""
    def greater(a, b):  # exact: lengths over periods by cross products
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    best = F.get(F.array_sort("runs", greater), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{x}").alias(x) for x in _RUN.names],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words"))
