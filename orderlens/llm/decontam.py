"""Benchmark decontamination: n-gram seeds, rarest first, and Smith-Waterman alignment.

Words are lower-cased runs of letters and digits. All NGRAM-word strings of the test items
are looked up in every text; Spark counts in how many documents each of them occurs. Every
n-gram of an item that a document itself holds is a seed of the pair, however common it is or
how many others an edit destroyed. The document is aligned with the item by words around the
places the seeds point to, the rarest first (match +2, other or missing word -1), so edited
and paraphrased copies score too. A stretch is left out only where the item's words that
occur in it could not reach MIN_SCORE or the best score so far. A score is divided by that of
the whole item; from MIN_SCORE on the document holds the item. A copy without any NGRAM words
of the item in a row has no seed.

Items are the stated query set: they are taken in blocks of at most BLOCK_WORDS words, and
one block's n-grams are broadcast at a time. Documents are never joined with each other.

Defined cases: null and empty texts match nothing; items of fewer than MIN_WORDS words are no
evidence and match nothing; repeated rows of a document or an item give one result row; a row
without doc_id keeps a null doc_id; extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderlens.llm import common as c

NGRAM = 3
MIN_WORDS = 5
MIN_SCORE = 0.5
BLOCK_WORDS = 1_000_000
MATCH, OTHER, GAP = 2, -1, 1
_SPLIT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words(text: bytes) -> np.ndarray:
    """Hashes of the lower-cased runs of letters and digits of a UTF-8 text."""
    data = c.as_bytes(text.decode("utf-8", "replace").lower().encode())
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPLIT[data]
    edge = np.diff(inside)
    return c.span_hashes(data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))


class Items:
    """Words of a block of items, and the places of each of their n-grams."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.ids = rows["item_id"].to_numpy()
        self.words = [words((t or "").encode()) for t in rows["text"]]
        grams = [c.window_hashes(w, NGRAM) if len(w) >= MIN_WORDS else w[:0] for w in self.words]
        at = [np.arange(len(g)) for g in grams]
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        flat = np.concatenate([*grams, np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.grams, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))  # gram k is at places first[k]:first[k + 1]
        self.item, self.at = item[order], np.concatenate([*at, np.zeros(0, np.int64)])[order].astype(np.int64)
        self.documents = np.zeros(len(self.grams), np.int64)  # that hold each gram; set once they are counted

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes that are n-grams of items, and which."""
        if not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.grams, hashes), len(self.grams) - 1)
        hit = np.flatnonzero(self.grams[k] == hashes)
        return hit, k[hit]

    def stretches(self, text: np.ndarray, at: np.ndarray, gram: np.ndarray) -> Iterator[tuple[int, list]]:
        """(item, [(bound, a, b)]) of each item with n-grams at these places of a text: the stretches
        in which the item may reach MIN_SCORE and no more than bound, that of the rarest n-gram first."""
        n = self.first[gram + 1] - self.first[gram]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[gram], n)
        item, start, rare = self.item[place], np.repeat(at, n) - self.at[place], np.repeat(self.documents[gram], n)
        order = np.lexsort((start, item))
        item, start, rare = item[order], start[order], rare[order]
        edge = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1], [True]))) if len(item) else []
        for x, y in zip(edge[:-1], edge[1:], strict=True):
            own = self.words[item[x]]
            out = []
            for a, b, least in _windows(start[x:y], rare[x:y], len(own), len(text)):
                bound = MATCH * int(np.isin(own, text[a:b]).sum())
                if bound >= MIN_SCORE * MATCH * len(own):
                    out.append((least, a, b, bound))
            if out:
                yield int(item[x]), [(bound, a, b) for _, a, b, bound in sorted(out)]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end): the best local alignment of the item in the text's words."""
    n = len(text)
    slope = GAP * np.arange(n + 1)
    last = np.zeros(n + 1, np.int64)
    # where the alignment that ends at a cell began, carried along as the cell's lower digits
    origin = np.arange(n + 1)
    best = (0, 0, 0)
    for w in item:
        step = np.where(text == w, MATCH, OTHER)
        diag, up = last[:-1] + step, last[1:] - GAP
        score = np.concatenate(([0], np.maximum(diag, up)))
        begin = np.concatenate(([0], np.where(diag >= up, origin[:-1], origin[1:])))
        fresh = score <= 0
        score[fresh], begin[fresh] = 0, np.arange(n + 1)[fresh]
        # a gap in the item costs GAP a word: running maximum of score + slope
        high = score + slope
        top = np.maximum.accumulate(high)
        source = np.maximum.accumulate(np.where(high == top, np.arange(n + 1), 0))
        last, origin = top - slope, begin[source]
        if (m := int(last.max())) > best[0]:
            end = int(last.argmax())
            best = (m, int(origin[end]), end)
    return best


def _windows(places: np.ndarray, rare: np.ndarray, size: int, n: int) -> list[list[int]]:
    """[a, b, least of rare]: stretches of a text of n words around the item starts (ascending) that
    seeds point to. An alignment from MIN_SCORE on has at most size words that the item has not."""
    out: list[list[int]] = []
    for p, r in zip(places.tolist(), rare.tolist(), strict=True):
        a, b = max(0, p - size), min(n, p + 2 * size)
        if out and a <= out[-1][1]:
            out[-1][1:] = max(out[-1][1], b), min(out[-1][2], r)
        else:
            out.append([a, b, r])
    return out


def _lookup(keyed: DataFrame, items) -> DataFrame:
    """(_key, near, grams): the item n-grams that each document holds, where it holds any, and
    whether it has a stretch in which an item may reach MIN_SCORE."""

    def run(batches):
        known = items.value
        for batch in batches:
            keys, text = c.columns(batch, "_key", "text")
            some, near, grams = [], [], []
            for i, t in enumerate(c.text_bytes(text)):
                w = words(t)
                at, gram = known.find(c.window_hashes(w, NGRAM))
                if len(gram):
                    some.append(i)
                    near.append(next(known.stretches(w, at, gram), None) is not None)
                    grams.append(c.distinct_sorted(gram).astype(np.int64))
            yield pa.record_batch([keys.take(pa.array(some, pa.int64())), pa.array(near, pa.bool_()),
                                   c.list_array(grams, pa.int64())], names=["_key", "near", "grams"])

    return keyed.mapInArrow(run, "_key long, near boolean, grams array<long>")


def _aligned(near: DataFrame, items) -> DataFrame:
    def run(batches):
        known = items.value
        for batch in batches:
            ids, text = c.columns(batch, "doc_id", "text")
            rows = []
            for doc, t in zip(ids.to_pylist(), c.text_bytes(text), strict=True):
                w = words(t)
                at, gram = known.find(c.window_hashes(w, NGRAM))
                for i, stretches in known.stretches(w, at, gram):
                    own = known.words[i]
                    full = MATCH * len(own)
                    best = (0, 0, 0)
                    for bound, a, b in stretches:
                        if bound >= best[0]:
                            score, x, y = align(own, w[a:b])
                            best = max(best, (score, a + x, a + y), key=lambda r: (r[0], -r[1]))
                    if best[0] >= MIN_SCORE * full:
                        rows.append((doc, int(known.ids[i]), best[0] / full, best[1], best[2]))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(x, k) for x, k in zip(cols, kinds, strict=True)],
                                  names=["doc_id", "item_id", "score", "first_word", "end_word"])

    return near.mapInArrow(run, "doc_id long, item_id long, score double, first_word long, end_word long")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, first_word, end_word of each document that holds an item."""
    spark = docs.sparkSession
    keyed = c.texts(docs).select(F.xxhash64("doc_id", "text").alias("_key"), "doc_id", "text")
    bench = benchmark.select("item_id", "text").filter("item_id is not null").distinct()
    size = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    # blocks by the running number of words, from a sum per 1,024 hash groups of items
    group = F.pmod(F.xxhash64("item_id"), F.lit(1024))
    sums = bench.groupBy(group.alias("g")).agg(F.sum(size).alias("n"))
    run_sum = F.sum("n").over(Window.orderBy("g"))
    blocks = {r["g"]: int((r["s"] - 1) // BLOCK_WORDS) for r in sums.select("g", run_sum.alias("s")).collect()}
    out = None
    for block in sorted(set(blocks.values())):
        groups = [g for g, b in blocks.items() if b == block]
        known = Items(bench.filter(group.isin(groups)).toPandas())
        held = c.written(_lookup(keyed, spark.sparkContext.broadcast(known)), "held")
        counts = held.select(F.explode("grams").alias("gram")).groupBy("gram").count().toPandas()
        known.documents[counts["gram"].to_numpy(np.int64)] = counts["count"]
        near = held.filter("near").select("_key").distinct()
        near = c.only_ids(keyed, c.cut(near), "_key").dropDuplicates(["_key"])
        found = _aligned(near, spark.sparkContext.broadcast(known))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, score double, first_word long, end_word long")
    return out.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"), F.max_by("first_word", "score").alias("first_word"),
        F.max_by("end_word", "score").alias("end_word"))
