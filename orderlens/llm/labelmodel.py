"""Quality classifier: a label model over heuristic labellers and a hashed linear scorer.

Twelve heuristic labellers look at a text's statistics and vote good, bad or nothing.
They overlap and err, and no true label is known: expectation-maximisation estimates each
labeller's accuracy together with the posterior of each text. Texts with equal votes share a
posterior, so Spark only counts the vote patterns (at most 3^12 of them, whatever the corpus)
and the estimation runs on the counts of all documents.

The posteriors train a linear scorer (logistic loss, AdaGrad) on hashed features: words,
word shapes, and the binned statistics. It is fitted on at most FIT_ROWS documents, the
smallest hashes of doc_id and text; counts, posteriors and scores cover all documents.

Defined cases: null text is empty and gets a posterior and a score like any other; repeated
rows are answered one by one; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import common as c, quality_rules

BUCKETS = 1 << 18
FIT_ROWS = 4_000
EPOCHS = 4
KEEP_FROM = 0.5
_U = np.uint64

_CLASS = np.zeros(256, np.uint8)  # byte class of a word shape: lower, upper, digit, others as they are
for _b in range(256):
    _ch = chr(_b)
    _CLASS[_b] = 1 if _b >= 128 or "a" <= _ch <= "z" else 2 if "A" <= _ch <= "Z" else 3 if _ch.isdigit() else _b
MEASURES = ("words", "word characters", "symbols per character", "letters per word byte", "repeated words",
            "distinct words", "repeated lines", "capitals per letter", "exclamations per word", "bars per word",
            "words without letters", "sentence ends per word", "characters per word")
LABELLERS = 12


def measures(text: bytes) -> np.ndarray:
    """The labellers' statistics of a UTF-8 text (MEASURES)."""
    n, chars, symbols, dup, repeat = quality_rules.statistics(text)
    data = c.as_bytes(text)
    kinds = np.bincount(_CLASS[data], minlength=256)
    letters = int(kinds[1] + kinds[2])
    starts, ends = c.word_spans(data)
    seen = np.concatenate(([0], np.cumsum((_CLASS[data] == 1) | (_CLASS[data] == 2))))
    bare = int((seen[ends] == seen[starts]).sum())
    distinct = len(c.distinct_sorted(c.word_hashes(text)))
    stops = sum(int(kinds[ord(x)]) for x in ".!?")
    m = max(n, 1)
    return np.array([n, chars, symbols / max(chars, 1), letters / max(int((ends - starts).sum()), 1), repeat / m,
                     distinct / m, dup / (text.count(b"\n") + 1), kinds[2] / max(letters, 1), kinds[ord("!")] / m,
                     kinds[ord("|")] / m, bare / m, stops / m, chars / m])


def votes(x: np.ndarray) -> np.ndarray:
    """0 bad, 1 nothing, 2 good for each labeller. The first ten look for one defect each, in
    overlapping pairs, and never vote good; the last two vote good for what reads like prose."""
    n, chars, symbols, letters, repeat, distinct, dup, capitals, shouts, bars, bare, stops, length = x
    bad = [n < 20, chars < 100, symbols > 0.05, letters < 0.85, repeat > 0.3, distinct < 0.2, dup > 0.3,
           capitals > 0.4, shouts > 0.3, bars > 0.15]
    prose = symbols < 0.02 and capitals < 0.25 and repeat < 0.2 and bars < 0.02 and n >= 20
    return np.array([*(0 if b else 1 for b in bad),
                     0 if bare > 0.15 else 2 if prose and 0.01 <= stops <= 0.4 else 1,
                     0 if length > 15 else 2 if prose and letters > 0.9 and distinct > 0.25 else 1])


def pattern(v: np.ndarray) -> np.ndarray:
    return (v * 3 ** np.arange(LABELLERS)).sum(-1)


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> np.ndarray:
    """Posterior of good for each vote pattern, by expectation-maximisation.

    A labeller that votes is right with its own accuracy (at first 0.8, smoothed by ten votes
    of which eight are right); one that abstains says nothing.
    """
    v = patterns[:, None] // 3 ** np.arange(LABELLERS) % 3 - 1
    accuracy, prior = np.full(LABELLERS, 0.8), 0.8
    post = np.zeros(len(patterns))
    for _ in range(steps):
        odds = np.log(accuracy) - np.log1p(-accuracy)
        new = 1 / (1 + np.exp(-np.clip(np.log(prior) - np.log1p(-prior) + v @ odds, -500, 500)))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
        prior = (counts @ post + 4) / (counts.sum() + 5)
        right = counts @ np.where(v > 0, post[:, None], np.where(v < 0, 1 - post[:, None], 0))
        accuracy = (right + 8) / (counts @ (v != 0) + 10)
    return post


_SCALE = np.array([0.05, 0.01, 20, 4, 20, 4, 20, 10, 20, 20, 20, 20, 1])


def features(text: bytes, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of a text and their weights: relative word and shape counts,
    and one feature for each binned statistic."""
    data = c.as_bytes(text)
    starts, ends = c.word_spans(data)
    words = c.span_hashes(c._LOWER[data], starts, ends)
    kinds = _CLASS[data]
    keep = np.ones(len(kinds), bool)
    keep[1:] = kinds[1:] != kinds[:-1]  # runs of one class count once
    place = np.concatenate(([0], np.cumsum(keep)))
    shapes = c.mix(c.span_hashes(kinds[keep], place[starts], place[ends]) + _U(1))
    bins = np.clip(np.round(8 * np.log1p(x * _SCALE)), 0, 63).astype(np.uint64)
    stats = c.mix(bins + (np.arange(len(x), dtype=np.uint64) + _U(1)) * _U(1 << 20))
    out, weight = [stats], [np.full(len(stats), 1.0)]
    for group in (words, shapes):
        if len(group):
            one, n = _runs(np.sort(group))
            out.append(one)
            weight.append(np.sqrt(n / len(group)))
    return (np.concatenate(out) % _U(BUCKETS)).astype(np.int64), np.concatenate(weight)


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return h[at], np.diff(np.concatenate((at, [len(h)])))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Weights of the linear scorer; the last is the intercept."""
    w, seen = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            k, v = rows[i]
            miss = target[i] - 1 / (1 + np.exp(-(w[k] @ v + w[-1])))
            for at, g in ((k, miss * v - 1e-6 * w[k]), (np.array([BUCKETS]), np.array([miss]))):
                seen[at] += g * g
                w[at] += 0.2 * g / np.sqrt(seen[at])
    return w


def _measured(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found = [votes(measures(t)) for t in c.text_bytes(batch.column("text"))]
            codes = pattern(np.array(found).reshape(-1, LABELLERS))
            yield pa.record_batch([batch.column("_key"), pa.array(codes, pa.int64())], names=["_key", "pattern"])

    return docs.select("_key", "text").mapInArrow(run, "_key long, pattern long")


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, pattern, posterior, score, kept of each row of docs."""
    docs = c.texts(docs).withColumn("_key", F.xxhash64("doc_id", "text"))
    sc = docs.sparkSession.sparkContext
    counted = c.written(_measured(docs), "votes").groupBy("pattern").agg(F.count("*").alias("n")).toPandas()
    counted = counted.sort_values("pattern")
    codes = counted["pattern"].to_numpy(np.int64)
    post = estimate(codes, counted["n"].to_numpy(float)) if len(codes) else np.zeros(0)
    table = dict(zip(codes.tolist(), post.tolist(), strict=True))

    sample = c.smallest_hashes(docs.select("_key", "text"), FIT_ROWS, "_key")
    rows, target = [], []
    for r in sample.mapInArrow(_featured, "keys array<long>, weights array<double>, pattern long").toLocalIterator():
        rows.append((np.array(r["keys"]), np.array(r["weights"])))
        target.append(table[r["pattern"]])
    model = sc.broadcast((fit(rows, np.array(target)), table))

    def score(batches):
        w, posts = model.value
        for batch in batches:
            got, codes = [], []
            for t in c.text_bytes(batch.column("text")):
                x = measures(t)
                k, v = features(t, x)
                got.append(1 / (1 + np.exp(-np.clip(w[k] @ v + w[-1], -500, 500))))
                codes.append(int(pattern(votes(x))))
            yield pa.record_batch([batch.column("doc_id"), pa.array(codes, pa.int64()),
                                   pa.array([posts[p] for p in codes], pa.float64()),
                                   pa.array(got, pa.float64())], names=["doc_id", "pattern", "posterior", "score"])

    out = docs.select("doc_id", "text").mapInArrow(
        score, "doc_id long, pattern long, posterior double, score double")
    return out.withColumn("kept", F.col("score") >= KEEP_FROM)


def _featured(batches):
    for batch in batches:
        out = []
        for t in c.text_bytes(batch.column("text")):
            x = measures(t)
            out.append((*features(t, x), int(pattern(votes(x)))))
        yield pa.record_batch([c.list_array([o[0] for o in out], pa.int64()),
                               c.list_array([o[1] for o in out], pa.float64()),
                               pa.array([o[2] for o in out], pa.int64())], names=["keys", "weights", "pattern"])
