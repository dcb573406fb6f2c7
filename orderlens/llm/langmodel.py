"""Language model of words: code-point n-grams with modified Kneser-Ney smoothing, all in Spark tables.

A word is predicted character by character, and then its end: each symbol from up to ORDER - 1
before it, the space in front of the word included. Characters are taken as they are, so every
script has its own n-grams, and the tables grow with the words that the corpus holds.

Counts are exact and cover every word of every text. A word weighs the number of *other* documents
of its language that hold it (its documents less one): what a document repeats, or alone holds, is
no evidence for that document. N-grams of ORDER symbols, and shorter ones that begin with the space,
are counted by these weights, all others by the different symbols that precede them.

The tables are Spark tables keyed by (tag, n-gram), one per order; an n-gram's probability is found by
joining its order with the one below. While they have at most TABLE n-grams, they are sent to the workers,
which score the words as they read the texts. Beyond that every word of the corpus is scored by joins: words
without weight bring n-grams of count 0 into the tables, so each finds all its n-grams. Both ways give the
same numbers. In both, at most FREQUENT words, those in the most documents, are sent to the workers with
their scores.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderlens.llm import common as c

ORDER = 5
FREQUENT = 1 << 18  # words whose scores are broadcast
FLUSH = 200_000  # words that a task counts before it passes the counts on
TABLE = 1 << 21  # n-grams that are broadcast; with more, words are scored by joins


@lru_cache(1 << 12)
def _salt(lang: str | None) -> np.uint64:
    return np.uint64(0 if lang is None else int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest()))


def keys(hashes: np.ndarray, lang: str | None) -> np.ndarray:
    """The keys (64 bits) of words of a language, from the hashes of their bytes."""
    return c.mix(hashes ^ _salt(lang)).view(np.int64)


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, docs) over all texts: how many rows hold a word; words are bytes."""

    def run(batches):
        tables: dict[str | None, Counter] = {}
        for batch in batches:
            langs, text = c.columns(batch, "lang", "text")
            for lang, t in zip(langs.to_pylist(), c.text_bytes(text), strict=True):
                tables.setdefault(lang, Counter()).update(set(t.split()))
            if sum(map(len, tables.values())) > FLUSH:
                yield from rows(tables)
                tables = {}
        yield from rows(tables)

    def rows(tables):
        for lang, table in tables.items():
            yield pa.record_batch([pa.array([lang] * len(table), pa.string()), pa.array(list(table), pa.binary()),
                                   pa.array(list(table.values()), pa.int64())], names=["lang", "word", "docs"])

    return (docs.mapInArrow(run, "lang string, word binary, docs long")
            .groupBy("lang", "word").agg(F.sum("docs").alias("docs")))


def word_grams(word: str) -> list[str]:
    """For each symbol of a word and its end: the n-gram that ends there."""
    t = f" {word} "
    return [t[max(0, k - ORDER):k] for k in range(2, len(t) + 1)]


def _tag(lang: str | None) -> str:
    """The text that stands for a language in the tables: '' for none."""
    return "" if lang is None else f"={lang}"


def _grams(words: DataFrame) -> DataFrame:
    """(tag, gram, n): the n-grams of all words and the words' weights, counted by tasks, then added up by Spark."""

    def run(batches):
        table: Counter = Counter()
        for batch in batches:
            for lang, word, docs in zip(*(x.to_pylist() for x in c.columns(batch, "lang", "word", "docs")), strict=True):
                tag = _tag(lang)
                for gram in word_grams(word.decode("utf-8", "replace")):
                    table[tag, gram] += docs - 1
                if len(table) > FLUSH:
                    yield rows(table)
                    table = Counter()
        yield rows(table)

    def rows(table):
        return pa.record_batch([pa.array([x for x, _ in table], pa.string()), pa.array([x for _, x in table], pa.string()),
                                pa.array(list(table.values()), pa.int64())], names=["tag", "gram", "n"])

    return (words.mapInArrow(run, "tag string, gram string, n long").groupBy("tag", "gram").agg(F.sum("n").alias("n")))


def _occurrences(words: DataFrame) -> DataFrame:
    """(key, tag, gram) for every n-gram of every word."""

    def run(batches):
        for batch in batches:
            for lang, word, key in zip(*(x.to_pylist() for x in c.columns(batch, "lang", "word", "key")), strict=True):
                grams = word_grams(word.decode("utf-8", "replace"))
                yield pa.record_batch([pa.array([key] * len(grams), pa.int64()), pa.array([_tag(lang)] * len(grams)),
                                       pa.array(grams)], names=["key", "tag", "gram"])

    return words.mapInArrow(run, "key long, tag string, gram string")


def _keyed(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            langs, words, docs = c.columns(batch, "lang", "word", "docs")
            got = words.to_pylist()
            ends = np.cumsum([len(w) for w in got], dtype=np.int64)
            starts = ends - [len(w) for w in got] if got else ends
            hashes = c.span_hashes(c.as_bytes(b"".join(got)), starts, ends)
            yield pa.record_batch([langs, words, docs, c.mix(hashes ^ salts(langs.to_pylist())).view(np.int64)],
                                  names=["lang", "word", "docs", "key"])

    return words.mapInArrow(run, "lang string, word binary, docs long, key long")


def discounts(table: DataFrame) -> DataFrame:
    """_tag, d1, d2, d3 (modified Kneser-Ney discounts of counts 1, 2 and 3 or more; the usual
    0.5, 1 and 1.5 where the counts of counts are too thin) and size (n-grams met) of each tag."""
    k = [F.greatest(F.count_if(F.col("n") == i), F.lit(1)) for i in range(1, 5)]
    y = k[0] / (k[0] + 2 * k[1])
    found = []
    for i, (usual, top) in enumerate(((0.5, 1), (1.0, 2), (1.5, 3))):
        d = (i + 1) - (i + 2) * y * k[i + 1] / k[i]
        found.append(F.when((d > 0) & (d < top), d).otherwise(usual).alias(f"d{i + 1}"))
    return table.groupBy(F.col("tag").alias("_tag")).agg(*found, F.count_if(F.col("n") > 0).alias("size"))


def probabilities(grams: DataFrame) -> list[DataFrame]:
    """For orders 1..ORDER (tag, gram, p, back): the probability of an n-gram's last symbol given the
    others, and what the others leave to the order below (of order 1: to a symbol never met)."""
    raw = c.written(grams, "grams")
    tables: list[DataFrame] = []
    for order in range(ORDER, 0, -1):
        own = raw.filter(F.length("gram") == order)
        if tables:
            own = own.unionByName(tables[0].groupBy("tag", F.expr("substring(gram, 2)").alias("gram"))
                                  .agg(F.count_if(F.col("n") > 0).alias("n")))
        tables.insert(0, c.written(own, "order"))
    out: list[DataFrame] = []
    n, context = F.col("n"), Window.partitionBy("tag", F.expr("left(gram, length(gram) - 1)"))
    cut = F.when(n >= 3, F.col("d3")).when(n == 2, F.col("d2")).when(n == 1, F.col("d1")).otherwise(0.0)
    for table in tables:
        # one row a language; the n-grams of a context are as many as the alphabet at most
        rows = (table.join(F.broadcast(discounts(table)), F.col("tag") == F.col("_tag"))
                .withColumns({"_cut": cut, "total": F.sum("n").over(context)})
                .withColumn("_left", F.sum("_cut").over(context)))
        if out:
            low = out[-1].select(F.col("tag").alias("_low"), F.col("gram").alias("_end"), F.col("p").alias("below"))
            rows = rows.join(low, (F.col("tag") == F.col("_low")) & (F.expr("substring(gram, 2)") == F.col("_end")))
        else:
            rows = rows.withColumn("below", 1 / (F.col("size") + 1))
        p = F.when(F.col("total") > 0, (n - F.col("_cut")) / F.col("total") + F.col("_left") / F.col("total") * F.col("below"))
        back = F.col("_left") / F.col("total") * (F.lit(1.0) if out else F.col("below"))
        out.append(c.written(rows.select("tag", "gram", F.coalesce(p, "below").alias("p"),
                                         F.when(F.col("total") > 0, back).alias("back")), "probabilities"))
    return out


def _gram_keys(tags: list[str], grams: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of n-grams, and of the same without their last symbol."""
    whole = [g.encode() for g in grams]
    ends = np.cumsum([len(g) for g in whole], dtype=np.int64)
    last = np.array([len(g[-1].encode()) for g in grams], np.int64)
    starts = np.append(0, ends[:-1])
    data, salts = c.as_bytes(b"".join(whole)), np.array([_salt(t[1:] if t else None) for t in tags], np.uint64)
    return tuple(c.mix(c.span_hashes(data, starts, e) ^ salts) for e in (ends, ends - last))


class Model:
    """Sorted keys of n-grams and of contexts, with log probabilities and log back-off weights."""

    def __init__(self, tables: list[DataFrame]) -> None:
        parts: list[tuple] = []
        for table in tables:
            got = table.toArrow()
            if got.num_rows:
                parts.append((*_gram_keys(got.column("tag").to_pylist(), got.column("gram").to_pylist()),
                              np.log(got.column("p").to_numpy()), np.log(got.column("back").to_numpy())))
        cols = [np.concatenate(x) for x in zip(*parts, strict=True)] or [np.zeros(0, np.uint64)] * 2 + [np.zeros(0)] * 2
        order = np.argsort(cols[0])
        self.grams, self.logp = cols[0][order], cols[2][order]
        self.contexts, at = np.unique(cols[1], return_index=True)
        self.backs = cols[3][at]

    def score(self, words: list[bytes], salts: np.ndarray) -> np.ndarray:
        """Log probability of the symbols and the end of each word."""
        if not words or not len(self.grams):
            return np.zeros(len(words))
        words = [w.decode("utf-8", "replace").encode() for w in words]
        data = c.as_bytes(b" " + b" ".join(words) + b" ")
        bounds = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where symbols begin
        space = data[bounds[:-1]] == 32
        at = np.arange(1, len(space))  # every symbol but the first space is predicted
        begin = np.maximum.accumulate(np.where(space, np.arange(len(space)), 0))[:-1]  # the space before its word
        word = np.cumsum(space)[:-1] - 1
        out, salt = np.zeros(len(at)), salts[word]
        todo = np.arange(len(at))
        for k in range(ORDER, 0, -1):
            now = todo[at[todo] - begin[todo] + 1 >= k] if k > 1 else todo
            i, own = bounds[at[now] - k + 1], salt[now]
            found, value = _find(self.grams, self.logp, c.mix(c.span_hashes(data, i, bounds[at[now] + 1]) ^ own))
            out[now[found]] += value
            now, i, own = now[~found], i[~found], own[~found]
            seen, value = _find(self.contexts, self.backs, c.mix(c.span_hashes(data, i, bounds[at[now]]) ^ own))
            out[now[seen]] += value
            todo = np.concatenate((now, todo[at[todo] - begin[todo] + 1 < k])) if k > 1 else now
        return np.bincount(word, out, len(words))


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return found, values[at[found]]


def train(docs: DataFrame, table: int = TABLE) -> tuple[Model | None, DataFrame]:
    """The model, if its tables have at most ``table`` n-grams, and (key, docs, logp): the words with
    weight and their scores; without a model, all words of docs."""
    words = c.written(_keyed(count_words(docs)), "words")
    tables = probabilities(_grams(words.filter("docs > 1")))
    if sum(t.count() for t in tables) <= table:
        model = Model(tables)
        known = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches):
            for batch in batches:
                langs, found, n, key = c.columns(batch, "lang", "word", "docs", "key")
                logp = known.value.score(found.to_pylist(), salts(langs.to_pylist()))
                yield pa.record_batch([key, n, pa.array(logp, pa.float64())], names=["key", "docs", "logp"])

        return model, words.filter("docs > 1").mapInArrow(run, "key long, docs long, logp double")
    tables = probabilities(_grams(words))
    p = tables[0]
    for more in tables[1:]:
        p = p.unionByName(more)
    logs = _occurrences(words).join(p, ["tag", "gram"]).groupBy("key").agg(F.sum(F.log("p")).alias("logp"))
    # two words of one key would be one; their sum counts once
    return None, c.written(words.groupBy("key").agg(F.max("docs").alias("docs")).join(logs, "key"), "word_scores")


def salts(langs: list[str | None]) -> np.ndarray:
    return np.array([_salt(x) for x in langs], np.uint64)


def frequent(scores: DataFrame, size: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Keys (ascending) and scores of the words in the most documents, at most ``size`` of them."""
    step = F.floor(8 * F.log("docs")).alias("step")
    least, total = None, 0
    for r in scores.groupBy(step).count().orderBy(F.desc("step")).collect():  # a row for each eighth of e
        total += r["count"]
        if total > size:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0)
    table = scores.filter(step >= least).select("key", "logp").toArrow()
    key = table.column("key").to_numpy()
    order = np.argsort(key)
    return key[order], table.column("logp").to_numpy()[order]


def looked_up(own: np.ndarray, key: np.ndarray, logp: np.ndarray) -> tuple[float, np.ndarray]:
    """The sum of the scores of the words that are in the broadcast table, and which words are not."""
    if not len(key):
        return 0.0, np.ones(len(own), bool)
    at = np.minimum(np.searchsorted(key, own), len(key) - 1)
    hit = key[at] == own
    return float(logp[at[hit]].sum()), ~hit
