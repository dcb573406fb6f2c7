"""Character n-gram language model with modified Kneser-Ney smoothing.

Characters are folded to 32 symbols, so an n-gram is a number of 5*ORDER bits and a language
has at most 32^ORDER of them whatever the corpus size: 2^20 rows, 16 MB of arrays. That is
the bound of what is collected and broadcast per language tag. Counts are exact and cover
every character of every text; Spark adds them up, and the continuation counts of the lower
orders are Spark aggregations of the same rows.

The model of a language is one pair of arrays per order: sorted n-gram hashes (the folded
n-gram is its own collision-free hash) with log probabilities, and sorted context hashes with
log back-off weights, both looked up by binary search.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import common as c

ORDER = 4
FLUSH = 10_000  # texts that a task counts before it passes the counts on
SYMBOLS = 32
SPACE, DIGIT, STOP, SIGN, CAPITAL, LETTER, OTHER = 0, 1, 2, 3, 4, 5, 31


@lru_cache
def _fold_table() -> np.ndarray:
    """Symbol of each code point below 2^16: a to z by base letter, and six classes."""
    table = np.full(1 << 16, OTHER, np.uint8)
    for cp in range(1 << 16):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0].lower() if ch.isalpha() else ""
        if len(base) == 1 and "a" <= base <= "z":
            table[cp] = LETTER + ord(base) - 97
        elif ch.isspace():
            table[cp] = SPACE
        elif ch.isdigit():
            table[cp] = DIGIT
        elif ch in ".,;:'\"()-":
            table[cp] = STOP
        elif not ch.isalpha():
            table[cp] = SIGN
    return table


@lru_cache
def _upper_table() -> np.ndarray:
    return np.array([chr(cp).isupper() for cp in range(1 << 16)])


def fold(text: bytes) -> np.ndarray:
    """The symbols of a text; a capital right after a capital is the symbol CAPITAL."""
    cps = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    cps = np.minimum(cps, 0xFFFF)
    symbols = _fold_table()[cps]
    upper = _upper_table()[cps]
    symbols[1:][upper[1:] & upper[:-1]] = CAPITAL
    return symbols


def ngrams(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each symbol, as a number; a text starts after spaces."""
    padded = np.concatenate((np.zeros(order - 1, np.uint32), symbols.astype(np.uint32)))
    out = np.zeros(len(symbols), np.uint32)
    for j in range(order):
        out = (out << np.uint32(5)) | padded[j:j + len(symbols)]
    return out


def count_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) over all texts: counted by tasks, then added up by Spark."""

    def run(batches):
        tables: dict[str, np.ndarray] = {}
        texts = 0
        for batch in batches:
            langs, text = c.columns(batch, "lang", "text")
            for lang, t in zip(langs.to_pylist(), c.text_bytes(text), strict=True):
                if t:
                    table = tables.setdefault(lang, np.zeros(SYMBOLS ** order, np.int64))
                    grams, n = _counted(ngrams(fold(t), order))
                    table[grams] += n
            texts += batch.num_rows
            if texts >= FLUSH:
                yield from rows(tables)
                tables, texts = {}, 0
        yield from rows(tables)

    def rows(tables):
        for lang, table in tables.items():
            grams = np.flatnonzero(table)
            yield pa.record_batch([pa.array([lang] * len(grams), pa.string()), grams, table[grams]],
                                  names=["lang", "gram", "n"])

    return (docs.mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(grams)
    at = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[at], np.diff(np.concatenate((at, [len(grams)])))


def continuation(counts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) one order lower: n counts the distinct symbols that precede a gram."""
    low = F.col("gram").bitwiseAND(SYMBOLS ** (order - 1) - 1)
    return counts.groupBy("lang", low.alias("gram")).agg(F.count("*").alias("n"))


class Model:
    """logp(grams): log probability of the last symbol of each n-gram given the others."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """tables: for orders 1..N the sorted grams and their (continuation) counts."""
        self.grams, self.probs, self.contexts, self.backs = [], [], [], []
        lower = None
        for order, (grams, n) in enumerate(tables, 1):
            d = self._discounts(n)
            context = grams >> np.uint32(5)
            at = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
            total = np.add.reduceat(n, at)
            cut = d[np.minimum(n, 3)]
            share = np.add.reduceat(cut, at) / total  # mass left for the lower order
            size = np.diff(np.concatenate((at, [len(grams)])))
            below = (np.full(len(grams), 1 / SYMBOLS) if lower is None else
                     np.exp(lower(grams & np.uint32(SYMBOLS ** (order - 1) - 1), order - 1)))
            prob = np.maximum(n - cut, 0) / np.repeat(total, size) + np.repeat(share, size) * below
            self.grams.append(grams)
            self.probs.append(np.log(prob).astype(np.float32))
            self.contexts.append(context[at])
            self.backs.append(np.log(share).astype(np.float32))
            lower = self.logp

    @staticmethod
    def _discounts(n: np.ndarray) -> np.ndarray:
        """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more; where the counts of
        counts are too thin for the estimate, the usual 0.5, 1 and 1.5."""
        k = [max(1, int((n == i).sum())) for i in range(1, 5)]
        y = k[0] / (k[0] + 2 * k[1])
        d = np.array([0, 1 - 2 * y * k[1] / k[0], 2 - 3 * y * k[2] / k[1], 3 - 4 * y * k[3] / k[2]])
        usual = np.array([0, 0.5, 1, 1.5])
        return np.where((d > 0) & (d < [1, 1, 2, 3]) | (usual == 0), d, usual)

    def logp(self, grams: np.ndarray, order: int | None = None) -> np.ndarray:
        order = len(self.grams) if order is None else order
        if order == 0:
            return np.full(len(grams), -np.log(SYMBOLS), np.float32)
        grams = grams.astype(np.uint32)
        keys = self.grams[order - 1]
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        out = self.probs[order - 1][at]
        if (miss := np.flatnonzero(keys[at] != grams)).size:
            rest = grams[miss]
            ctx, contexts = rest >> np.uint32(5), self.contexts[order - 1]
            i = np.minimum(np.searchsorted(contexts, ctx), len(contexts) - 1)
            back = np.where(contexts[i] == ctx, self.backs[order - 1][i], 0)
            out[miss] = back + self.logp(rest & np.uint32(SYMBOLS ** (order - 1) - 1), order - 1)
        return out

    def perplexity(self, text: bytes) -> float | None:
        return float(np.exp(-self.logp(ngrams(fold(text), len(self.grams))).mean())) if text else None


def train(docs: DataFrame, order: int = ORDER) -> dict[str | None, Model]:
    """One model for each language tag, from the text of all its documents."""
    counts = [c.written(count_ngrams(docs, order), "ngrams")]
    for k in range(order, 1, -1):
        counts.insert(0, c.written(continuation(counts[0], k), "continuations"))
    tables: dict[str | None, list] = {}
    for df in counts:
        got = df.toPandas()
        for lang, own in got.groupby("lang", dropna=False, sort=False):
            own = own.sort_values("gram")
            tables.setdefault(None if lang != lang else lang, []).append(
                (own["gram"].to_numpy(np.uint32), own["n"].to_numpy(np.int64)))
    return {lang: Model(t) for lang, t in tables.items()}
