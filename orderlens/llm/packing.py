"""Best-fit packing of token sequences by repeated length patterns.

A document is its token ids and one id 0; only documents longer than CAPACITY are cut, into
pieces of CAPACITY. Pieces are packed by length alone: Spark counts the pieces of each length
(at most CAPACITY rows), the driver plans on that histogram, and every piece finds its place
from its rank among the pieces of its length.

Plan: patterns of two to four lengths that fill a sequence exactly are enumerated (each
length with its complement, and with one or two of the PIVOTS most frequent lengths).
Non-negative least squares fits their repeat counts to the histogram. Rounded counts (or the
one of their SHARES that gives the fewest sequences) are taken while pieces last; the residual
is packed best fit, largest first: a pattern starts with the longest length left, is filled
with the longest that still fits, and is repeated as often as the counts allow. The plan's
size depends on CAPACITY only.

Defined cases: null and empty texts are the one id 0; repeated rows are packed one by one;
rows without doc_id keep a null doc_id; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderlens.llm import common as c

CAPACITY = 2048
PIVOTS = 6
SHARES = (1.0, 0.75, 0.5, 0.25, 0.0)
GROUP = 50_000  # pieces of one length that one window group numbers, on average at most
WORD_CACHE = 450_000  # words whose ids a worker keeps
_FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of words as little-endian bytes. The tokenizer drops white space and never joins
    across it, so a text's ids are those of its words, and each word is encoded once while it is
    kept. Words come with A-Z in lower case, as the tokenizer has them, or as they are. A word that ends in stops
    after a letter is its stem and its stops, as the tokenizer always parts them there; words of
    letters alone are encoded many at a time."""

    STOPS = ".,;:!?"

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # tokens that end a stretch of letters, by the vocabulary's word-end mark
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {"": b""}

    def learn(self, words: set[str]) -> None:
        known, stopped = self.words, []
        for w in [w for w in words if w[-1] in self.STOPS]:
            stem = w.rstrip(self.STOPS)
            if stem and stem[-1].isalpha() and "'" not in w:
                stopped.append((w, stem, w[len(stem):]))
        words.difference_update([w for w, _, _ in stopped])
        words.update([x for _, *both in stopped for x in both if x not in known])
        plain = [p for p in words if p.isalpha()]
        other = [p for p in words if not p.isalpha()]
        chunks = [plain[i:i + 500] for i in range(0, len(plain), 500)]
        for chunk, e in zip(chunks, self.tokenizer.encode_batch_fast([" ".join(x) for x in chunks],
                                                                     add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(chunk):  # a word that is more than one stretch
                other += chunk
                continue
            raw, at = ids.tobytes(), 0
            for p, end in zip(chunk, (4 * ends).tolist(), strict=True):
                known[p] = raw[at:end]
                at = end
        for p, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
            known[p] = np.array(e.ids, "<u4").tobytes()
        for w, stem, stops in stopped:
            known[w] = known[stem] + known[stops]

    def ids(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        words = set().union(*split)
        if len(self.words) > WORD_CACHE:  # what is in use now stays
            self.words = {w: self.words[w] for w in words & self.words.keys()} | {"": b""}
        self.learn(words - self.words.keys())
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in split]


_KNOWN: dict[str, WordIds] = {}


def _encoded(words: WordIds, texts) -> Iterator[bytes]:
    """Ids of each text, about a megabyte of text at a time."""
    some, size = [], 0
    for t in texts:
        # of bytes: A-Z only; names of special tokens are told by their case
        some.append((t if b"<|" in t else t.lower()).decode("utf-8", "replace"))
        size += len(t)
        if size > 1 << 20:
            yield from words.ids(some)
            some, size = [], 0
    if some:
        yield from words.ids(some)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece."""

    def run(batches):
        if tokenizer not in _KNOWN:
            _KNOWN[tokenizer] = WordIds(tokenizer)
        words = _KNOWN[tokenizer]
        for batch in batches:
            keys, text = c.columns(batch, "doc_id", "text")
            out = [[], [], [], [], [], []]
            for key, ids in zip(keys.to_pylist(), _encoded(words, c.text_bytes(text)), strict=True):
                ids += b"\0\0\0\0"
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for o, v in zip(out, (key, k, at // 4, len(part) // 4, zlib.crc32(part), part), strict=True):
                        o.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            cols = [pa.array(o, k) for o, k in zip(out, kinds)]
            if with_ids:
                cols.append(c.list_array([np.frombuffer(x, "<u4").astype(np.int32) for x in out[5]], pa.int32()))
            yield pa.record_batch(cols, names=["doc_id", "piece", "start", "length", "ids_crc32",
                                               *["ids"] * with_ids])

    return c.texts(docs).mapInArrow(run, _FIELDS + ", ids array<int>" * with_ids)


def patterns(counts: np.ndarray) -> list[tuple[int, ...]]:
    """Exact fillings of a sequence by two to four of the lengths that occur."""
    full = len(counts) - 1
    have = np.flatnonzero(counts[:full])
    pivots = have[np.argsort(-counts[have], kind="stable")[:PIVOTS]]
    heads = [()] + [(int(p),) for p in pivots] + [
        (int(p), int(q)) for i, p in enumerate(pivots) for q in pivots[i:]]
    found = set()
    for a in have.tolist():
        for head in heads:
            rest = full - a - sum(head)
            if rest > 0 and counts[rest]:
                found.add(tuple(sorted((a, rest, *head), reverse=True)))
    return sorted(found, reverse=True)


def fit(counts: np.ndarray, columns: list[tuple[int, ...]], steps: int = 300) -> np.ndarray:
    """Non-negative least squares: repeat counts x >= 0 of the patterns with the smallest
    squared distance between the lengths they use and the histogram (multiplicative steps,
    which never leave x >= 0 and never increase the distance)."""
    rows = np.concatenate([np.array(p) for p in columns])
    cols = np.repeat(np.arange(len(columns)), [len(p) for p in columns])
    target = np.bincount(cols, counts[rows].astype(float))
    x = np.full(len(columns), counts.sum() / len(rows))
    for _ in range(steps):
        used = np.bincount(rows, x[cols], minlength=len(counts))
        x *= target / np.maximum(np.bincount(cols, used[rows]), 1e-12)
    return x


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) using exactly counts[length] pieces of each length.

    Exact patterns can use up short pieces that longer ones need, so the fitted counts are
    taken whole and in part (SHARES), and the plan with the fewest sequences is kept.
    """
    left = counts.astype(np.int64).copy()
    full = len(counts) - 1
    whole = [((full,), int(left[full]))] if left[full] else []
    left[full] = 0
    columns = patterns(left)
    x = fit(left, columns) if columns else np.zeros(0)
    plans = [_taken(left, columns, np.rint(share * x).astype(np.int64)) for share in SHARES]
    return whole + min(plans, key=lambda p: sum(n for _, n in p))


def _taken(counts: np.ndarray, columns: list[tuple[int, ...]], repeats: np.ndarray):
    """A plan that repeats the columns as given, while pieces last, and packs the residual."""
    left, full, out = counts.copy(), len(counts) - 1, []

    def take(pattern: tuple[int, ...], at_most: int | None = None) -> None:
        lengths, times = np.unique(pattern, return_counts=True)
        n = int((left[lengths] // times).min())
        n = n if at_most is None else min(n, at_most)
        if n > 0:
            left[lengths] -= n * times
            out.append((pattern, n))

    for i in np.argsort(-repeats, kind="stable"):
        if repeats[i] <= 0:
            break
        take(columns[i], int(repeats[i]))
    for longest in range(full, 0, -1):
        while left[longest]:
            free = left.copy()
            free[longest] -= 1
            pattern, space = [longest], full - longest
            while space > 0 and len(fits := np.flatnonzero(free[:space + 1])):
                pattern.append(int(fits[-1]))
                free[fits[-1]] -= 1
                space -= int(fits[-1])
            take(tuple(pattern))
    return out


def places(planned: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Runs of places: pieces of `length` from rank `first` on go to sequences from `sequence`
    on, at `offset`; sorted by length and first rank."""
    taken: dict[int, int] = {}
    runs, sequence = [], 0
    for pattern, n in planned:
        offset = 0
        for length in pattern:
            runs.append((length, taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + n
            offset += length
        sequence += n
    runs.sort()
    return tuple(np.array(x, np.int64) for x in zip(*runs, strict=True)) if runs else ()


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece."""
    cut = c.written(pieces(docs, tokenizer or default_tokenizer(), capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().collect():  # at most `capacity` rows
        counts[row["length"]] = row["count"]
    runs = cut.sparkSession.sparkContext.broadcast(places(plan(counts)))

    groups = max(64, int(counts.max()) // GROUP + 1)
    group = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups))
    cut = cut.withColumn("_group", group)
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy("length", "_group").agg(F.count("*").alias("_n"))
               .select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    within = Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (cut.withColumn("_rank", F.row_number().over(within) - 1).join(offsets, ["length", "_group"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("_rank") + F.col("_before")).alias("_rank")))

    def place(batches):
        for batch in batches:
            lengths, first, sequence, offset = runs.value
            length, rank = (x.to_numpy() for x in c.columns(batch, "length", "_rank"))
            at = np.searchsorted((lengths << 48) | first, (length << 48) | rank, "right") - 1
            yield pa.record_batch([*batch.columns[:5], sequence[at] + rank - first[at], offset[at]],
                                  names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, _FIELDS + ", sequence_id long, offset long")
