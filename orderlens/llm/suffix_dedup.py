"""Removal of long byte strings that occur twice, with a logarithmic family of suffix indexes.

Every byte covered by a LENGTH-byte string that also starts elsewhere is removed; texts are
UTF-8 bytes, matches never cross documents, overlaps count.

Suffixes are sampled by content: of the KEY-byte strings inside each LENGTH-byte window the
one with the smallest hash (the leftmost of equal ones) is the window's anchor, so equal
windows have equal anchors at equal places, and about one byte in 170 starts a sampled
suffix. An index row stands for one sampled suffix: `h`, the hash of its first KEY bytes
(the sort order of the sparse suffix array), and `ctx`, the hash of all bytes of the
consecutive windows that share this anchor.

Index family: documents come in batches. A batch gets its own sorted suffix array and is
merge-scanned with itself and with every level; rows whose first KEY bytes meet another
suffix are candidates. Then it becomes a level of its own size, and levels of equal size are
merged, so n batches leave at most log2(n) + 1 levels and each row is rewritten log2(n)
times. Batches only set how the index is built; the result is the same for any number.

Candidates are settled exactly, from coarse to fine (WIDTHS): a run of windows whose whole
context occurs twice is repeated; a run whose common core occurs once has no repeated
window; other runs are split, down to single windows. Each step is a count per hash with
partial aggregation, so a passage that very many documents share needs no large group.

Defined cases: null text is empty; texts shorter than LENGTH keep everything; a document is
the pair of doc_id and text, so repeated rows count as two places and both lose their
windows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import common as c

LENGTH = 400
KEY = 64
WIDTHS = (48, 8, 1)
BATCHES = 4
_U = np.uint64


def anchors(data: np.ndarray, length: int = LENGTH, key: int = KEY) -> tuple[np.ndarray, ...]:
    """(p, first, last, h, ctx) of each run of window starts first..last with anchor p."""
    n = len(data)
    if n < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty
    at = np.arange(n - key + 1)
    grams = c.span_hashes(data, at, at + key)
    w = length - key + 1
    # upper half hash, lower half place: the minimum is the leftmost of the smallest hashes
    value = (grams & _U(0xFFFFFFFF00000000)) | at.astype(_U)
    rows = -(-len(value) // w)
    padded = np.full(rows * w, ~_U(0))
    padded[:len(value)] = value
    grid = padded.reshape(rows, w)
    up = np.minimum.accumulate(grid, axis=1).ravel()
    down = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(down[:n - length + 1], up[w - 1:w - 1 + n - length + 1])
    p = (low & _U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
    last = np.concatenate((first[1:], [len(p)])) - 1
    p = p[first]
    ctx = c.mix(c.span_hashes(data, first, last + length) + (p - first).astype(_U))
    return p, first, last, grams[p].view(np.int64), ctx.view(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    d = c.texts(docs)
    return d.select(F.xxhash64("doc_id", "text").alias("_key"), "doc_id", "text")


def entries(keyed: DataFrame) -> DataFrame:
    """One row for each sampled suffix: its document, anchor, run of windows, h and ctx."""
    names = ["_key", "p", "first", "last", "h", "ctx"]

    def run(batches):
        for batch in batches:
            keys, text = c.columns(batch, "_key", "text")
            parts, n = [], []
            for t in c.text_bytes(text):
                parts.append(anchors(c.as_bytes(t)))
                n.append(len(parts[-1][0]))
            if sum(n):
                own = np.repeat(keys.to_numpy(), n)
                yield pa.record_batch([own, *(np.concatenate([x[i] for x in parts]) for i in range(5))],
                                      names=names)

    return keyed.select("_key", "text").filter(F.octet_length("text") >= LENGTH).mapInArrow(
        run, ", ".join(f"{x} long" for x in names))


class SuffixFamily:
    """Levels of sorted sparse suffix arrays; level k holds 2^k batches."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}

    def add(self, batch: DataFrame) -> DataFrame:
        """Index a batch of entries; the suffix keys `h` met twice in it or met in a level."""
        own = c.written(batch.groupBy("h").agg(F.count("*").alias("n"))
                        .sortWithinPartitions("h"), "suffixes")
        found = own.filter("n > 1").select("h")
        for level in self.levels.values():
            found = found.union(own.join(level, "h", "left_semi").select("h"))
        found = c.written(found.distinct(), "met")
        size = 0
        while size in self.levels:
            merged = own.unionByName(self.levels.pop(size)).groupBy("h").agg(F.sum("n").alias("n"))
            own, size = c.written(merged.sortWithinPartitions("h"), "suffixes"), size + 1
        self.levels[size] = own
        return found


def _split(keyed: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """runs (_key, p, first, last, many) cut at multiples of width before the anchor, with the
    hashes of the core that any window of a cut has and of the cut's whole context."""
    names = ["_key", "p", "first", "last", "many", "core", "ctx"]

    def run(batches):
        for batch in batches:
            keys, text, todo = c.columns(batch, "_key", "text", "runs")
            out = [[] for _ in names]
            for key, t, own in zip(keys.to_numpy(), c.text_bytes(text), todo.to_pylist(), strict=True):
                data = c.as_bytes(t)
                p, first, last, many = (np.array([r[x] for r in own]) for x in ("p", "first", "last", "many"))
                low, high = (p - last) // width, (p - first) // width  # cuts by distance to the anchor
                n = high - low + 1
                row = np.repeat(np.arange(len(p)), n)
                cut = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + low[row]
                a = np.maximum(first[row], p[row] - (cut + 1) * width + 1)
                b = np.minimum(last[row], p[row] - cut * width)
                core = c.span_hashes(data, p[row] - cut * width, p[row] - (cut + 1) * width + 1 + LENGTH)
                tag = (cut * 64 + WIDTHS.index(width)).astype(_U)
                ctx = c.span_hashes(data, a, b + LENGTH)
                place = ((p[row] - a) * LENGTH + (p[row] - b)).astype(_U)
                for o, v in zip(out, (np.full(len(row), key), p[row], a, b, many[row],
                                      c.mix(core + tag).view(np.int64), c.mix(ctx + place).view(np.int64)),
                                strict=True):
                    o.append(v)
            if out[0]:
                yield pa.record_batch([np.concatenate(o) for o in out], names=names)

    lists = runs.groupBy("_key").agg(F.collect_list(F.struct("p", "first", "last", "many")).alias("runs"))
    text = c.only_ids(keyed.select("_key", "text"), lists, "_key").dropDuplicates(["_key"])
    return text.join(lists, "_key").mapInArrow(
        run, "_key long, p long, first long, last long, many boolean, core long, ctx long")


def _one_each(rows: DataFrame) -> DataFrame:
    """One run for each context, many: it stands for more than one place."""
    return rows.groupBy("ctx").agg(
        F.min_by(F.struct("_key", "p", "first", "last"), F.struct("_key", "first")).alias("r"),
        ((F.count("*") > 1) | F.max("many")).alias("many")).select("r.*", "many")


def repeated_windows(keyed: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(_key, first, last): runs of window starts whose LENGTH bytes also start elsewhere."""
    every = c.written(entries(keyed).withColumn("batch", F.pmod("_key", F.lit(batches))), "entries")
    family, met = SuffixFamily(), None
    for k in range(batches):
        found = family.add(every.filter(F.col("batch") == k))
        met = found if met is None else met.union(found)
    # a key met in one batch may have its first suffix in an earlier one: all entries are kept
    near = c.written(every.join(met, "h", "left_semi").drop("batch"), "candidates")
    per = near.groupBy("h", "ctx").agg(
        F.count("*").alias("n"),
        F.min_by(F.struct("_key", "p", "first", "last"), F.struct("_key", "first")).alias("r"))
    per = c.written(per, "contexts")
    done = [near.join(per.filter("n > 1").select("ctx"), "ctx", "left_semi").select("_key", "first", "last")]
    mixed = per.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1")
    runs = per.join(mixed, "h", "left_semi").select("r.*", (F.col("n") > 1).alias("many"))
    for width in WIDTHS:
        rows = c.written(_split(keyed, runs, width), f"runs_{width}")
        twice = rows.groupBy("ctx").agg(F.count("*").alias("n"), F.max("many").alias("any")).filter("n > 1 or any")
        done.append(rows.join(twice.select("ctx"), "ctx", "left_semi").filter("not many")
                    .select("_key", "first", "last"))
        if width == 1:
            break
        # a core that one context alone has cannot hold a repeated window, and runs whose
        # contexts are all settled need no finer look
        cores = rows.groupBy("core", "ctx").agg((F.max("many") | (F.count("*") > 1)).alias("settled"))
        cores = cores.groupBy("core").agg(F.count("*").alias("k"), F.min("settled").alias("settled")).filter(
            "k > 1 and not settled")
        runs = _one_each(rows.join(cores.select("core"), "core", "left_semi"))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _spans(keyed: DataFrame, batches: int) -> DataFrame:
    return c.written(repeated_windows(keyed, batches).groupBy("_key").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")), "spans")


def _without(keyed: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, _key, figures and kept text of the documents that lose bytes."""

    def run(rows):
        for batch in rows:
            keys, ids, text, todo = c.columns(batch, "_key", "doc_id", "text", "runs")
            out = [[], [], [], [], []]
            for t, own in zip(c.text_bytes(text), todo.to_pylist(), strict=True):
                gone = np.zeros(len(t) + 1, np.int32)
                np.add.at(gone, [r["first"] for r in own], 1)
                np.add.at(gone, [r["last"] + LENGTH for r in own], -1)
                gone = np.cumsum(gone[:-1]) > 0
                kept = c.as_bytes(t)[~gone].tobytes()
                starts = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(gone[0])
                for o, v in zip(out, (len(t), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest(),
                                      kept.decode("utf-8", "ignore")), strict=True):
                    o.append(v)
            yield pa.record_batch([keys, ids, *(pa.array(v, pa.int64()) for v in out[:3]),
                                   pa.array(out[3], pa.string()), pa.array(out[4], pa.string())],
                                  names=["_key", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
                                         "kept_text"])

    return c.only_ids(keyed, spans, "_key").join(spans, "_key").select("_key", "doc_id", "text", "runs").mapInArrow(
        run, "_key long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
             "kept_text string")


def remove_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of docs."""
    keyed = _keyed(docs)
    spans = _spans(keyed, batches)
    zero = F.lit(0).cast("long")
    rest = c.without_ids(keyed, spans, "_key").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"),
        zero.alias("n_spans"), F.sha2(F.encode("text", "utf-8"), 256).alias("kept_sha256"))
    return _without(keyed, spans).drop("_key", "kept_text").unionByName(rest)


def cut_texts(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """_key (xxhash64 of doc_id and text) and kept_text of the documents that lose bytes;
    a character that is cut in two is left out."""
    keyed = _keyed(docs)
    return _without(keyed, _spans(keyed, batches)).select("_key", "kept_text").dropDuplicates(["_key"])
