"""Helpers shared by the training-data operators.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return, so a text is split the same way as UTF-8 bytes or as code points.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.session import checkpoint_dir, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
_U = np.uint64
_MASK = (1 << 64) - 1
# Broadcast tables of id slots have at most this many rows, whatever the input size.
ID_SLOTS = 1 << 20
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def for_workers(spark: SparkSession) -> None:
    """Settings of the Python workers, where the session has none of its own: Arrow batches of
    whole texts stay small, and workers of a local session find this package where the driver
    found it (on a cluster it is installed or sent with --py-files)."""
    if spark.conf.get(ARROW_ROWS) == "10000":  # Spark's default
        spark.conf.set(ARROW_ROWS, "1000")
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text (null: empty) and the named columns; all others are left behind."""
    for_workers(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet under the shared checkpoint folder and read again.

    Cuts the lineage with files that every executor reaches, so a lost executor costs
    only its own tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """df from reliable checkpoint files in the shared folder (small tables)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def only_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of df whose key is in ids, without shuffling the rows that are not.

    A broadcast table of at most ID_SLOTS hash slots drops most other rows before the
    exact semi-join. The more ids there are, the less it drops; the result is the same.
    """
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(ID_SLOTS))
    slots = ids.select(slot.alias("_slot")).distinct()
    near = df.withColumn("_slot", slot).join(F.broadcast(slots), "_slot", "left_semi").drop("_slot")
    return near.join(ids.select(key), key, "left_semi")


def without_ids(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of df whose key is not in ids (null keys stay); only rows that share a hash slot
    with an id are shuffled for the exact anti-join."""
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(ID_SLOTS))
    slots = F.broadcast(ids.select(slot.alias("_slot")).distinct())
    marked = df.withColumn("_slot", slot)
    near = marked.join(slots, "_slot", "left_semi").join(ids.select(key), key, "left_anti")
    return marked.join(slots, "_slot", "left_anti").unionByName(near).drop("_slot")


def smallest_hashes(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """At most n rows of df: those with the smallest hashes of the columns.

    A cut that leaves about a fifth more than n rows comes first, so the final order is over
    that many rows in all, not over n rows of every partition.
    """
    h, total = F.xxhash64(*columns), df.count()
    if total > n:
        df = df.filter(h <= int(-2 ** 63 + min(2 ** 64 - 1, 2 ** 64 * 1.2 * n / total)))
    return df.orderBy(h, *columns).limit(n)


# --- hashing ---------------------------------------------------------------------------
def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64): every input bit reaches every output bit."""
    h = h.astype(_U, copy=True)
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_POW: dict[str, np.ndarray] = {}


def _powers(n: int, base: int, name: str) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept and grown per worker."""
    have = _POW.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, _U(base))
        have[0] = 1
        _POW[name] = have = np.cumprod(have, dtype=_U)
    return have[:n]


_INVERSE = pow(_BASE, -1, 1 << 64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal bytes give equal hashes."""
    n = len(data)
    prefix = np.zeros(n + 1, dtype=_U)
    np.cumsum(_BYTE[data] * _powers(n, _BASE, "up"), out=prefix[1:])
    inverse = _powers(n + 1, _INVERSE, "down")
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(_U))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a UTF-8 text."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def as_bytes(text: bytes) -> np.ndarray:
    return np.frombuffer(text, dtype=np.uint8)


def word_hashes(text: bytes, lower: bool = True) -> np.ndarray:
    data = as_bytes(text)
    if lower:
        data = _LOWER[data]
    starts, ends = word_spans(data)
    return span_hashes(data, starts, ends)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k consecutive word hashes (none if there are fewer)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    h = np.zeros(n, dtype=_U)
    for j in range(k):
        h = h * _U(0x9FB21C651E98DF25) + words[j:j + n]
    return mix(h)


def distinct_sorted(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct k-word shingle hashes, A-Z lower-cased; a shorter text is one
    shingle of all its words, a text without words has none."""
    words = word_hashes(text)
    if 0 < len(words) < k:
        k = len(words)
    return distinct_sorted(window_hashes(words, k))


# --- Arrow -----------------------------------------------------------------------------
def columns(batch: pa.RecordBatch, *names: str):
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each text of a string column as UTF-8 bytes (null: empty)."""
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one numpy array per row."""
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


# --- connected components --------------------------------------------------------------
def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of the links (a, b).

    Alternating large-star and small-star steps: each is a minimum per node (partially
    aggregated before the shuffle) and one join, never a group in one task. Each round is
    checkpointed; the number of rounds grows with the logarithm of a component's size.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .filter("a <> b").distinct())
    while True:
        # done when every edge leads to a node that has no smaller one, and each node has one edge
        again = (edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
                 .union(edges.groupBy("a").count().filter("count > 1").select("a")))
        if again.agg(F.count("*")).first()[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("x"), "a", "m"))
        edges = cut(small.select(F.col("x").alias("a"), F.col("m").alias("b"))
                    .unionByName(small.select("a", F.col("m").alias("b")))
                    .filter("a <> b").distinct())
    tops = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
