"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Sketch (fast similarity sketching): COORDS bins. In rounds 0..COORDS-1 every shingle of a
set is hashed to one bin with the value (round, hash); in rounds COORDS..2*COORDS-1 every
shingle of the set falls in bin round-COORDS, so every coordinate is filled. A bin keeps its
smallest value, and a set is done in the first round after which no bin is empty: large sets
need one or two rounds, small ones more. Two sets agree on a coordinate with probability
equal to their Jaccard similarity, and the count of agreements is concentrated like a sum of
independent draws.

Search: documents with equal shingle sets form one class. Each class falls in BANDS buckets,
one per run of ROWS coordinates. A pair at the threshold 0.8 shares no bucket with
probability (1 - 0.8^4)^32 < 1e-7. Candidates are never the pairs of a bucket:

1. every class of a bucket is compared with the bucket's hub (the class that meets most
   others), and the links found are closed to components;
2. the classes outside their bucket's main component are compared, block by block, with the
   classes of other components whose sketches agree on at least MIN_AGREE of the coordinates
   (more than four standard deviations below 0.8). Tasks get the blocks' sets and give back at
   most one link for each component that they join, so rows grow with classes, not with pairs.

Every link is confirmed on the full shingle sets.

Defined cases: null text is empty; texts without words have no shingle and no link; a
repeated row is answered for each of its rows; a row without doc_id keeps a null component
and stays; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm import common as c

COORDS = 128
ROWS = 4
BANDS = COORDS // ROWS  # 32
MIN_AGREE = 0.64
BLOCK = 4096  # rows of a bucket that one task compares at a time
_U = np.uint64


def sketch(shingles: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes: one uint16 per coordinate.

    A bin holds its smallest (round, value) as one number, the round in the upper 8 bits, so
    later rounds never replace earlier ones; small sets take many rounds in one step.
    """
    best = np.full(coords, ~_U(0))
    step = max(1, 1024 // len(shingles))
    for r0 in range(0, 2 * coords, step):
        rounds = np.arange(r0, min(r0 + step, 2 * coords), dtype=_U)[:, None]
        h = c.mix(shingles[None, :] + (rounds + _U(1)) * _U(0x9E3779B97F4A7C15))
        bins = np.where(rounds < coords, h % _U(coords), rounds - _U(coords))
        np.minimum.at(best, bins.ravel().astype(np.intp), ((rounds << _U(56)) | (h >> _U(8))).ravel())
        if (best != ~_U(0)).all():
            break
    return (c.mix(best) >> _U(48)).astype(np.uint16)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_id (128-bit fingerprint of the set), sketch (2*COORDS bytes)."""

    def run(batches):
        for batch in batches:
            ids, text = c.columns(batch, "doc_id", "text")
            n, fp, sk = [], [], []
            for t in c.text_bytes(text):
                s = c.shingles(t, words)
                n.append(len(s))
                if len(s):
                    fp.append(c.mix(s).sum().tobytes() + c.mix(s ^ _U(0x5DEECE66D)).sum().tobytes())
                    sk.append(sketch(s).tobytes())
                else:
                    fp.append(None)
                    sk.append(None)
            yield pa.record_batch([ids, pa.array(n, pa.int64()), pa.array(fp, pa.binary()),
                                   pa.array(sk, pa.binary())],
                                  names=["doc_id", "n_shingles", "set_id", "sketch"])

    return c.texts(docs).mapInArrow(
        run, "doc_id long, n_shingles long, set_id binary, sketch binary")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, shingles: the whole set of each document."""

    def run(batches):
        for batch in batches:
            ids, text = c.columns(batch, "doc_id", "text")
            sets = [c.shingles(t, words).view(np.int64) for t in c.text_bytes(text)]
            yield pa.record_batch([ids, c.list_array(sets, pa.int64())], names=["doc_id", "shingles"])

    return c.texts(docs).mapInArrow(run, "doc_id long, shingles array<long>")


def _verify(pairs: DataFrame, docs: DataFrame, sketched: DataFrame, words: int,
            percent: int) -> DataFrame:
    """The pairs (a, b) of class ids whose full sets reach the similarity."""
    side = lambda x: sketched.select(F.col("doc_id").alias(x), F.col("sketch").alias(f"_{x}"))
    likely = c.cut(pairs.join(side("a"), "a").join(side("b"), "b")
                   .filter(_agree("_a", "_b") >= int(MIN_AGREE * COORDS)).select("a", "b"))
    ids = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    sets = c.written(shingle_sets(c.only_ids(docs.select("doc_id", "text"), ids)
                                  .dropDuplicates(["doc_id"]), words), "sets")
    one = lambda x: sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"_{x}"))
    both = (likely.join(one("a"), "a").join(one("b"), "b")
            .withColumn("_i", F.size(F.array_intersect("_a", "_b"))))
    return c.cut(both.filter(100 * F.col("_i") >= percent * (F.size("_a") + F.size("_b") - F.col("_i")))
                 .select("a", "b"))


def _agree(a: str, b: str):
    """Coordinates on which two sketch columns agree."""
    def run(batches: pd.Series, other: pd.Series) -> pd.Series:
        if not len(batches):
            return pd.Series([], dtype="int32")
        x = np.frombuffer(b"".join(batches), np.uint16).reshape(len(batches), -1)
        y = np.frombuffer(b"".join(other), np.uint16).reshape(len(other), -1)
        return pd.Series((x == y).sum(1).astype("int32"))
    return F.pandas_udf(run, "int")(a, b)


def _band_keys(sketched: DataFrame) -> DataFrame:
    """(key, id): the buckets of each class. A bucket is a band and its sketch bytes, hashed to
    a key that is the band modulo BANDS."""
    width = 2 * ROWS
    bands = F.posexplode(F.array(*[F.substring("sketch", i * width + 1, width) for i in range(BANDS)]))
    h = F.xxhash64("_band", "_bytes")
    return (sketched.select(F.col("doc_id").alias("id"), bands.alias("_band", "_bytes"))
            .select((F.shiftleft(F.shiftright(h, 5), 5) + F.col("_band")).alias("key"), "id"))


def _shared_keys(keys: DataFrame) -> DataFrame:
    """The rows of keys whose bucket holds two classes or more (few of all)."""
    twice = c.written(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "buckets")
    return c.only_ids(keys, twice, "key")


def _hub_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): each class of a bucket with the bucket's hub."""
    size = shared.groupBy("key").agg(F.count("*").alias("n"))
    degree = shared.join(size, "key").groupBy("id").agg(F.sum("n").alias("degree"))
    hub = (shared.join(degree, "id").groupBy("key")
           .agg(F.max_by("id", F.struct("degree", -F.col("id"))).alias("hub")))
    return (shared.join(hub, "key").filter("id <> hub")
            .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())


def _open_buckets(keys: DataFrame, comp: DataFrame, sketched: DataFrame) -> DataFrame:
    """Rows (key, id, comp, sketch, n, minor) of the buckets of three classes or more (smaller
    ones are settled by their hub) whose classes are still in different components; minor:
    outside the component that most of the bucket's classes are in."""
    at = keys.join(comp, keys["id"] == comp["node"], "left").select(
        "key", "id", F.coalesce("component", "id").alias("comp"))
    per = at.groupBy("key", "comp").agg(F.count("*").alias("m"))
    main = per.groupBy("key").agg(F.sum("m").alias("n"), F.count("*").alias("n_comp"),
                                  F.max_by("comp", F.struct("m", -F.col("comp"))).alias("main"))
    main = main.filter("n > 2 and n_comp > 1")
    sk = sketched.select(F.col("doc_id").alias("id"), "sketch")
    return (at.join(main, "key").join(sk, "id")
            .select("key", "id", "comp", "sketch", "n", (F.col("comp") != F.col("main")).alias("minor")))


def _blocks(rows: DataFrame) -> DataFrame:
    """rows dealt to blocks (key, i, j) of at most BLOCK minor classes (left) and BLOCK others."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit(7)), blocks).cast("int")
    each = F.explode(F.sequence(F.lit(0), blocks - 1))
    more = ["id", "comp", "sketch"]
    left = rows.filter("minor").select("key", block.alias("i"), each.alias("j"), F.lit(True).alias("left"), *more)
    right = rows.select("key", each.alias("i"), block.alias("j"), F.lit(False).alias("left"), *more)
    return left.unionByName(right)


def _by_block(rows: DataFrame, work, schema: str) -> DataFrame:
    """work(columns of one block) for every block of rows; left rows come first."""

    def run(batches):
        rest = None  # rows of the block that the next batch may go on with
        for batch in batches:
            more = pa.Table.from_batches([batch])
            rest = more if rest is None else pa.concat_tables([rest, more])
            *done, last = _starts(rest)
            if done:  # else all rows read so far are of one block, which may go on
                yield from blocks(rest.slice(0, last), done)
                rest = rest.slice(last)
        if rest is not None:
            yield from blocks(rest, _starts(rest))

    def blocks(table, starts):
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            yield from work(table.slice(a, b - a))

    return (rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", F.desc("left"), "id")
            .mapInArrow(run, schema))


def _starts(table: pa.Table) -> list[int]:
    """Row numbers at which another (key, i, j) begins."""
    key, i, j = (table.column(x).to_numpy() for x in ("key", "i", "j"))
    new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    return [0, *(np.flatnonzero(new) + 1).tolist()]


def _candidates(block: pa.Table):
    """The rows of a block that have a candidate: a class of another component whose sketch
    agrees enough and with which this is the first shared bucket."""
    left, ids, comps = (block.column(x).to_numpy() for x in ("left", "id", "comp"))
    sk = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint16).reshape(len(ids), -1)
    n, band = int(left.sum()), block.column("key")[0].as_py() % BANDS
    keep = np.zeros(len(ids), bool)
    step = max(1, (1 << 16) // max(1, len(ids) - n))
    for at in range(0, n, step):
        x, y = slice(at, min(at + step, n)), slice(n, len(ids))
        same = sk[x, None] == sk[None, y]
        a, b = np.nonzero((same.sum(2) >= int(MIN_AGREE * COORDS)) & (comps[x, None] != comps[None, y]))
        first = same[a, b].reshape(len(a), BANDS, ROWS).all(2).argmax(1) == band
        keep[at + a[first]] = True
        keep[n + b[first]] = True
    if keep.any():
        yield from block.drop_columns(["sketch"]).filter(pa.array(keep)).to_batches()


def _links(block: pa.Table, percent: int):
    """(a, b): links that join the components of a block, from exact comparison of its sets."""
    left, ids, comps = (block.column(x).to_numpy() for x in ("left", "id", "comp"))
    sets = block.column("shingles").combine_chunks()
    ends = sets.offsets.to_numpy() - sets.offsets[0].as_py()
    _, flat = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    size = np.diff(ends)
    n, parent = int(left.sum()), {}

    def top(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    marked = np.zeros(int(flat.max()) + 1 if len(flat) else 1, bool)
    found = []
    others = slice(n, len(ids))
    for x in range(n):
        own = flat[ends[x]:ends[x + 1]]
        marked[own] = True
        both = np.add.reduceat(marked[flat[ends[n]:]], ends[n:-1] - ends[n]) if n < len(ids) else np.zeros(0, int)
        marked[own] = False
        near = 100 * both >= percent * (size[x] + size[others] - both)
        for y in np.flatnonzero(near & (comps[others] != comps[x])) + n:
            a, b = top(comps[x]), top(comps[y])
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    if found:
        yield pa.record_batch(list(np.array(found, np.int64).T), names=["a", "b"])


def _rest(keys: DataFrame, comp: DataFrame, docs: DataFrame, sketched: DataFrame, words: int,
          percent: int) -> DataFrame:
    """The links between classes that the hubs have left in different components."""
    part = c.written(_by_block(
        _blocks(_open_buckets(keys, comp, sketched)), _candidates,
        "key long, i int, j int, left boolean, id long, comp long"), "candidates")
    ids = part.select(F.col("id").alias("doc_id")).distinct()
    sets = c.written(shingle_sets(c.only_ids(docs.select("doc_id", "text"), ids)
                                  .dropDuplicates(["doc_id"]), words), "candidate_sets")
    rows = part.join(sets.withColumnRenamed("doc_id", "id"), "id")
    return _by_block(rows, lambda block: _links(block, percent), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs; see the module's text."""
    rows = c.written(sketches(docs, words), "sketches")
    heads = rows.filter("set_id is not null and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("head"))
    head = c.written(heads, "heads")
    sketched = c.written(rows.join(head, (rows["set_id"] == head["set_id"])
                                   & (rows["doc_id"] == head["head"]), "left_semi")
                         .dropDuplicates(["doc_id"]).select("doc_id", "sketch"), "classes")
    keys = c.written(_shared_keys(_band_keys(sketched)), "keys")
    links = _verify(_hub_pairs(keys), docs, sketched, words, percent)
    more = c.written(_rest(keys, c.components(links), docs, sketched, words, percent), "links")
    comp = c.components(links.union(more))
    found = (rows.join(head, "set_id", "left")
             .join(comp.withColumnRenamed("node", "head"), "head", "left"))
    component = F.coalesce("component", "head", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
