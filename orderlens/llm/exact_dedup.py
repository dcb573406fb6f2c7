"""Exact duplicates by sorting contents.

Texts are equal when they are identical without the characters of [\\x20\\x09-\\x0D]. Rows are
range-partitioned by sampled splitters on the first PREFIX characters of the normalised text
(then its SHA-256, then the rank within equal texts), each slice is sorted externally, and every
row is compared in full with its neighbour. The splitters hold prefixes and digests only, so what
the driver samples does not grow with the length of texts, and as they go on to the row's own
rank, equal texts that hold a third of all rows are spread over as many slices as they fill.

A run is a stretch of equal neighbours in a slice. A slice's first text is compared with the last
text of the slice before, so runs that go on over slices are joined; that chain has one row a
slice. Only texts move in the sort: what follows carries ids, lengths and digests.

Of equal texts the row with the most code points in the original stays, then the smallest
doc_id (null after all others).

Defined cases: null text counts as empty; texts without other characters are equal to each
other; of repeated rows exactly one stays, and each row is answered; a group whose rows all lack
a doc_id has a null keep_id; ties in length and doc_id are repeated rows, of which either may be
the one that stays; a very long text is one row of the sort; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from orderlens.llm import common as c

SPACES = " \t\n\x0b\x0c\r"
PREFIX = 32
_ROWS = "slice int, run long, doc_id long, head long, first boolean, sha binary, edge string, is_last boolean"

ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id ASC NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""


def _sorted_contents(docs: DataFrame) -> DataFrame:
    """doc_id, norm, sha in content order: sampled splitters deal ranges, each is sorted."""
    norm = F.translate("text", SPACES, "")
    rows = (c.texts(docs).select("doc_id", norm.alias("norm"), F.length("text").alias("n"))
            .withColumn("sha", F.unhex(F.sha2("norm", 256))))
    order = [F.substring("norm", 1, PREFIX).asc(), F.col("sha").asc(), F.col("n").desc(),
             F.col("doc_id").asc_nulls_last()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "norm", "sha")


def _runs(batches):
    """Runs of equal neighbours. Each slice begins with a row that carries its first text and ends
    with one that carries its last text (edge); all other rows are documents without their text."""
    at, run, head, last = TaskContext.get().partitionId(), -1, None, None

    def edge(text, is_last):
        return pa.record_batch([pa.array([x], t) for x, t in zip(
            (at, max(run, 0), None, None, False, None, text, is_last), kinds, strict=True)], names=names)

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.string(), pa.bool_()]
    names = ["slice", "run", "doc_id", "head", "first", "sha", "edge", "is_last"]
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        ids, norm, sha = c.columns(batch, "doc_id", "norm", "sha")
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        if last is None:
            yield edge(norm[0].as_py(), False)
        else:
            new[0] = norm[0].as_py() != last
        runs = run + np.cumsum(new)
        start = np.maximum.accumulate(np.where(new, np.arange(n), -1))  # -1: the run began in an earlier batch
        heads = ids.take(pa.array(start, mask=start < 0))
        if head is not None:
            heads = pc.if_else(pa.array(start < 0), pa.scalar(head, pa.int64()), heads)
        yield pa.record_batch([pa.array(np.full(n, at, np.int32)), pa.array(runs), ids, heads, pa.array(new),
                               sha.cast(pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.bool_())], names=names)
        run, head, last = int(runs[-1]), heads[n - 1].as_py(), norm[n - 1].as_py()
    if last is not None:
        yield edge(last, True)


def _chain(rows: DataFrame) -> DataFrame:
    """(slice, to_slice, to_run) of the slices whose first run goes on from the slices before, with
    the slice and run where it began. One row a slice."""
    ends = rows.filter("is_last").select("slice", "run", "edge")
    order = Window.orderBy("slice")  # one row a slice: as many as there are shuffle partitions
    turn = ends.select("slice", "run", F.lag("slice").over(order).alias("before"))
    first = rows.filter("not is_last").select("slice", F.col("edge").alias("first"))
    last = ends.select(F.col("slice").alias("before"), F.col("edge").alias("last"))
    on = (turn.join(first, "slice").join(last, "before", "left")
          .select("slice", "run", "before", F.coalesce(F.col("first") == F.col("last"), F.lit(False)).alias("goes_on")))
    # the run that reaches a slice's end began there, unless the slice is one run that goes on
    began = F.when(~F.col("goes_on") | (F.col("run") > 0), F.struct("slice", "run"))
    began = F.last(began, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = on.withColumn("began", began)
    return (marked.withColumn("to", F.lag("began").over(order)).filter("goes_on")
            .select("slice", F.lit(0).cast("long").alias("run"), F.col("to.slice").alias("to_slice"),
                    F.col("to.run").alias("to_run")))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of docs; see the module's text."""
    rows = c.written(_sorted_contents(docs).mapInArrow(_runs, _ROWS), "runs")
    chain = c.cut(_chain(rows))
    data = rows.filter("edge is null")
    # runs with company: in their own slice or, by the chain, in another
    local = data.groupBy("slice", "run").agg(F.count("*").alias("n"), F.max("head").alias("head"))
    links = F.broadcast(chain)  # at most one row a slice
    starts = F.broadcast(chain.select(F.col("to_slice").alias("slice"), F.col("to_run").alias("run")).distinct()
                         .withColumn("leads", F.lit(True)))
    local = c.written(local.join(links, ["slice", "run"], "left").join(starts, ["slice", "run"], "left")
                      .filter("n > 1 or to_slice is not null or leads"), "groups")
    parts = local.filter("to_slice is not null or leads").select(
        "slice", "run", "n", "head", F.coalesce("to_slice", "slice").alias("gs"), F.coalesce("to_run", "run").alias("gr"))
    whole = parts.groupBy("gs", "gr").agg(  # one row a chained run
        F.sum("n").alias("size"), F.max(F.when((F.col("slice") == F.col("gs")) & (F.col("run") == F.col("gr")),
                                               F.col("head"))).alias("keep"))
    joined = (parts.join(whole, ["gs", "gr"])
              .select("slice", "run", "size", "keep", (F.col("slice") == F.col("gs")).alias("leader")))
    alone = local.filter("to_slice is null and leads is null").select(
        "slice", "run", F.col("n").alias("size"), F.col("head").alias("keep"), F.lit(True).alias("leader"))
    out = data.join(alone.unionByName(joined), ["slice", "run"], "left")
    return out.select(
        "doc_id", F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("first") & F.coalesce("leader", F.lit(True))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
