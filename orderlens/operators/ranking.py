"""Global ranking without a single-partition window.

``percent_rank().over(Window.orderBy(x))`` has no partition key, so Spark
plans ``Exchange SinglePartition``: every user row goes through one task. Here
the same numbers come from a range-partitioned sort, whatever the size:

1. ``repartitionByRange(n, order...)`` puts a contiguous slice of the global
   order into each partition. The order always ends with a unique tie key, so
   one hot value is spread over many partitions. Each slice is sorted, and
   ``monotonically_increasing_id`` numbers it: the partition and the place in it.
2. The frame is then written to the shared folder: range bounds come from
   sampling, and they must not change if an executor is lost. Ranks with ties
   come from a window inside each slice.
3. One row per slice (its size, its first and last value, and where its last
   value began) gives each slice its offset and, for a value that began in an
   earlier slice, that value's rank. This table of at most ``n`` rows is
   broadcast; rows are never grouped or joined on the ranked value.

Ntile buckets follow from the row number and the total count alone. Several
ntiles over one frame are numbered in one pass: every row is sent once per order,
as (order, value, tie key), into one sort; the numbers meet again per tie key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderlens.session import stored


def with_row_number(df: DataFrame, order: Sequence[Column], name: str = "_rn",
                    count_name: str = "_n", partitions: int | None = None) -> DataFrame:
    """Add the 1-based global row number over ``order`` and the total row count.

    ``order`` must be a total order (end it with a unique key) for the numbers
    to be repeatable.
    """
    return _numbered(df, order, partitions, count_name, rn=name)


def _sliced(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """df in slices of its global order, each sorted: slice (``_pid``) and 1-based place (``_pos``)."""
    n = max(1, int(partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = F.col("_at")  # the partition in the upper bits, the row's place in the lower 33
    return (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_at", F.monotonically_increasing_id())
            .withColumns({"_pid": F.shiftright(at, 33).cast("int"), "_pos": at.bitwiseAND((1 << 33) - 1) + 1})
            .drop("_at"))


def _numbered(df: DataFrame, order: Sequence[Column], partitions: int | None, count_name: str,
              rn: str | None = None, value: str | None = None, rank: str | None = None) -> DataFrame:
    """Row number (``rn``) and/or rank over the first key (``rank``, of column ``value``)."""
    sliced = _sliced(df, order, partitions)
    if rank is not None:
        local = F.rank().over(Window.partitionBy("_pid").orderBy(order[0])).cast("long")
        sliced = sliced.withColumn("_local", local)
    sliced = stored(sliced, "slices")

    edges = [F.count(F.lit(1)).alias("_cnt")]
    if rank is not None:
        edges += [F.min_by(F.struct(value), "_pos").alias("_first"), F.max_by(F.struct(value), "_pos").alias("_last"),
                  F.max("_local").alias("_began")]
    sizes = sliced.groupBy("_pid").agg(*edges)
    # at most n rows from here on: the partition count bounds this frame
    up = Window.orderBy("_pid")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    slices = sizes.select("*", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                          F.sum("_cnt").over(Window.partitionBy()).alias(count_name))
    if rank is not None:
        # the last value of a slice began here, unless the whole slice goes on with the
        # value that the slice before ended with
        whole = F.col("_first").eqNullSafe(F.col("_last")) & F.col("_first").eqNullSafe(F.lag("_last").over(up))
        slices = slices.withColumn("_start", F.when(~F.coalesce(whole, F.lit(False)), F.col("_off") + F.col("_began")))
        slices = (slices.withColumn("_carried", F.last("_start", ignorenulls=True).over(before))
                  .withColumn("_into", F.lag("_last").over(up)))
    slices = slices.drop("_cnt", "_first", "_last", "_began", "_start")
    out = sliced.join(F.broadcast(slices), "_pid")
    if rn is not None:
        out = out.withColumn(rn, F.col("_off") + F.col("_pos"))
    if rank is not None:
        out = out.withColumn(rank, F.when(F.struct(value).eqNullSafe(F.col("_into")), F.col("_carried"))
                             .otherwise(F.col("_off") + F.col("_local")))
    return out.drop("_pid", "_pos", "_local", "_off", "_carried", "_into")


def with_rank(df: DataFrame, value: str, order: Sequence[Column], name: str = "rank",
              count_name: str = "_n", partitions: int | None = None) -> DataFrame:
    """SQL RANK over ``order`` (whose first key is ``value``): ties share the lowest number."""
    return _numbered(df, order, partitions, count_name, value=value, rank=name)


def with_percent_rank(df: DataFrame, value: str, order: Sequence[Column], name: str = "percent_rank",
                      partitions: int | None = None) -> DataFrame:
    """SQL PERCENT_RANK: (rank - 1) / (n - 1), 0 for a single row."""
    ranked = with_rank(df, value, order, "_rank", "_n", partitions)
    pr = F.when(F.col("_n") > 1,
                (F.col("_rank") - 1).cast("double") / (F.col("_n") - 1).cast("double")
                ).otherwise(F.lit(0.0))
    return ranked.withColumn(name, pr).drop("_rank", "_n")


def ntile_of(row_number: Column, total: Column, k: int) -> Column:
    """SQL NTILE(k) bucket of a 1-based row number among ``total`` rows.

    The first ``total % k`` buckets hold one row more than the others.
    """
    q = F.floor(total / F.lit(k)).cast("bigint")
    r = (total - q * F.lit(k)).cast("bigint")
    big = r * (q + 1)  # rows in the larger buckets
    in_big = F.floor((row_number - 1) / (q + 1)) + 1
    in_small = r + F.floor((row_number - big - 1) / F.greatest(q, F.lit(1))) + 1
    return F.when(row_number <= big, in_big).otherwise(in_small).cast("int")


def with_ntile(df: DataFrame, k: int, order: Sequence[Column], name: str = "ntile",
               partitions: int | None = None) -> DataFrame:
    """SQL NTILE(k) over ``order`` (a total order)."""
    numbered = with_row_number(df, order, "_rn", "_n", partitions)
    return numbered.withColumn(name, ntile_of(F.col("_rn"), F.col("_n"), k)).drop("_rn", "_n")


def with_ntiles(df: DataFrame, k: int, values: dict[str, Column], key: str,
                partitions: int | None = None) -> DataFrame:
    """Several NTILE(k) columns in one pass: for each ``{name: value}`` the bucket of a row in
    ascending order of that number (NULLs last), ties by the unique column ``key``.

    All orders share one range sort of (order, value, key) rows. The other columns travel with the
    rows of the first order and meet the numbers again in one aggregation per key.
    """
    rest = [c for c in df.columns if c != key]
    first = F.col("_order") == 0
    rows = df.select("*", F.posexplode(F.array(*values.values())).alias("_order", "_value"))
    rows = rows.select(key, "_order", "_value", *[F.when(first, F.col(c)).alias(c) for c in rest])
    order = [F.col("_order").asc(), F.col("_value").asc_nulls_last(), F.col(key).asc()]
    sliced = stored(_sliced(rows, order, partitions).drop("_value"), "slices")
    # at most one row a slice and order
    sizes = sliced.groupBy("_pid", "_order").agg(F.count("*").alias("_cnt"), F.min("_pos").alias("_first"))
    per = Window.partitionBy("_order")
    slices = sizes.select(
        "_pid", "_order", F.sum("_cnt").over(per).alias("_n"),
        (F.coalesce(F.sum("_cnt").over(per.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
         - F.col("_first") + 1).alias("_off"))
    tile = ntile_of(F.col("_off") + F.col("_pos"), F.col("_n"), k)
    numbered = sliced.join(F.broadcast(slices), ["_pid", "_order"]).withColumn("_tile", tile)
    out = numbered.groupBy(key).agg(
        *[F.max(c).alias(c) for c in rest],
        *[F.max(F.when(F.col("_order") == i, F.col("_tile"))).alias(name) for i, name in enumerate(values)])
    return out.select(*df.columns, *values)
