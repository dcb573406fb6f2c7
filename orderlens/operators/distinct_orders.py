"""Distinct orders over any range of dates, from bitmaps kept per day.

A distinct count cannot be added up from days, since an order may have rows on several days, groups or
batches. Bitmaps can: every order gets a dense number, a day's orders are bits, and the distinct count
of any union of days is the number of bits of their OR. Numbers follow the first date of an order, so a
day's orders lie in few of the fixed-size bitmaps, and a row is one group, day and bitmap. Everything
is Spark's own bitmap aggregates, combined before the shuffle; adding a batch and asking for a range
both read bitmap rows only, never orders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderlens.functions.dates import order_date
from orderlens.operators.ranking import with_row_number

DAY, BUCKET, BITS = "day", "bucket", "bits"


def number_orders(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """order_id, number: dense numbers from 1 on, by first date. With ``known`` (numbers given before) the
    orders in it keep theirs and new ones go on after the largest. Rows without order_id have none."""
    first = (orders.filter(F.col("order_id").isNotNull()).groupBy("order_id")
             .agg(F.min(order_date()).alias("_first")))
    if known is not None:
        first = first.join(known, "order_id", "left_anti")
    start = F.lit(0) if known is None else known.agg(F.coalesce(F.max("number"), F.lit(0))).scalar()
    fresh = with_row_number(first, [F.col("_first").asc_nulls_last(), F.col("order_id").asc()], "_rn").select(
        "order_id", (start + F.col("_rn")).cast("long").alias("number"))
    return fresh if known is None else known.unionByName(fresh)


def day_bitmaps(orders: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, day, bucket, bits: the orders of each group and day as bitmaps."""
    rows = orders.select("order_id", *keys, order_date().alias(DAY)).join(numbers, "order_id")
    return (rows.groupBy(*keys, DAY, F.bitmap_bucket_number("number").alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias(BITS)))


def merged(bitmaps: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The bitmaps of several batches as one table."""
    out = bitmaps[0]
    for more in bitmaps[1:]:
        out = out.unionByName(more)
    return out.groupBy(*keys, DAY, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_orders(bitmaps: DataFrame, keys: Sequence, start: dt.date | None = None,
                 end: dt.date | None = None) -> DataFrame:
    """keys, orders: distinct orders of each group on the days from ``start`` to ``end`` (both
    included; None: no limit). The filter on the day reaches the scan of stored bitmaps."""
    if start is not None:
        bitmaps = bitmaps.filter(F.col(DAY) >= F.lit(start))
    if end is not None:
        bitmaps = bitmaps.filter(F.col(DAY) <= F.lit(end))
    each = bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    names = [c for c in each.columns if c not in (BUCKET, BITS)]
    return each.groupBy(*names).agg(F.sum(F.bitmap_count(BITS)).alias("orders"))
