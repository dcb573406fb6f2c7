"""Distinct orders from day bitmaps equal count_distinct, over any range and any split into batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderlens.operators import distinct_orders as d
from orderlens.session import stored


@pytest.fixture(scope="module")
def orders(spark):
    rng = random.Random(3)
    days = [dt.datetime(2020, 1, 1, 12) + dt.timedelta(days=k) for k in range(40)]
    # an order may come on several days, at several places, in several rows; some have no id
    rows = [(f"o{rng.randrange(900)}" if rng.random() > 0.02 else None, rng.choice(["a", "b", "b", None]),
             rng.choice(days) if rng.random() > 0.03 else None) for _ in range(3000)]
    return stored(spark.createDataFrame(rows, "order_id string, place string, creation_time_utc timestamp_ntz"), "orders")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("start,end", [(None, None), (dt.date(2020, 1, 10), dt.date(2020, 1, 20)),
                                       (dt.date(2020, 1, 5), dt.date(2020, 1, 5)), (dt.date(2021, 1, 1), None)])
def test_any_range_equals_count_distinct(orders, start, end):
    bitmaps = d.day_bitmaps(orders, d.number_orders(orders), ["place"])
    day = F.to_date("creation_time_utc")
    some = orders.filter("order_id is not null")
    if start:
        some = some.filter(day >= F.lit(start))
    if end:
        some = some.filter(day <= F.lit(end))
    want = some.groupBy("place").agg(F.count_distinct("order_id").alias("orders"))
    assert rows_of(d.count_orders(bitmaps, ["place"], start, end)) == rows_of(want)


def test_batches_keep_their_numbers_and_merge(orders):
    parts = [orders.filter(F.pmod(F.xxhash64("order_id", "creation_time_utc"), F.lit(3)) == i) for i in range(3)]
    numbers, bitmaps = None, []
    for part in parts:
        before = {} if numbers is None else dict(map(tuple, numbers.collect()))
        numbers = stored(d.number_orders(part, numbers), "numbers")
        now = dict(map(tuple, numbers.collect()))
        assert before.items() <= now.items() and sorted(now.values()) == list(range(1, len(now) + 1))
        bitmaps.append(d.day_bitmaps(part, numbers, ["place"]))
    got = d.count_orders(d.merged(bitmaps, ["place"]), [])
    assert got.first()["orders"] == orders.agg(F.count_distinct("order_id")).first()[0]


def test_numbers_follow_the_first_date(orders):
    numbered = d.number_orders(orders).join(
        orders.groupBy("order_id").agg(F.to_date(F.min("creation_time_utc")).alias("first")), "order_id")
    rows = sorted((r["number"], r["first"] or dt.date.max) for r in numbered.collect())
    assert [r[1] for r in rows] == sorted(r[1] for r in rows)


def test_no_orders(spark, orders):
    none = orders.filter("false")
    assert d.count_orders(d.day_bitmaps(none, d.number_orders(none), ["place"]), ["place"]).collect() == []
