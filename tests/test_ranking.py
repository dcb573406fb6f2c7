"""Distributed ranking equals Spark's native (single-partition) windows; plan checks."""

import random

import pytest
from pyspark.sql import Window, functions as F

from orderlens.operators.ranking import (
    ntile_of, with_ntile, with_ntiles, with_percent_rank, with_rank, with_row_number,
)


@pytest.fixture(scope="module")
def tied(spark):
    rnd = random.Random(7)
    rows = [(f"u{k:05d}", rnd.choice([0, 0, 0, 1, 2, 3, 5, 8]) if k % 13 else None) for k in range(1200)]
    return spark.createDataFrame(rows, "user_id string, v int")


def _native(df, fn, with_tie_key=True):
    keys = [F.col("v").asc_nulls_last()] + ([F.col("user_id")] if with_tie_key else [])
    w = Window.orderBy(*keys)
    return {r.user_id: r.x for r in df.select("user_id", fn.over(w).alias("x")).collect()}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_row_number_matches_native(spark, tied, parts):
    got = with_row_number(tied, [F.col("v").asc_nulls_last(), F.col("user_id")], partitions=parts)
    assert {r.user_id: r._rn for r in got.collect()} == _native(tied, F.row_number())


def test_rank_and_percent_rank_with_heavy_ties(spark, tied):
    order = [F.col("v").asc_nulls_last(), F.col("user_id")]
    ranks = {r.user_id: r.rank for r in
             with_rank(tied, "v", order, partitions=7).collect()}
    assert ranks == _native(tied, F.rank(), with_tie_key=False)
    pr = {r.user_id: r.percent_rank for r in
          with_percent_rank(tied, "v", order, partitions=7).collect()}
    assert pr == _native(tied, F.percent_rank(), with_tie_key=False)


@pytest.mark.parametrize("k", [1, 4, 5, 7])
def test_ntile_matches_native(spark, tied, k):
    got = with_ntile(tied, k, [F.col("v").asc_nulls_last(), F.col("user_id")], partitions=5)
    assert {r.user_id: r.ntile for r in got.collect()} == _native(tied, F.ntile(k))


@pytest.mark.parametrize("n", [1, 2, 4, 5, 6, 11])
def test_ntile_formula_small_n(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").alias("rn"))
    got = [r.b for r in df.select(ntile_of(F.col("rn"), F.lit(n), 5).alias("b")).orderBy("rn").collect()]
    native = [r.b for r in df.select(F.ntile(5).over(Window.orderBy("rn")).alias("b")).orderBy("rn").collect()]
    assert got == native


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_user_rankings_use_no_global_window(spark):
    """No native percent_rank/ntile; windows run only over the per-partition counts."""
    import __spark_entry__ as entry
    plans = {n: _plan(entry.queries()[n](spark, "/root/testdata/sf0.001"))
             for n in ("clv", "rfm_segments", "global_percent_rank", "global_ntile")}
    for name, plan in plans.items():
        assert "percent_rank(" not in plan and "ntile(" not in plan, name
        for line in plan.splitlines():
            if "Window [" in line:
                # windows only over partition counts, or inside a slice of the range-partitioned order
                assert "_cnt" in line or "_last" in line or "_pid" in line, (name, line)


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_ntiles_several_orders_in_one_pass(spark, tied, parts):
    df = tied.withColumn("w", F.when(F.col("v") > 1, F.col("v") % 2))  # half of it NULL, two hot values
    got = with_ntiles(df, 5, {"a": F.col("v"), "b": -F.col("v"), "c": F.col("w").cast("decimal(30,4)")}, "user_id",
                      partitions=parts)
    assert got.columns == ["user_id", "v", "w", "a", "b", "c"]
    native = df.select("*", *[F.ntile(5).over(Window.orderBy(x, "user_id")).alias(name) for name, x in (
        ("a", F.col("v").asc_nulls_last()), ("b", F.col("v").desc_nulls_last()), ("c", F.col("w").asc_nulls_last()))])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, native.collect()), key=repr)
    assert with_ntiles(df.filter("false"), 5, {"a": F.col("v")}, "user_id").collect() == []


def test_one_hot_value_is_spread_over_slices(spark):
    from orderlens.operators.ranking import _sliced
    df = spark.range(4000).select(F.col("id").cast("string").alias("user_id"), F.lit(7).alias("v"))
    per = _sliced(df, [F.col("v"), F.col("user_id")], 8).groupBy("_pid").agg(F.count("*"), F.max("_pos")).collect()
    assert len(per) == 8 and max(r[1] for r in per) < 1500 and all(r[1] == r[2] for r in per)
