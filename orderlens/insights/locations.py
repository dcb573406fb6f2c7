"""Location dashboard aggregates (D11-D14) on the location report's result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlens.functions.numeric import round_money

METRICS = ("avg_order_value", "orders_per_day", "orders_per_week")
TOP_N = 5


def rounded(locations: DataFrame) -> DataFrame:
    """The four metrics rounded to 2 decimals (revenue exactly, as money)."""
    return locations.select(
        "location_id", round_money("total_revenue").alias("total_revenue"), "revenue_rank",
        F.round("avg_order_value", 2).alias("avg_order_value"),
        F.round("orders_per_day", 2).alias("orders_per_day"),
        F.round("orders_per_week", 2).alias("orders_per_week"))


def top(locations: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` highest revenues."""
    return locations.orderBy(F.col("total_revenue").desc_nulls_last(), "location_id").limit(n)


def bottom(locations: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` lowest revenues."""
    return locations.orderBy(F.col("total_revenue").asc_nulls_last(), "location_id").limit(n)


def by_metric(locations: DataFrame, metric: str) -> DataFrame:
    """All locations, largest ``metric`` first."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    return locations.orderBy(F.col(metric).desc_nulls_last(), "location_id")
