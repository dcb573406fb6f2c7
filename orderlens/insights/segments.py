"""Customer-segmentation dashboard aggregates (D7-D10) on the RFM result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.functions.numeric import mean_of, money_sum, safe_ratio

SAMPLE_ROWS = 20


def segment_counts(rfm: DataFrame) -> DataFrame:
    """Customers per segment."""
    return rfm.groupBy("customer_segment").agg(F.count("user_id").alias("customer_count"))


def revenue_share(rfm: DataFrame) -> DataFrame:
    """Spend per segment and its share of all spend.

    The share's denominator is a window over the segment rows (four labels at
    most), not over customers.
    """
    per_segment = rfm.groupBy("customer_segment").agg(
        F.sum(F.col("total_cost_per_user").cast("decimal(38,4)")).alias("_rev"))
    return per_segment.select(
        "customer_segment",
        F.col("_rev").cast("double").alias("total_cost_per_user"),
        safe_ratio(F.col("_rev"), F.sum("_rev").over(Window.partitionBy())).alias("revenue_share"))


def segment_summary(rfm: DataFrame) -> DataFrame:
    """Mean recency, frequency and spend, customers and revenue per segment."""
    return rfm.groupBy("customer_segment").agg(
        mean_of("days_passed").alias("avg_recency"),
        mean_of("num_purchases_last_24_months").alias("avg_frequency"),
        safe_ratio(F.sum(F.col("total_cost_per_user").cast("decimal(38,4)")),
                   F.count("total_cost_per_user")).alias("avg_monetary"),
        F.count("user_id").alias("customer_count"),
        money_sum("total_cost_per_user").alias("total_revenue"))


def scatter(rfm: DataFrame) -> DataFrame:
    """The columns of the RFM scatter."""
    return rfm.select("days_passed", "num_purchases_last_24_months", "total_cost_per_user",
                      "customer_segment", "user_id")


def sample(rfm: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """A repeatable ``n``-row sample (first user ids)."""
    return rfm.orderBy("user_id").limit(n)
