"""Loyalty (D15) and discount (D16-D18) dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.functions.numeric import money_sum, safe_ratio

# The dashboard's metric labels and customer types.
LOYALTY_LABELS = (
    ("avg_spend_per_customer", "Avg. Spend per Customer ($)"),
    ("avg_repeat_orders", "Avg. Repeat Orders"),
    ("avg_order_value", "Avg. Order Value ($)"),
)
CUSTOMER_TYPES = ("Loyalty Customers", "Non-Loyalty Customers")
NO_FLAG = "Non-Loyalty Customers (no flag)"
DISCOUNTED, NOT_DISCOUNTED = "Discounted Order", "Non-Discounted Order"


def loyalty_table(loyalty: DataFrame) -> DataFrame:
    """Metrics rounded to 2, one row per metric, one column per customer type.

    ``loyalty`` is ``loyalty(totals, with_flag=True)``: customers without a flag have the label
    of the non-loyal ones and get a column of their own.
    """
    key = F.when(F.col("is_loyalty").isNull(), NO_FLAG).otherwise(F.col("customer_type"))
    rounded = loyalty.select(key.alias("_key"), *[F.round(c, 2).alias(label) for c, label in LOYALTY_LABELS])
    long = rounded.unpivot("_key", [F.col(f"`{label}`") for _, label in LOYALTY_LABELS], "metric", "value")
    return long.groupBy("metric").pivot("_key", [*CUSTOMER_TYPES, NO_FLAG]).agg(F.first("value"))


def discount_totals(discounts: DataFrame) -> DataFrame:
    """Total revenue, total orders and revenue per order (0 without orders)."""
    t = discounts.agg(money_sum("total_revenue").alias("total_revenue"),
                      F.sum("total_orders").alias("total_orders"))
    return t.select("total_revenue", "total_orders",
                    F.when(F.col("total_orders") > 0,
                           safe_ratio(F.col("total_revenue"), F.col("total_orders")))
                    .otherwise(F.lit(0.0)).alias("avg_order_value"))


def order_type_share(discounts: DataFrame) -> DataFrame:
    """Share of orders per order type (window over the two type rows)."""
    return discounts.select(
        "order_type", "total_orders",
        safe_ratio(F.col("total_orders"), F.sum("total_orders").over(Window.partitionBy()))
        .alias("order_share"))


def discount_verdict(discounts: DataFrame) -> DataFrame:
    """Do discounted orders bring more revenue than the others?"""
    rev = F.col("total_revenue").cast("decimal(38,4)")
    t = discounts.agg(
        F.coalesce(F.sum(F.when(F.col("order_type") == DISCOUNTED, rev)), F.lit(0)).alias("_d"),
        F.coalesce(F.sum(F.when(F.col("order_type") == NOT_DISCOUNTED, rev)), F.lit(0)).alias("_n"))
    return t.select(F.col("_d").cast("double").alias("discounted_revenue"),
                    F.col("_n").cast("double").alias("non_discounted_revenue"),
                    (F.col("_d") > F.col("_n")).alias("discounts_drive_revenue"))
