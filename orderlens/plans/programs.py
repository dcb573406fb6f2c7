"""Program reports: loyalty impact (R4) and discount effectiveness."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlens.functions.numeric import money_out, safe_ratio
from orderlens.operators.order_totals import order_totals


def mean(c: str) -> F.Column:
    """AVG as sum / count of the non-NULL values, in DOUBLE (exact sum first)."""
    return safe_ratio(F.sum(c), F.count(c))


# --------------------------------------------------------------------------- R4
def loyalty(totals: DataFrame, with_flag: bool = False) -> DataFrame:
    """Per-customer orders, spend and mean order, averaged per loyalty flag.

    ``totals`` is ``order_totals(..., null_policy="zero_each")``. A user with
    orders under both flags counts in both groups; a NULL flag is its own
    group, labelled Non-Loyalty (``with_flag`` tells it from the other). The distinct count runs on (user, flag,
    order) keys, which spread the hot anonymous user over all partitions.
    The means of the customers are added up as decimals of 12 digits after the
    point, so a group's mean does not depend on the order of summation.
    """
    stats = totals.groupBy("user_id", "is_loyalty").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("order_total").alias("total_spend"),
        F.count("order_total").alias("_n"))
    each = safe_ratio(F.col("total_spend"), F.col("_n")).cast("decimal(38,12)")
    stats = stats.withColumn("_aov", each)
    per_flag = stats.groupBy("is_loyalty").agg(
        mean("total_spend").alias("avg_spend_per_customer"),
        mean("total_orders").alias("avg_repeat_orders"),
        mean("_aov").alias("avg_order_value"))
    label = F.when(F.col("is_loyalty"), "Loyalty Customers").otherwise("Non-Loyalty Customers")
    return per_flag.select(*["is_loyalty"] * with_flag, label.alias("customer_type"), "avg_spend_per_customer",
                           "avg_repeat_orders", "avg_order_value")


# --------------------------------------------------------------------------- R5
def discounts(orders: DataFrame, items: DataFrame, options: DataFrame, ordered: bool = True) -> DataFrame:
    """R5 from the fact tables (see ``discounts_from_totals``)."""
    ot = order_totals(orders, items, options, null_policy="keep_item_null", discount_flag=True)
    return discounts_from_totals(ot, ordered)


def discounts_from_totals(ot: DataFrame, ordered: bool = True) -> DataFrame:
    """Orders with any negative option price vs. the rest.

    Per (order, user, restaurant): item sum kept NULL when the order has no
    items (so its total is NULL and skipped by SUM/AVG but still counted as
    an order). The per-order grouping keys contain ``order_id``, on which the
    joined rows are already hash-partitioned: no extra shuffle.
    ``ot`` is ``order_totals(..., "keep_item_null", discount_flag=True)``.
    """
    per_order = ot.groupBy("order_id", "user_id", "restaurant_id").agg(
        F.sum("order_total").alias("order_total"),
        F.max("has_discount").alias("has_discount"))
    per_flag = per_order.groupBy("has_discount").agg(
        F.count_distinct("order_id").alias("total_orders"),
        money_out(F.sum("order_total")).alias("total_revenue"),
        mean("order_total").alias("avg_order_value"))
    label = F.when(F.col("has_discount") == 1, "Discounted Order").otherwise("Non-Discounted Order")
    out = per_flag.select("has_discount", label.alias("order_type"), "total_orders",
                          "total_revenue", "avg_order_value")
    if ordered:
        out = out.orderBy(F.col("has_discount").desc())
    return out.drop("has_discount")
