"""Per-order item and option totals joined onto the order rows.

Items and options are aggregated to one row per order *before* the joins
(partial aggregation map-side; no item x option fan-out). Both aggregates
come out hash-partitioned on ``order_id``, so the two left joins with the
orders reuse that partitioning.

Three NULL policies, as the reports use them:

* ``zero_each``      – missing item / option sums count as 0, then added;
* ``zero_sum``       – added first, a NULL sum becomes 0: an order without
                       options counts as 0 (churn report);
* ``keep_item_null`` – options default to 0, a missing item sum keeps the
                       order total NULL (discount report).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

POLICIES = ("zero_each", "zero_sum", "keep_item_null")


def item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum("item_total").alias("item_total"))


def option_totals(options: DataFrame, discount_flag: bool = False) -> DataFrame:
    aggs = [F.sum("option_total").alias("option_total")]
    if discount_flag:
        aggs.append(F.max(F.when(F.col("option_price") < 0, 1).otherwise(0)).alias("has_discount"))
    return options.groupBy("order_id").agg(*aggs)


def order_sums(orders: DataFrame, items: DataFrame, options: DataFrame) -> DataFrame:
    """Order rows with the raw per-order sums (NULL when absent) and the discount flag.

    The policy-free part of R0: one frame that every report can share.
    """
    return (orders.join(item_totals(items), "order_id", "left")
            .join(option_totals(options, discount_flag=True), "order_id", "left"))


def apply_policy(sums: DataFrame, null_policy: str = "zero_each", discount_flag: bool = False) -> DataFrame:
    """``order_total`` (and coalesced sums) from ``order_sums`` under a NULL policy."""
    if null_policy not in POLICIES:
        raise ValueError(f"null_policy must be one of {POLICIES}")
    item, option = F.col("item_total"), F.col("option_total")
    zero = F.lit(0).cast("decimal(30,4)")
    if null_policy == "zero_each":
        item, option = F.coalesce(item, zero), F.coalesce(option, zero)
        total = item + option
    elif null_policy == "zero_sum":
        total = F.coalesce(item + option, zero)
    else:
        option = F.coalesce(option, zero)
        total = item + option
    keep = [c for c in sums.columns if c not in ("item_total", "option_total", "has_discount")]
    cols = [*keep, item.alias("item_total"), option.alias("option_total"), total.alias("order_total")]
    if discount_flag:
        cols.append(F.coalesce(F.col("has_discount"), F.lit(0)).alias("has_discount"))
    return sums.select(*cols)


def order_totals(orders: DataFrame, items: DataFrame, options: DataFrame,
                 null_policy: str = "zero_each", discount_flag: bool = False) -> DataFrame:
    """Order rows with ``item_total``, ``option_total`` and ``order_total`` (DECIMAL)."""
    if null_policy not in POLICIES:
        raise ValueError(f"null_policy must be one of {POLICIES}")
    joined = (orders.join(item_totals(items), "order_id", "left")
              .join(option_totals(options, discount_flag), "order_id", "left"))
    return apply_policy(joined, null_policy, discount_flag)
