"""The reports' original shapes in Spark, for comparison in the benchmark only.

* R1/R2 with native windows without a partition key (one task ranks all users);
* R6 as three separate joins and aggregations, unioned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.functions.dates import month_start, order_date, week_start
from orderlens.plans import customers


def clv(totals: DataFrame) -> DataFrame:
    per_user = totals.groupBy("user_id").agg(
        F.sum("item_total").alias("total_item_cost"), F.sum("option_total").alias("total_option_cost"),
        F.sum(F.col("item_total") + F.col("option_total")).alias("total_cost_per_user"))
    pct = F.round(F.percent_rank().over(Window.orderBy("total_cost_per_user")) * 100, 3)
    return per_user.withColumn("clv_percent", pct).orderBy(F.col("total_cost_per_user").desc())


def rfm(totals: DataFrame, as_of: dt.date) -> DataFrame:
    base = customers.rfm_inputs(totals, as_of)
    return base.select(
        "*",
        F.ntile(5).over(Window.orderBy(F.col("total_cost_per_user").desc(), "user_id")).alias("monetary_rank"),
        F.ntile(5).over(Window.orderBy(F.col("days_passed").asc_nulls_last(), "user_id")).alias("recency_rank"),
        F.ntile(5).over(Window.orderBy(F.col("num_purchases_last_24_months").desc(), "user_id"))
        .alias("frequency_rank"))


def sales_trend(orders: DataFrame, items: DataFrame) -> DataFrame:
    def branch(label, period):
        rows = (orders.select("order_id", order_date().alias("order_date"), "restaurant_id")
                .join(items.select("order_id", "item_category", "item_total"), "order_id"))
        return (rows.groupBy(period.alias("period_start"), "restaurant_id", "item_category")
                .agg(F.sum(F.coalesce("item_total", F.lit(0))).alias("revenue"))
                .select(F.lit(label).alias("period_type"), "*"))
    return (branch("Daily", F.col("order_date"))
            .unionByName(branch("Weekly", week_start("order_date")))
            .unionByName(branch("Monthly", month_start("order_date")))
            .orderBy("period_start", "restaurant_id", "item_category"))
