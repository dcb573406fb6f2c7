"""Sales reports: revenue trend (R6), location ranking (R7), date detail."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlens.functions.dates import month_start, order_date, week_start, whole_weeks_between
from orderlens.functions.numeric import money_out, safe_ratio
from orderlens.operators.ranking import with_rank

GRAINS = {"day": "Daily", "week": "Weekly", "month": "Monthly"}


# --------------------------------------------------------------------------- R6
def order_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item revenue rows (options excluded) with the order's date and restaurant."""
    o = orders.select("order_id", order_date().alias("order_date"), "restaurant_id")
    i = items.select("order_id", "item_category", "item_total")
    return (o.join(i, "order_id")
            .select("order_date", "restaurant_id", "item_category",
                    F.coalesce(F.col("item_total"), F.lit(0).cast("decimal(30,4)")).alias("revenue")))


def _period(grain: str, d: str = "order_date") -> F.Column:
    if grain == "day":
        return F.col(d)
    if grain == "week":
        return week_start(d)
    if grain == "month":
        return month_start(d)
    raise ValueError(f"grain must be one of {sorted(GRAINS)}")


def daily_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    return order_revenue(orders, items).groupBy("order_date", "restaurant_id", "item_category").agg(
        F.sum("revenue").alias("revenue"))


def revenue_by(orders: DataFrame, items: DataFrame, grain: str) -> DataFrame:
    """R6a-c: revenue per period start (Monday for weeks), restaurant and category."""
    rows = order_revenue(orders, items)
    return (rows.groupBy(_period(grain).alias("period_start"), "restaurant_id", "item_category")
            .agg(money_out(F.sum("revenue")).alias("revenue"))
            .select(F.lit(GRAINS[grain]).alias("period_type"), "period_start", "restaurant_id",
                    "item_category", "revenue"))


def sales_trend(orders: DataFrame, items: DataFrame, ordered: bool = True) -> DataFrame:
    """Daily, weekly and monthly revenue in one table.

    The join and the big aggregation run once, at day grain; weeks and months
    are summed from the daily rows (exact decimal sums, so the roll-up equals
    direct sums). The daily aggregate is shared by the three branches
    (exchange reuse), so the fact tables are read once, not three times.
    """
    daily = daily_revenue(orders, items)

    def roll(grain: str) -> DataFrame:
        return (daily.groupBy(_period(grain).alias("period_start"), "restaurant_id", "item_category")
                .agg(F.sum("revenue").alias("revenue"))
                .select(F.lit(GRAINS[grain]).alias("period_type"), "period_start",
                        "restaurant_id", "item_category", money_out("revenue").alias("revenue")))

    day_rows = daily.select(F.lit("Daily").alias("period_type"), F.col("order_date").alias("period_start"),
                            "restaurant_id", "item_category", money_out("revenue").alias("revenue"))
    out = day_rows.unionByName(roll("week")).unionByName(roll("month"))
    if ordered:
        out = out.orderBy(F.col("period_start").asc_nulls_last(), F.col("restaurant_id").asc_nulls_last(),
                          F.col("item_category").asc_nulls_last(), "period_type")
    return out


# --------------------------------------------------------------------------- R7
def locations(totals: DataFrame, ordered: bool = True) -> DataFrame:
    """Revenue, mean order, orders per active day and per week; revenue rank.

    ``totals`` is ``order_totals(..., null_policy="zero_each")``. The two
    distinct counts are two plain aggregations instead of an Expand:
    (location, order) rows — already partitioned by order id, so grouping them
    needs no shuffle — and (location, day) rows; both shrink to one row per
    location before they meet.
    """
    rows = totals.select(F.col("restaurant_id").alias("location_id"), "order_id",
                         order_date().alias("order_date"), "order_total")
    per_order = rows.groupBy("location_id", "order_id").agg(
        F.sum("order_total").alias("_sum"), F.count("order_total").alias("_cnt"))
    by_orders = per_order.groupBy("location_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("_sum").alias("_revenue"), F.sum("_cnt").alias("_cnt"))
    per_day = rows.select("location_id", "order_date").distinct()
    by_days = per_day.groupBy("location_id").agg(
        F.count("order_date").alias("active_days"),
        F.min("order_date").alias("_first"), F.max("order_date").alias("_last"))
    stats = by_orders.join(by_days, by_orders.location_id.eqNullSafe(by_days.location_id)).select(
        by_orders.location_id, "total_orders", "_revenue", "_cnt", "active_days", "_first", "_last")
    stats = stats.select(
        "location_id", "_revenue",
        money_out("_revenue").alias("total_revenue"),
        safe_ratio(F.col("_revenue"), F.col("_cnt")).alias("avg_order_value"),
        safe_ratio(F.col("total_orders"), F.col("active_days")).alias("orders_per_day"),
        safe_ratio(F.col("total_orders"), whole_weeks_between("_first", "_last") + 1).alias("orders_per_week"))
    # the exact sum is ranked: two sums may meet in one double
    ranked = with_rank(stats, "_revenue",
                       [F.col("_revenue").desc_nulls_last(), F.col("location_id").asc_nulls_last()],
                       "revenue_rank")
    out = ranked.select("location_id", "total_revenue", F.col("revenue_rank").cast("int").alias("revenue_rank"),
                        "avg_order_value", "orders_per_day", "orders_per_week")
    if ordered:
        out = out.orderBy("revenue_rank", F.col("location_id").asc_nulls_last())
    return out


# --------------------------------------------------------------------------- R8
def date_detail(date_dim: DataFrame) -> DataFrame:
    """Every row and column of the date dimension."""
    return date_dim.select("*")
