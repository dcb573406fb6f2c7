"""Customer reports: lifetime value (R1), RFM segments (R2), churn profile.

Every report takes its reference date ``as_of`` as a parameter (the SQL
service used CURRENT_DATE), so results can be repeated and checked.

Per-user work is one ``groupBy(user_id)`` with partial aggregation: all
anonymous orders share the user ``UNKNOWN`` (a hot key that may hold a third
of the rows), and map-side combining sends it through the shuffle as one row
per map task. Rankings over all users use ``operators.ranking`` instead of a
window without a partition key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from orderlens.functions.dates import date_lit, days_between, month_start, order_date, whole_days_to
from orderlens.functions.numeric import half_up_ratio, money_out
from orderlens.operators.ranking import with_ntiles, with_percent_rank

AT_RISK_DAYS = 700
RFM_MONTHS = 24
NTILES = 5


# --------------------------------------------------------------------------- R1
def clv(totals: DataFrame, ordered: bool = True) -> DataFrame:
    """Spend per user, its percent rank (0..100, 3 decimals) and a tag.

    ``totals`` is ``order_totals(..., null_policy="zero_each")``.
    """
    per_user = totals.groupBy("user_id").agg(
        F.sum("item_total").alias("total_item_cost"),
        F.sum("option_total").alias("total_option_cost"),
        F.sum(F.col("item_total") + F.col("option_total")).alias("total_cost_per_user"))
    ranked = with_percent_rank(
        per_user, "total_cost_per_user",
        [F.col("total_cost_per_user").asc_nulls_last(), F.col("user_id").asc()], "_pr")
    pct = F.round(F.col("_pr") * F.lit(100.0), 3)
    tag = (F.when(F.col("clv_percent") >= 80, "High CLV")
           .when(F.col("clv_percent") >= 20, "Medium CLV").otherwise("Low CLV"))
    out = (ranked.select(
        "user_id",
        money_out("total_item_cost").alias("total_item_cost"),
        money_out("total_option_cost").alias("total_option_cost"),
        money_out("total_cost_per_user").alias("total_cost_per_user"),
        pct.alias("clv_percent"))
        .withColumn("clv_tag", tag))
    if ordered:
        out = out.orderBy(F.col("total_cost_per_user").desc_nulls_last(), "user_id")
    return out


# --------------------------------------------------------------------------- R2
def rfm_inputs(totals: DataFrame, as_of: dt.date, months: int = RFM_MONTHS) -> DataFrame:
    """Monetary (all time), recency (whole days) and frequency (order rows in the window).

    One aggregation replaces the three per-user aggregates and their joins;
    user_id is never NULL in ``fact_orders``, so the inner joins dropped nothing.
    """
    since = F.add_months(date_lit(as_of), -months).cast("timestamp_ntz")
    ts = F.col("creation_time_utc")
    return totals.groupBy("user_id").agg(
        F.sum("order_total").alias("total_cost_per_user"),
        F.max(ts).alias("_last_ts"),
        F.count(F.when(ts >= since, F.lit(1))).alias("num_purchases_last_24_months"),
    ).select(
        "user_id", "total_cost_per_user",
        whole_days_to("_last_ts", as_of).alias("days_passed"),
        "num_purchases_last_24_months")


def rfm(totals: DataFrame, as_of: dt.date, months: int = RFM_MONTHS, k: int = NTILES) -> DataFrame:
    """R2: three NTILE(k) ranks (1 = best) and a segment per user.

    Ties are broken by ``user_id`` so the ranks are repeatable.
    """
    base = rfm_inputs(totals, as_of, months)
    ranked = with_ntiles(base, k, {
        "monetary_rank": -F.col("total_cost_per_user"),
        "recency_rank": F.col("days_passed"),
        "frequency_rank": -F.col("num_purchases_last_24_months"),
    }, "user_id")
    r, f, m = F.col("recency_rank"), F.col("frequency_rank"), F.col("monetary_rank")
    segment = (F.when((r == 1) & (f == 1) & (m == 1), "VIP")
               .when((r == 1) & (f >= 4), "New Customer")
               .when((r >= 4) & (f >= 4), "Churn Risk")
               .otherwise("Other"))
    return ranked.select(
        "user_id", money_out("total_cost_per_user").alias("total_cost_per_user"),
        "days_passed", "num_purchases_last_24_months",
        "monetary_rank", "recency_rank", "frequency_rank", segment.alias("customer_segment"))


# --------------------------------------------------------------------------- R3
def customer_orders(totals: DataFrame) -> DataFrame:
    """Order rows as the churn report sees them (``null_policy="zero_sum"``)."""
    return totals.select("user_id", "order_id", order_date().alias("order_date"), "order_total")


def avg_gap(orders: DataFrame) -> DataFrame:
    """Mean days between a user's consecutive order dates, 2 decimals.

    The mean of consecutive differences of the sorted dates telescopes to
    (last - first) / (count - 1): no per-user window, so the hot ``UNKNOWN``
    user is aggregated map-side like every other. NULL for a single order.
    """
    d = F.col("order_date")
    g = orders.groupBy("user_id").agg(F.max(d).alias("_last"), F.min(d).alias("_first"),
                                      F.count(d).alias("_n"))
    return g.select("user_id", half_up_ratio(days_between("_first", "_last"), F.col("_n") - 1, 2)
                    .alias("avg_days_between_orders"))


def recency(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Last order date and calendar days from it to ``as_of``."""
    g = orders.groupBy("user_id").agg(F.max("order_date").alias("last_order_date"))
    return g.withColumn("days_since_last_order", days_between("last_order_date", date_lit(as_of)))


def _pct_change(cur, prev):
    """round((cur - prev) / prev * 100, 2) in exact decimals; NULL if prev is NULL or < 1."""
    c = cur.try_cast("decimal(24,4)")
    p = prev.try_cast("decimal(24,4)")
    pct = F.round((c - p) * F.lit(100) / p, 2).cast("double")
    return F.when(prev.isNull() | (prev < 1), F.lit(None).cast("double")).otherwise(pct)


def monthly_spend(orders: DataFrame) -> DataFrame:
    return orders.groupBy("user_id", month_start("order_date").alias("month_start")).agg(
        F.sum("order_total").alias("monthly_total"))


def monthly_change(orders: DataFrame) -> DataFrame:
    """Spend per user-month and % change from the user's previous *active* month.

    The window runs over the aggregated user-month rows (a user has at most
    one row per month), not over order rows.
    """
    monthly = monthly_spend(orders)
    w = Window.partitionBy("user_id").orderBy(F.col("month_start").asc_nulls_last())
    prev = F.lag("monthly_total", 1).over(w)
    return monthly.select(
        "user_id", "month_start", money_out("monthly_total").alias("monthly_total"),
        money_out(prev).alias("prev_month_total"),
        _pct_change(F.col("monthly_total"), prev).alias("pct_change_last_month"))


def last_month_change(orders: DataFrame) -> DataFrame:
    """R3d: the % change of the globally latest month only (users active in it)."""
    changes = monthly_change(orders)
    latest = monthly_spend(orders).agg(F.max("month_start")).scalar()
    return changes.filter(F.col("month_start") == latest).select("user_id", "pct_change_last_month")


def churn(totals: DataFrame, as_of: dt.date, at_risk_days: int = AT_RISK_DAYS,
          ordered: bool = True) -> DataFrame:
    """Last order, days since, mean gap, last-month % change, status.

    All per-user columns come from one pass: order rows -> user-month rows
    (shuffle on user and month, partial aggregation) -> user rows. The change
    for the latest month M needs only the user's total in M and in the latest
    month before M, which ``max_by`` picks without a window. M is a scalar
    subquery over the user-month rows.
    """
    orders = customer_orders(totals)
    d = F.col("order_date")
    monthly = orders.groupBy("user_id", month_start(d).alias("month_start")).agg(
        F.sum("order_total").alias("monthly_total"),
        F.max(d).alias("_last"), F.min(d).alias("_first"), F.count(d).alias("_n"))
    latest = monthly.agg(F.max("month_start")).scalar()
    monthly = monthly.withColumn("_latest", latest)  # one subquery, used twice below
    month, total, latest = F.col("month_start"), F.col("monthly_total"), F.col("_latest")
    per_user = monthly.groupBy("user_id").agg(
        F.max("_last").alias("last_order_date"),
        F.min("_first").alias("_first"),
        F.sum("_n").alias("_n"),
        F.max(F.when(month == latest, total)).alias("_cur"),
        F.max_by(total, F.when(month < latest, month)).alias("_prev"),
    )
    days = days_between("last_order_date", date_lit(as_of))
    change = F.when(F.col("_cur").isNotNull(), _pct_change(F.col("_cur"), F.col("_prev")))
    out = per_user.select(
        "user_id", "last_order_date", days.alias("days_since_last_order"),
        half_up_ratio(days_between("_first", "last_order_date"), F.col("_n") - 1, 2)
        .alias("avg_days_between_orders"),
        change.alias("pct_change_last_month"),
    ).withColumn("activity_status",
                 F.when(F.col("days_since_last_order") > at_risk_days, "At Risk").otherwise("Active"))
    if ordered:
        out = out.orderBy(F.col("days_since_last_order").desc_nulls_last(), "user_id")
    return out
