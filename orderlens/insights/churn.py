"""Churn dashboard aggregates (D1-D6) on the churn report's result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderlens.functions.numeric import half_up_ratio

AT_RISK_DAYS = 700
HISTOGRAM_BINS = 30
TOP_ROWS = 20


def status_fallback(churn: DataFrame, at_risk_days: int = AT_RISK_DAYS) -> DataFrame:
    """D3: derive ``activity_status`` from the days when the column is absent."""
    if "activity_status" in churn.columns:
        return churn
    return churn.withColumn(
        "activity_status",
        F.when(F.col("days_since_last_order") > at_risk_days, "At Risk").otherwise("Active"))


def kpis(churn: DataFrame) -> DataFrame:
    """Distinct customers, customers at risk, mean days since last order (1 decimal)."""
    churn = status_fallback(churn)
    days = F.col("days_since_last_order")
    return churn.agg(
        F.count_distinct("user_id").alias("total_customers"),
        F.count_if(F.col("activity_status") == "At Risk").alias("at_risk_customers"),
        half_up_ratio(F.sum(days), F.count(days), 1).alias("avg_days_since_last_order"))


def status_counts(churn: DataFrame) -> DataFrame:
    """Customers per status, largest first."""
    return (status_fallback(churn).groupBy(F.col("activity_status").alias("status"))
            .agg(F.count(F.lit(1)).alias("customer_count"))
            .orderBy(F.col("customer_count").desc(), "status"))


def days_histogram(churn: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins of days since last order between its min and max.

    Bin i covers [min + i*w, min + (i+1)*w) with w = (max - min) / bins; the
    last bin is closed. Only non-empty bins are returned. min and max are
    scalar subqueries (one row), not a join.
    """
    days = F.col("days_since_last_order")
    stats = churn.agg(F.min(days).alias("_lo"), F.max(days).alias("_hi"))
    lo = stats.select("_lo").scalar()
    hi = stats.select("_hi").scalar()
    width = (hi - lo).cast("double") / F.lit(float(bins))
    raw = F.floor((days - lo).cast("double") / width)
    index = F.when(width > 0, F.least(raw, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    binned = churn.filter(days.isNotNull()).select(index.alias("bin"))
    return (binned.groupBy("bin").agg(F.count(F.lit(1)).alias("customer_count"))
            .select("bin",
                    (lo.cast("double") + F.col("bin") * width).alias("bin_start"),
                    (lo.cast("double") + (F.col("bin") + 1) * width).alias("bin_end"),
                    "customer_count")
            .orderBy("bin"))


def risk_profile(churn: DataFrame) -> DataFrame:
    """The columns of the churn-risk scatter."""
    return status_fallback(churn).select("avg_days_between_orders", "days_since_last_order",
                                         "activity_status", "user_id")


def top_rows(churn: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    """The first ``n`` rows of the report (most days since last order)."""
    return churn.orderBy(F.col("days_since_last_order").desc_nulls_last(), "user_id").limit(n)
