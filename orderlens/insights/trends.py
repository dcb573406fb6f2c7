"""Sales-trend dashboard aggregates (D19-D27) on the sales-trend result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from orderlens.functions.numeric import money_sum

ALL = "All"
LABEL_CHARS = 20


def normalise_period_start(trend: DataFrame) -> DataFrame:
    """``period_start`` as TIMESTAMP from epoch seconds, text or a date."""
    t = trend.schema["period_start"].dataType
    c = F.col("period_start")
    if isinstance(t, T.NumericType):
        ts = F.timestamp_seconds(c).cast("timestamp_ntz")
    elif isinstance(t, T.StringType):
        # any ISO form, with a blank or T, with or without time, fraction or zone
        ts = c.try_cast("timestamp_ntz")
    else:
        ts = c.cast("timestamp_ntz")
    return trend.withColumn("period_start", ts)


def filtered(trend: DataFrame, period: str, restaurant: str = ALL, category: str = ALL) -> DataFrame:
    """One period type; optionally one restaurant and one category."""
    out = trend.filter(F.col("period_type") == period)
    if restaurant != ALL:
        out = out.filter(F.col("restaurant_id") == restaurant)
    if category != ALL:
        out = out.filter(F.col("item_category") == category)
    return out


def options(trend: DataFrame) -> DataFrame:
    """The distinct choices of the three selectors, one row per (selector, value)."""
    def distinct(col: str, kind: str) -> DataFrame:
        return trend.select(F.lit(kind).alias("selector"), F.col(col).cast("string").alias("value")).distinct()
    return (distinct("period_type", "period_type")
            .unionByName(distinct("restaurant_id", "restaurant_id"))
            .unionByName(distinct("item_category", "item_category")))


def kpis(rows: DataFrame) -> DataFrame:
    """Revenue, distinct restaurants and distinct categories."""
    return rows.agg(money_sum("revenue").alias("total_revenue"),
                    F.count_distinct("restaurant_id").alias("restaurants"),
                    F.count_distinct("item_category").alias("categories"))


def revenue_over_time(rows: DataFrame) -> DataFrame:
    """Revenue per period start (NULL starts dropped), in time order."""
    return (rows.dropna(subset=["period_start"]).groupBy("period_start")
            .agg(money_sum("revenue").alias("revenue")).orderBy("period_start"))


def holidays_in_range(rows: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Holiday dates between the first and last period start, inclusive.

    The bounds are one-row scalar subqueries; the date dimension is filtered
    against them (no join).
    """
    bounds = rows.agg(F.min("period_start").alias("_lo"), F.max("period_start").alias("_hi"))
    lo, hi = bounds.select("_lo").scalar(), bounds.select("_hi").scalar()
    key = F.col("date_key")
    return (date_dim.filter(F.col("is_holiday") & (key >= lo.cast("date")) & (key <= hi.cast("date")))
            .select("date_key").orderBy("date_key"))


def revenue_by_restaurant(rows: DataFrame) -> DataFrame:
    """Revenue per restaurant (rows without a restaurant are left out)."""
    return (rows.filter(F.col("restaurant_id").isNotNull()).groupBy("restaurant_id")
            .agg(money_sum("revenue").alias("revenue")))


def revenue_by_category(rows: DataFrame, chars: int = LABEL_CHARS) -> DataFrame:
    """Revenue per category, largest first, with a label cut to ``chars`` + '...'."""
    cat = F.col("item_category")
    label = F.when(F.length(cat) > chars, F.concat(F.substring(cat, 1, chars), F.lit("..."))).otherwise(cat)
    return (rows.filter(cat.isNotNull()).groupBy("item_category")
            .agg(money_sum("revenue").alias("revenue"))
            .select("item_category", label.alias("label"), "revenue")
            .orderBy(F.col("revenue").desc(), "item_category"))


def latest_first(rows: DataFrame) -> DataFrame:
    """Rows with the newest period first."""
    return rows.orderBy(F.col("period_start").desc_nulls_last(), "restaurant_id", "item_category")
