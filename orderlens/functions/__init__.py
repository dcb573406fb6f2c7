"""Column-level helpers built from ``pyspark.sql.functions`` (JVM side, codegen)."""

from orderlens.functions.dates import (
    days_between, order_date, parse_iso_utc, month_start, week_start, whole_days_to,
    whole_weeks_between,
)
from orderlens.functions.numeric import (
    half_up_ratio, mean_of, money_out, money_sum, round_money, safe_ratio,
)

__all__ = [
    "days_between", "order_date", "parse_iso_utc", "month_start", "week_start",
    "whole_days_to", "whole_weeks_between", "half_up_ratio", "mean_of", "money_out", "money_sum",
    "round_money", "safe_ratio",
]
