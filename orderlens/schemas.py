"""Declared schemas of the source, curated and report tables.

The source schemas are what the ETL reads; they are declared so that reads
never infer types. Ids are strings; money is DECIMAL inside the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STR, INT, LONG, DBL, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TS_NTZ = T.DateType(), T.TimestampNTZType()
PRICE = T.DecimalType(20, 4)       # 16 integer digits
ITEM_TOTAL = T.DecimalType(30, 4)  # holds any INT quantity times any PRICE
OPTION_MONEY = T.DecimalType(20, 4)
OPTION_TOTAL = T.DecimalType(30, 4)
OPTION_QTY = T.DecimalType(12, 4)

# --- source (landing zone) --------------------------------------------------
ORDER_ITEMS = _s(
    ("order_id", STR), ("lineitem_id", STR), ("app_name", STR), ("restaurant_id", STR),
    ("user_id", STR), ("printed_card_number", STR), ("is_loyalty", BOOL),
    ("creation_time_utc", STR), ("currency", STR), ("item_category", STR), ("item_name", STR),
    ("item_quantity", STR), ("item_price", STR),
)
ORDER_ITEM_OPTIONS = _s(
    ("order_id", STR), ("lineitem_id", STR), ("option_group_name", STR), ("option_name", STR),
    ("option_quantity", STR), ("option_price", STR),
)
DATE_DIM_SOURCE = _s(("date_key", STR), ("year", STR), ("is_holiday", BOOL))

# --- curated star schema ----------------------------------------------------
DATE_DIM = _s(("date_key", DATE), ("year", INT), ("is_holiday", BOOL))
DIM_APP = _s(("app_id", INT), ("app_name", STR))
FACT_ORDERS = _s(
    ("order_id", STR), ("app_id", INT), ("restaurant_id", STR), ("user_id", STR),
    ("printed_card_number", STR), ("is_loyalty", BOOL), ("creation_time_utc", TS_NTZ),
    ("currency_used", STR),
)
FACT_ITEMS = _s(
    ("lineitem_id", STR), ("order_id", STR), ("item_category", STR), ("item_name", STR),
    ("item_quantity", INT), ("item_price", PRICE), ("item_total", ITEM_TOTAL),
)
FACT_ITEMS_OPTIONS = _s(
    ("lineitem_id", STR), ("order_id", STR), ("option_group_name", STR), ("option_name", STR),
    ("option_quantity", OPTION_QTY), ("option_price", OPTION_MONEY), ("option_total", OPTION_TOTAL),
)

REJECTS = _s(("table_name", STR), ("order_id", STR), ("lineitem_id", STR), ("reason", STR), ("row_text", STR))

# --- report results (CSV outputs; inputs of the dashboard aggregates) -------
CLV = _s(("user_id", STR), ("total_item_cost", DBL), ("total_option_cost", DBL),
         ("total_cost_per_user", DBL), ("clv_percent", DBL), ("clv_tag", STR))
RFM = _s(("user_id", STR), ("total_cost_per_user", DBL), ("days_passed", LONG),
         ("num_purchases_last_24_months", LONG), ("monetary_rank", INT), ("recency_rank", INT),
         ("frequency_rank", INT), ("customer_segment", STR))
CHURN = _s(("user_id", STR), ("last_order_date", DATE), ("days_since_last_order", INT),
           ("avg_days_between_orders", DBL), ("pct_change_last_month", DBL),
           ("activity_status", STR))
LOYALTY = _s(("customer_type", STR), ("avg_spend_per_customer", DBL),
             ("avg_repeat_orders", DBL), ("avg_order_value", DBL))
DISCOUNTS = _s(("order_type", STR), ("total_orders", LONG), ("total_revenue", DBL),
               ("avg_order_value", DBL))
SALES_TREND = _s(("period_type", STR), ("period_start", DATE), ("restaurant_id", STR),
                 ("item_category", STR), ("revenue", DBL))
LOCATIONS = _s(("location_id", STR), ("total_revenue", DBL), ("revenue_rank", INT),
               ("avg_order_value", DBL), ("orders_per_day", DBL), ("orders_per_week", DBL))

REPORT_SCHEMAS = {
    "clv": CLV,
    "rfm": RFM,
    "churn": CHURN,
    "loyalty": LOYALTY,
    "discounts": DISCOUNTS,
    "sales_trend": SALES_TREND,
    "locations": LOCATIONS,
    "date_detail": DATE_DIM,
}


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    present = set(df.columns)
    return [f.name for f in schema.fields if f.name not in present]


def validate(df: DataFrame, schema: T.StructType, name: str = "frame") -> DataFrame:
    """Raise if a declared column is absent; return the frame unchanged."""
    missing = missing_columns(df, schema)
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df
