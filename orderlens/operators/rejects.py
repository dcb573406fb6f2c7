"""Rejects: landing rows whose text does not parse, with the reasons.

The conforming transforms turn bad text into NULL, as the source's runtime did, and a NULL price then
counts as no revenue. ``flagged`` marks such rows as a batch is read, so the job
can count them (``counts``) and keep them in a table of their own (``reject_rows``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderlens.functions.dates import parse_iso_utc
from orderlens.operators.conform import to_decimal, to_int

REASONS = "_reasons"
RAW_TIME = "_raw_time"  # the text of the creation time, which conforming replaces

# what must parse, by landing table: column -> (parsed form, what it should be)
_ITEMS = {
    "creation_time_utc": (lambda: parse_iso_utc("creation_time_utc"), "a time"),
    "item_quantity": (lambda: to_int("item_quantity"), "a whole number"),
    "item_price": (lambda: to_decimal("item_price", 20, 4), "a price"),
}
_OPTIONS = {
    "option_quantity": (lambda: to_decimal("option_quantity", 12, 4), "a number"),
    "option_price": (lambda: to_decimal("option_price", 20, 4), "a price"),
}
CHECKS = {"order_items": _ITEMS, "order_item_options": _OPTIONS}
KEYS = ("order_id", "lineitem_id")


def reasons(table: str) -> Column:
    """Why a row of a landing table does not parse; an empty array if it does. NULL is no bad text,
    but a row without its keys belongs nowhere."""
    found = [F.when(F.col(k).isNull(), F.lit(f"{k} is missing")) for k in KEYS]
    for column, (parsed, kind) in CHECKS[table].items():
        found.append(F.when(F.col(column).isNotNull() & parsed().isNull(), F.lit(f"{column} is not {kind}")))
    # arrays of one reason or none, joined: stays in generated code, where a filter of an array would not
    none = F.array().cast("array<string>")
    each = [F.when(r.isNotNull(), F.array(r)).otherwise(none) for r in found]
    return F.when(F.coalesce(*found).isNotNull(), F.concat(*each)).otherwise(none)


def flagged(df: DataFrame, table: str) -> DataFrame:
    """df with its reasons and, for order lines, the text of the creation time."""
    df = df.withColumn(REASONS, reasons(table))
    return df.withColumn(RAW_TIME, F.col("creation_time_utc")) if table == "order_items" else df


def counts(table: str) -> list[Column]:
    """Aggregates over flagged rows: all, rejected, and each column's."""
    bad = [F.count_if(F.array_contains(REASONS, f"{c} is not {kind}")).alias(c) for c, (_, kind) in CHECKS[table].items()]
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(REASONS) > 0).alias("rejected"), *bad]


def reject_rows(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """table_name, order_id, lineitem_id, reason, row_text (the row as JSON): one row per rejected row."""
    values = [F.col(RAW_TIME).alias(c) if c == "creation_time_utc" and RAW_TIME in df.columns else F.col(c) for c in columns]
    return df.filter(F.size(REASONS) > 0).select(
        F.lit(table).alias("table_name"), *KEYS, F.array_join(REASONS, "; ").alias("reason"),
        F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias("row_text"))


def parsed_rows(df: DataFrame) -> DataFrame:
    """The rows of a flagged frame that parse, without the marks."""
    return df.filter(F.size(REASONS) == 0).drop(REASONS, RAW_TIME)
