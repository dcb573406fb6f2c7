"""The landing zone: source tables as Parquet, in the declared source schemas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from orderlens import schemas
from orderlens.functions.dates import DATE_KEY_FORMAT, ISO_UTC_FORMAT
from orderlens.session import CODEC

INGEST_DATE = "ingest_date"  # folder column of options that are landed day by day

LANDING_SCHEMAS = {
    "order_items": schemas.ORDER_ITEMS,
    "order_item_options": schemas.ORDER_ITEM_OPTIONS,
    "date_dim": schemas.DATE_DIM_SOURCE,
}


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns in the declared types (timestamps as ISO text), then all others.

    Raises if a declared column is absent: a missing ``user_id`` must not read as anonymous.
    """
    schemas.validate(df, schema, "landing table")
    declared = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType) and isinstance(df.schema[f.name].dataType,
                                                               (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, ISO_UTC_FORMAT)
        elif isinstance(f.dataType, T.StringType) and isinstance(df.schema[f.name].dataType, T.DateType):
            c = F.date_format(c, DATE_KEY_FORMAT)
        declared.append(c.cast(f.dataType).alias(f.name))
    names = set(schema.fieldNames())
    return df.select(*declared, *[F.col(f"`{x}`") for x in df.columns if x not in names])


def write_landing(tables: dict[str, DataFrame], landing: str, mode: str = "overwrite",
                  ingest_date: dt.date | None = None) -> None:
    """Write landing tables; with ``ingest_date`` into that day's folder of each, so that later
    runs read the days they need and no others."""
    for name, df in tables.items():
        day = "" if ingest_date is None else f"/{INGEST_DATE}={ingest_date.isoformat()}"
        rows = conform_to(df, LANDING_SCHEMAS[name])
        rows.write.mode(mode).parquet(f"{landing.rstrip('/')}/{name}{day}", compression=CODEC)


def load_table(spark: SparkSession, landing: str, name: str) -> DataFrame:
    """One landing table: the files' own schema, checked and conformed, other columns kept."""
    return conform_to(spark.read.parquet(f"{landing.rstrip('/')}/{name}"), LANDING_SCHEMAS[name])


def load_landing(spark: SparkSession, landing: str) -> dict[str, DataFrame]:
    """The landing tables in their declared types; text or typed files alike."""
    return {name: load_table(spark, landing, name) for name in LANDING_SCHEMAS}
