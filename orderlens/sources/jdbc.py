"""Copy source tables from a JDBC database into the landing zone (Parquet).

The source job read each table through one JDBC connection (one task per
table). Here a table can be read in parallel: with a numeric, date or time
partition column, Spark issues ``num_partitions`` range queries; bounds are taken from
the table (a one-row MIN/MAX query) when not given. Connection properties
(user, password) are passed straight to the reader and never printed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources.landing import LANDING_SCHEMAS, conform_to


@dataclass(frozen=True)
class Partitioning:
    column: str
    num_partitions: int
    lower: int | str | None = None  # a date or time as text
    upper: int | str | None = None


def _reader(spark: SparkSession, url: str, props: dict[str, str]):
    r = spark.read.format("jdbc").option("url", url)
    for k, v in props.items():
        r = r.option(k, v)
    return r


def bounds(spark: SparkSession, url: str, table: str, column: str,
           props: dict[str, str]) -> tuple[int | str, int | str] | None:
    """MIN and MAX of ``column``, computed by the database (one row comes back); None if it has no values."""
    q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b"
    return as_bounds(_reader(spark, url, props).option("dbtable", q).load().first())


def as_bounds(row) -> tuple[int | str, int | str] | None:
    """A MIN/MAX row as reader options: whole numbers, or dates and times as text. Other kinds have
    no ranges that Spark could split."""
    if row[0] is None:
        return None
    if isinstance(row[0], dt.datetime):
        return tuple(v.isoformat(sep=" ") for v in row)
    if isinstance(row[0], dt.date):
        return tuple(v.isoformat() for v in row)
    if isinstance(row[0], (int, float, Decimal)):
        return int(row[0] // 1), int(row[1] // 1) + 1
    raise ValueError(f"cannot split by a column of {type(row[0]).__name__}: take a number, a date or a time")


def read_table(spark: SparkSession, url: str, table: str, props: dict[str, str],
               partitioning: Partitioning | None = None) -> DataFrame:
    reader = _reader(spark, url, props).option("dbtable", table)
    if partitioning is not None:
        ends = partitioning.lower, partitioning.upper
        if None in ends:
            ends = bounds(spark, url, table, partitioning.column, props)
        if ends is not None:  # else: no values, one task
            reader = (reader.option("partitionColumn", partitioning.column)
                      .option("lowerBound", str(ends[0])).option("upperBound", str(ends[1]))
                      .option("numPartitions", str(partitioning.num_partitions)))
    return reader.load()


def ingest(spark: SparkSession, url: str, tables: dict[str, str], props: dict[str, str], out: str,
           partitioning: dict[str, Partitioning] | None = None) -> dict[str, str]:
    """Copy every ``{landing_name: source_table}`` to ``out/<landing_name>`` (overwrite).

    Any failure propagates (the job fails, as the source job did).
    Returns the written paths.
    """
    partitioning = partitioning or {}
    written = {}
    for name, table in tables.items():
        df = read_table(spark, url, table, props, partitioning.get(name))
        path = f"{out.rstrip('/')}/{name}"
        if name in LANDING_SCHEMAS:  # what load_landing reads: declared columns in landing types
            df = conform_to(df, LANDING_SCHEMAS[name])
        df.write.mode("overwrite").parquet(path)
        written[name] = path
    return written
