"""Report results as CSV with a header: writer (E14's sink) and latest-run reader.

Each run of a report writes ``<out>/<report>/run_id=<id>/part-*.csv``. Run ids
sort in time order (``yyyyMMddHHmmss`` plus a suffix), so the latest result is
the largest run id — not the first file listed nor the largest random file
name, which is what the dashboards of the source picked.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlens.schemas import REPORT_SCHEMAS


def new_run_id(now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y%m%d%H%M%S") + "-" + uuid.uuid4().hex[:8]


def write_result(df: DataFrame, out: str, report: str, run_id: str) -> str:
    path = f"{out.rstrip('/')}/{report}/run_id={run_id}"
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def _run_ids(spark: SparkSession, base: str) -> list[str]:
    """Finished runs under ``base``: folders with a ``_SUCCESS`` marker (a listing, no data read)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    runs = [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(p.getName().split("=", 1)[1] for p in runs if p.getName().startswith("run_id=")
                  and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def read_latest(spark: SparkSession, out: str, report: str,
                schema: T.StructType | None = None) -> DataFrame:
    """The latest finished run of ``report`` with its declared schema (no inference)."""
    base = f"{out.rstrip('/')}/{report}"
    runs = _run_ids(spark, base)
    if not runs:
        raise FileNotFoundError(f"no result for {report} under {out}")
    schema = schema or REPORT_SCHEMAS.get(report)
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(f"{base}/run_id={runs[-1]}")
