"""The three jobs as programs: ingest, load, report.

    spark-submit -m orderlens.jobs ingest --url URL --properties FILE --landing DIR --table NAME=SOURCE ...
    spark-submit -m orderlens.jobs load   --landing DIR --out DIR [--buckets N] [--stream CHECKPOINT] [--compact]
    spark-submit -m orderlens.jobs report --out DIR --results DIR [--as-of DATE] [--at-once N] [--time-limit S]

Each is a thin front of ``sources.jdbc.ingest``, ``streaming.incremental`` and
``plans.runner.run_reports``; the session comes from the platform (``spark.checkpoint.dir`` on
shared storage). A job that fails ends with an error; ``report`` ends with 1 if a report failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from orderlens.plans import order_state, runner
from orderlens.sources import curated, jdbc
from orderlens.streaming import incremental


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(v.split("=", 1) for v in values)


def ingest(spark: SparkSession, args: argparse.Namespace) -> int:
    with open(args.properties) as f:  # user, password, driver; never printed
        props = json.load(f)
    parts = {}
    for table, spec in _pairs(args.partition).items():
        column, n = spec.rsplit(":", 1)
        parts[table] = jdbc.Partitioning(column, int(n))
    jdbc.ingest(spark, args.url, _pairs(args.table), props, args.landing, parts)
    return 0


def load(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.stream:
        incremental.run_incremental(spark, args.landing, args.out, args.stream, args.buckets, on_bad=args.on_bad)
    else:
        incremental.run_batch(spark, args.landing, args.out, f"{args.out}/_mark", args.buckets, on_bad=args.on_bad)
    if args.state:
        order_state.refresh(spark, args.out, args.state)
    if args.compact:
        curated.compact(spark, args.out, args.buckets)
    return 0


def report(spark: SparkSession, args: argparse.Namespace) -> int:
    star = curated.read_star(spark, args.out, args.buckets)
    tables = {"fact_orders": star.fact_orders, "fact_items": star.fact_items,
              "fact_items_options": star.fact_items_options, "date_dim": star.date_dim}
    if args.state:
        tables["order_sums"] = order_state.order_sums(spark, args.out, order_state.refresh(spark, args.out, args.state))
    done = runner.run_reports(spark, tables, args.results, args.as_of, args.report or None, sql_folder=args.sql_folder,
                              at_once=args.at_once, time_limit=args.time_limit).collect()  # one row a report
    for r in done:
        print(r["report"], r["state"], r["rows"], r["detail"])
    return int(any(r["state"] != "SUCCEEDED" for r in done))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="orderlens.jobs")
    jobs = p.add_subparsers(dest="job", required=True)
    a = jobs.add_parser("ingest")
    a.add_argument("--url", required=True)
    a.add_argument("--properties", required=True, help="JSON file of connection properties")
    a.add_argument("--landing", required=True)
    a.add_argument("--table", action="append", required=True, metavar="NAME=SOURCE")
    a.add_argument("--partition", action="append", default=[], metavar="NAME=COLUMN:N")
    a = jobs.add_parser("load")
    a.add_argument("--landing", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--stream", metavar="CHECKPOINT", help="as a streaming job with this checkpoint")
    a.add_argument("--on-bad", choices=("keep", "reject"), default="keep")
    a.add_argument("--compact", action="store_true")
    a = jobs.add_parser("report")
    a.add_argument("--out", required=True)
    a.add_argument("--results", required=True)
    a.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    a.add_argument("--report", action="append", default=[])
    a.add_argument("--sql-folder")
    a.add_argument("--at-once", type=int, default=1)
    a.add_argument("--time-limit", type=float)
    for name in ("load", "report"):
        jobs.choices[name].add_argument("--buckets", type=int)
        jobs.choices[name].add_argument("--state", type=int, metavar="BUCKETS", help="keep the per-order state")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"orderlens-{args.job}").getOrCreate()
    return {"ingest": ingest, "load": load, "report": report}[args.job](spark, args)


if __name__ == "__main__":
    sys.exit(main())
