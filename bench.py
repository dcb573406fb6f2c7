"""Benchmark: the pipeline as it runs in production, timed per step; one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

1. ``etl_star``: the test tables are shaped into the star schema and written
   as Parquet to the curated zone (under the session's checkpoint folder),
   facts bucketed by ``order_id``.
2. Each report runs over the curated tables (declared schemas), executed fully
   with the ``noop`` sink (nothing collected to the driver).
3. ETL transforms ``fact_orders`` (E8) and ``fact_item_options`` (E10) run from
   the source-shaped test tables.
4. ``naive``: the reports' original shapes (global windows in one task; three
   separate period scans) over the same curated tables, for comparison.

One untimed warm-up pass, then the median of ``BENCH_REPEAT`` runs per step.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.catalog import queries  # noqa: E402
from orderlens.operators.order_totals import order_totals  # noqa: E402
from orderlens.plans import customers, programs, sales  # noqa: E402
from orderlens.session import local_session, scratch_path  # noqa: E402
from orderlens.sources import curated, testdata  # noqa: E402
from tools import naive  # noqa: E402

AS_OF = dt.date(2002, 1, 1)


def report_steps(star):
    o, i, x = star.fact_orders, star.fact_items, star.fact_items_options

    def tot(policy="zero_each"):
        return order_totals(o, i, x, policy)

    return {
        "clv": lambda: customers.clv(tot()),
        "rfm_segments": lambda: customers.rfm(tot(), AS_OF),
        "churn_profile": lambda: customers.churn(tot("zero_sum"), AS_OF),
        "loyalty_impact": lambda: programs.loyalty(tot()),
        "discount_effect": lambda: programs.discounts(o, i, x),
        "sales_trend": lambda: sales.sales_trend(o, i),
        "top_locations": lambda: sales.locations(tot()),
        "date_detail": lambda: sales.date_detail(star.date_dim),
    }


def naive_steps(star):
    o, i, x = star.fact_orders, star.fact_items, star.fact_items_options
    return {
        "clv": lambda: naive.clv(order_totals(o, i, x)),
        "rfm_segments": lambda: naive.rfm(order_totals(o, i, x), AS_OF),
        "sales_trend": lambda: naive.sales_trend(o, i),
    }


def timed(fn, repeat):
    fn()  # warm-up
    samples = []
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t)
    return round(statistics.median(samples), 3)


def noop(build):
    return lambda: build().write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), driver_memory="16g")
    out = scratch_path(spark, "bench-curated")

    buckets = max(8, 2 * cpus)  # facts bucketed by order_id: per-order joins need no shuffle
    times = {"etl_star": timed(lambda: curated.write_star(testdata.star(spark, sf), out, buckets), repeat)}
    star = curated.read_star(spark, out, buckets)
    for name, build in report_steps(star).items():
        times[name] = timed(noop(build), repeat)
    qs = queries()
    for name in ("fact_orders", "fact_item_options"):
        times[name] = timed(noop(lambda n=name: qs[n](spark, sf)), repeat)
    naive_times = {name: timed(noop(build), repeat) for name, build in naive_steps(star).items()}

    print(json.dumps({
        "metric": "pipeline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "naive": naive_times,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""), "cpus": cpus, "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
