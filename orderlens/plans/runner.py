"""Run every report over the curated tables and write each result as CSV.

The source ran the report files one after another on a hosted SQL service and
polled their state every 2 s. Here each report is a DataFrame job; writing
its result is the action, so there is nothing to poll. One failing report
does not stop the others: its state is FAILED with the whole error text. Reports can
run side by side, with a time limit each. The
per-order sums that six reports start from are computed once, when first
needed, and written to shared storage (lineage cut). Reports may also be
SQL files in a folder.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from orderlens.operators.order_totals import apply_policy, order_sums
from orderlens.plans import customers, programs, sales
from orderlens.session import stored
from orderlens.sources.results import new_run_id, write_result

Report = Callable[[], DataFrame]


def reports(tables: dict[str, DataFrame], as_of: dt.date) -> dict[str, Report]:
    """The eight reports over ``tables`` (fact_orders, fact_items, fact_items_options, date_dim).

    The per-order sums that six of them start from are computed and written to the shared folder
    by the first report that needs them; a failure there is that report's, and the next one tries
    again. A table ``order_sums`` (the state that ``plans.order_state`` keeps) is used as it is.
    """
    shared: list[DataFrame] = [tables["order_sums"]] if "order_sums" in tables else []
    first = threading.Lock()  # reports that run at once wait for the one that computes the sums

    def totals(policy: str = "zero_each", flag: bool = False) -> DataFrame:
        with first:
            if not shared:
                shared.append(stored(order_sums(tables["fact_orders"], tables["fact_items"],
                                                tables["fact_items_options"]), "order_sums"))
        return apply_policy(shared[0], policy, flag)

    return {
        "churn": lambda: customers.churn(totals("zero_sum"), as_of),
        "clv": lambda: customers.clv(totals()),
        "rfm": lambda: customers.rfm(totals(), as_of),
        "date_detail": lambda: sales.date_detail(tables["date_dim"]),
        "loyalty": lambda: programs.loyalty(totals()),
        "discounts": lambda: programs.discounts_from_totals(totals("keep_item_null", True)),
        "sales_trend": lambda: sales.sales_trend(tables["fact_orders"], tables["fact_items"]),
        "locations": lambda: sales.locations(totals()),
    }


def sql_reports(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> dict[str, Report]:
    """One report for each ``.sql`` file of a folder, named after the file; the curated tables are
    temporary views of their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.sql").text(folder).select(
        F.col("_metadata.file_name").alias("file"), "value").collect()  # report texts, a few files
    return {r["file"].removesuffix(".sql"): (lambda q=r["value"]: spark.sql(q.strip().rstrip(";"))) for r in files}


def run_reports(spark: SparkSession, tables: dict[str, DataFrame], out: str, as_of: dt.date,
                names: list[str] | None = None, run_id: str | None = None, sql_folder: str | None = None,
                at_once: int = 1, time_limit: float | None = None,
                more: dict[str, Report] | None = None) -> DataFrame:
    """Run the reports, write ``out/<report>/run_id=<id>/``; return (report, state, rows, detail).

    With ``sql_folder`` the reports are the SQL files of that folder instead of the built-in ones;
    ``more`` adds reports of the caller's own. ``at_once`` reports run side by side, each in a
    scheduler pool of its own (fair shares where the session has spark.scheduler.mode=FAIR) and under
    a job tag; a report that takes longer than ``time_limit`` seconds has its jobs cancelled and ends
    as CANCELLED, the others go on.
    """
    run_id = run_id or new_run_id()
    todo = reports(tables, as_of) if sql_folder is None else sql_reports(spark, tables, sql_folder)
    todo |= more or {}
    sc = spark.sparkContext

    def one(name: str) -> tuple[str, str, int | None, str]:
        tag, late = f"report-{run_id}-{name}", threading.Event()
        over = threading.Timer(time_limit or 0, lambda: (late.set(), sc.cancelJobsWithTag(tag)))
        before = sc.getLocalProperty("spark.scheduler.pool")
        sc.setLocalProperty("spark.scheduler.pool", f"report-{name}" if at_once > 1 else before)
        sc.addJobTag(tag)
        try:
            if time_limit is not None:
                over.start()
            seen = Observation(f"rows-{run_id}-{name}")
            df = todo[name]().observe(seen, F.count(F.lit(1)).alias("rows"))
            if late.is_set():
                raise TimeoutError("cancelled while the report was planned")
            write_result(df, out, name, run_id)
            return name, "SUCCEEDED", seen.get["rows"], run_id
        except Exception as e:  # keep going: one report's failure is its own
            if late.is_set():
                return name, "CANCELLED", None, f"longer than {time_limit:g} s"
            return name, "FAILED", None, f"{type(e).__name__}: {e}"
        finally:
            over.cancel()
            sc.removeJobTag(tag)
            sc.setLocalProperty("spark.scheduler.pool", before)

    names = names or sorted(todo)
    try:
        if at_once == 1:
            status = [one(name) for name in names]
        else:
            with ThreadPoolExecutor(at_once) as pool:
                status = list(pool.map(inheritable_thread_target(spark)(one), names))
    finally:
        for name in tables if sql_folder is not None else ():
            spark.catalog.dropTempView(name)
    return spark.createDataFrame(status, "report string, state string, rows long, detail string")
