"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per work item.

Each builds the curated tables from the test tables in ``sf_dir`` (see
``sources.testdata``) and runs the item on them, over the whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderlens.functions.numeric import money_out
from orderlens.insights import churn as ich
from orderlens.insights import locations as iloc
from orderlens.insights import programs as iprog
from orderlens.insights import segments as iseg
from orderlens.insights import trends as itr
from orderlens.operators import conform, distinct_orders
from orderlens.operators.order_totals import apply_policy, order_totals
from orderlens.operators.ranking import with_ntile, with_percent_rank
from orderlens.plans import customers, order_state, programs, sales
from orderlens.plans.runner import run_reports
from orderlens.session import scratch_path, stored
from orderlens.sources import curated, landing, results, testdata
from orderlens.streaming import incremental

# Fixed parameters of the checked runs (FIXTURES.md §4).
AS_OF = dt.date(2002, 1, 1)
INCREMENT_MARK = dt.datetime(2001, 6, 1)
TREND_PERIOD = "Weekly"
TREND_RESTAURANT = "NATION_3"
LOCATION_METRIC = "orders_per_day"

Query = Callable[[SparkSession, str], DataFrame]


def _totals(spark: SparkSession, sf: str, policy: str = "zero_each") -> DataFrame:
    s = testdata.star(spark, sf)
    return order_totals(s.fact_orders, s.fact_items, s.fact_items_options, policy)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return customers.customer_orders(_totals(spark, sf, "zero_sum"))


# --- reports ------------------------------------------------------------------
def q_order_totals(policy: str) -> Query:
    def run(spark, sf):
        t = _totals(spark, sf, policy)
        return t.select("order_id", "user_id", money_out("item_total").alias("item_total"),
                        money_out("option_total").alias("option_total"),
                        money_out("order_total").alias("order_total"))
    return run


def q_clv(spark, sf):
    return customers.clv(_totals(spark, sf))


def q_rfm(spark, sf):
    return customers.rfm(_totals(spark, sf), AS_OF)


def q_churn(spark, sf):
    return customers.churn(_totals(spark, sf, "zero_sum"), AS_OF)


def q_avg_gap(spark, sf):
    return customers.avg_gap(_orders(spark, sf))


def q_recency(spark, sf):
    return customers.recency(_orders(spark, sf), AS_OF)


def q_monthly_change(spark, sf):
    return customers.monthly_change(_orders(spark, sf))


def q_last_month_change(spark, sf):
    return customers.last_month_change(_orders(spark, sf))


def q_loyalty(spark, sf):
    return programs.loyalty(_totals(spark, sf))


def q_discounts(spark, sf):
    s = testdata.star(spark, sf)
    return programs.discounts(s.fact_orders, s.fact_items, s.fact_items_options)


def q_sales_trend(spark, sf):
    s = testdata.star(spark, sf)
    return sales.sales_trend(s.fact_orders, s.fact_items)


def q_revenue_by(grain: str) -> Query:
    def run(spark, sf):
        s = testdata.star(spark, sf)
        return sales.revenue_by(s.fact_orders, s.fact_items, grain)
    return run


def q_locations(spark, sf):
    return sales.locations(_totals(spark, sf))


def q_date_detail(spark, sf):
    return sales.date_detail(testdata.star(spark, sf).date_dim)


# --- global ranking -------------------------------------------------------------
def _per_user(spark, sf):
    t = _totals(spark, sf)
    return t.groupBy("user_id").agg(F.sum("order_total").alias("total"),
                                    F.count(F.lit(1)).alias("orders"))


def q_percent_rank(spark, sf):
    ranked = with_percent_rank(_per_user(spark, sf), "total",
                               [F.col("total").asc_nulls_last(), F.col("user_id").asc()])
    return ranked.select("user_id", money_out("total").alias("total"), "percent_rank")


def q_ntile(spark, sf):
    ranked = with_ntile(_per_user(spark, sf), 5, [F.col("orders").desc(), F.col("user_id").asc()])
    return ranked.select("user_id", "orders", "ntile")


# --- ETL ------------------------------------------------------------------------
def _conformed(spark, sf):
    return conform.conform_orders(testdata.order_items_source(spark, sf))


def q_conform_orders(spark, sf):
    return _conformed(spark, sf)


def _batch(spark, sf):
    return incremental.new_rows(_conformed(spark, sf), INCREMENT_MARK)


def q_incremental_orders(spark, sf):
    return _batch(spark, sf)


def q_incremental_options(spark, sf):
    return incremental.related_options(testdata.order_item_options_source(spark, sf), _batch(spark, sf))


def q_dim_date(spark, sf):
    return conform.dim_date(testdata.date_dim_source(spark, sf))


def q_dim_app(spark, sf):
    return conform.dim_app(_conformed(spark, sf))


def q_fact_orders(spark, sf):
    items = _conformed(spark, sf)
    return conform.fact_orders(items, conform.dim_app(items))


def q_fact_items(spark, sf):
    return conform.fact_items(_conformed(spark, sf))


def q_fact_item_options(spark, sf):
    return conform.fact_item_options(testdata.order_item_options_source(spark, sf))


def q_high_water_mark(spark, sf):
    return incremental.high_water_mark(_batch(spark, sf))


# --- sources, sinks, incremental runs (E2, E11, E13-E15) -------------------------
def _dates_with_week(spark, sf):
    """The date source with a column that no schema declares: it must come through."""
    d = testdata.date_dim_source(spark, sf)
    return d.withColumn("week", F.weekofyear(F.to_date("date_key", "dd-MM-yyyy")))


def _write_test_landing(spark, sf, path, part: Column | None = None, rest: bool = True):
    """Source-shaped test tables into a landing folder; ``part`` picks the order lines of this run."""
    items = testdata.order_items_source(spark, sf)
    landing.write_landing({"order_items": items if part is None else items.filter(part)}, path, mode="append")
    if rest:
        landing.write_landing({"order_item_options": testdata.order_item_options_source(spark, sf),
                               "date_dim": _dates_with_week(spark, sf)}, path)


def q_load_landing(table: str) -> Query:
    def run(spark, sf):
        path = scratch_path(spark, "landing")
        _write_test_landing(spark, sf, path)
        return landing.load_landing(spark, path)[table]
    return run


def _run_result(spark, out: str, table: str) -> DataFrame:
    """A table of an incremental run, or the lifetime values over it."""
    if table != "clv":
        return incremental.read_curated(spark, out, table)
    facts = [incremental.read_curated(spark, out, t) for t in ("fact_orders", "fact_items", "fact_items_options")]
    return customers.clv(order_totals(*facts))


def q_incremental_batch(table: str) -> Query:
    """Two batch runs with a stored mark (rows up to the mark, then the rest) = one full run."""
    def run(spark, sf):
        src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
        early = F.col("creation_time_utc") <= INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")
        _write_test_landing(spark, sf, src, early)
        incremental.run_batch(spark, src, out, mark)
        _write_test_landing(spark, sf, src, ~early, rest=False)
        incremental.run_batch(spark, src, out, mark)
        return _run_result(spark, out, table)
    return run


def q_incremental_stream(table: str) -> Query:
    """The stream run twice as files arrive, the lines of an order in both = one full run."""
    def run(spark, sf):
        src, out, ckpt = (scratch_path(spark, x) for x in ("landing", "curated", "stream-checkpoint"))
        odd = F.col("lineitem_id").cast("int") % 2 == 1
        _write_test_landing(spark, sf, src, odd)
        incremental.run_incremental(spark, src, out, ckpt)
        _write_test_landing(spark, sf, src, ~odd, rest=False)
        incremental.run_incremental(spark, src, out, ckpt)
        return _run_result(spark, out, table)
    return run


class _Killed(Exception):
    """Stands for a lost driver in the checked runs."""


def _kill_after(table: str):
    def stop(written: str) -> None:
        if written == table:
            raise _Killed(written)
    return stop


def q_batch_killed(table: str, after: str, resume: bool) -> Query:
    """A second batch run dies right after it has written the table ``after``: readers stay on the
    first batch; with ``resume`` a further run loads what the dead one did not commit."""
    def run(spark, sf):
        src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
        early = F.col("creation_time_utc") <= INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")
        _write_test_landing(spark, sf, src, early)
        incremental.run_batch(spark, src, out, mark)
        _write_test_landing(spark, sf, src, ~early, rest=False)
        try:
            incremental.run_batch(spark, src, out, mark, on_write=_kill_after(after))
        except _Killed:
            pass
        if resume:
            incremental.run_batch(spark, src, out, mark)
        return _run_result(spark, out, table)
    return run


# arrival of the options of a line: by the hash of its order, on three days
OPTION_DAYS = (dt.date(2001, 6, 1), dt.date(2001, 6, 2), dt.date(2001, 6, 3))


def q_late_options(job: str, table: str) -> Query:
    """Options landed day by day before, with and after their lines, the last ones with no line
    at all: three runs = one full load."""
    def run(spark, sf):
        src, out, state = (scratch_path(spark, x) for x in ("landing", "curated", "state"))
        start = incremental.run_batch if job == "batch" else incremental.run_incremental
        options = testdata.order_item_options_source(spark, sf)
        landing.write_landing({"date_dim": _dates_with_week(spark, sf)}, src)
        early = F.col("creation_time_utc") <= INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")
        for i, (day, lines) in enumerate(zip(OPTION_DAYS, (early, ~early, None), strict=True)):
            if lines is not None:
                _write_test_landing(spark, sf, src, lines, rest=False)
            part = F.pmod(F.xxhash64("order_id", "option_group_name"), F.lit(len(OPTION_DAYS))) == i
            landing.write_landing({"order_item_options": options.filter(part)}, src, ingest_date=day)
            start(spark, src, out, state)
        return _run_result(spark, out, table)
    return run


def _spoiled(items: DataFrame, options: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landing rows with text that does not parse, by order number."""
    key = F.col("order_id").cast("long")
    items = items.withColumns({
        "item_quantity": F.when(key % 50 == 0, F.lit("many")).otherwise(F.col("item_quantity").cast("string")),
        "item_price": F.when(key % 60 == 0, F.lit("1,5")).otherwise(F.col("item_price").cast("string")),
        "creation_time_utc": F.when(key % 70 == 0, F.lit("yesterday")).otherwise(F.col("creation_time_utc"))})
    price = F.when(key % 90 == 0, F.lit("free")).otherwise(F.col("option_price").cast("string"))
    return items, options.withColumn("option_price", price)


def _order_bitmaps(spark, sf):
    """Bitmaps per location and day of two batches of orders: numbered, built and merged as they come."""
    orders = testdata.star(spark, sf).fact_orders
    early = F.col("creation_time_utc") <= F.lit(INCREMENT_MARK).cast("timestamp_ntz")
    keys, numbers, parts = ["restaurant_id"], None, []
    for part in (orders.filter(early), orders.filter(~early)):
        numbers = stored(distinct_orders.number_orders(part, numbers), "order_numbers")
        parts.append(stored(distinct_orders.day_bitmaps(part, numbers, keys), "day_bitmaps"))
    return distinct_orders.merged(parts, keys)


def q_distinct_orders(spark, sf):
    """Distinct orders of each location from a year before the mark to a month after it."""
    day = INCREMENT_MARK.date()
    return distinct_orders.count_orders(_order_bitmaps(spark, sf), ["restaurant_id"], day - dt.timedelta(days=365),
                                        day + dt.timedelta(days=30))


def q_distinct_orders_monthly(spark, sf):
    """Distinct orders of each location and month, added up from days."""
    month = F.trunc("day", "month").alias("month")
    return distinct_orders.count_orders(_order_bitmaps(spark, sf), ["restaurant_id", month])


def q_rejects(table: str, on_bad: str) -> Query:
    """Landed rows that do not parse, found by two batch runs; or the facts without them."""
    def run(spark, sf):
        src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
        items, options = _spoiled(testdata.order_items_source(spark, sf), testdata.order_item_options_source(spark, sf))
        landing.write_landing({"date_dim": _dates_with_week(spark, sf), "order_item_options": options}, src)
        early = F.col("creation_time_utc") <= INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")
        for part in (early, ~early):
            landing.write_landing({"order_items": items.filter(part)}, src, mode="append")
            incremental.run_batch(spark, src, out, mark, on_bad=on_bad)
        found = incremental.read_curated(spark, out, table)
        return found.drop("row_text")
    return run


def q_order_state(report: Callable[[DataFrame], DataFrame], policy: str, flag: bool = False) -> Query:
    """A report over the per-order state after three batches, each merged in as it came."""
    def run(spark, sf):
        src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
        at = F.col("creation_time_utc")
        cuts = [INCREMENT_MARK - dt.timedelta(days=d) for d in (400, 0)]
        cuts = [x.strftime("%Y-%m-%dT%H:%M:%S.000Z") for x in cuts]
        parts = [at <= cuts[0], (at > cuts[0]) & (at <= cuts[1]), at > cuts[1]]
        for i, part in enumerate(parts):
            _write_test_landing(spark, sf, src, part, rest=i == 0)
            incremental.run_batch(spark, src, out, mark)
            order_state.refresh(spark, out, buckets=8)
            order_state.vacuum(spark, out)
        return report(apply_policy(order_state.order_sums(spark, out).drop("app_id"), policy, flag))
    return run


def q_compacted(table: str) -> Query:
    """Two batches into the bucketed layout, compacted into one, and read back."""
    def run(spark, sf):
        src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
        buckets = curated.bucket_count(testdata.read_table(spark, sf, "lineitem").count())
        early = F.col("creation_time_utc") <= INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")
        _write_test_landing(spark, sf, src, early)
        incremental.run_batch(spark, src, out, mark, buckets=buckets)
        _write_test_landing(spark, sf, src, ~early, rest=False)
        incremental.run_batch(spark, src, out, mark, buckets=buckets)
        curated.compact(spark, out, buckets)
        return getattr(curated.read_star(spark, out, buckets), table)
    return run


def q_write_curated(table: str) -> Query:
    """The five tables appended to the curated zone (facts by order month), one read back."""
    def run(spark, sf):
        out, items = scratch_path(spark, "curated"), _conformed(spark, sf)
        incremental.write_curated(incremental.transform(items, testdata.order_item_options_source(spark, sf),
                                                        testdata.date_dim_source(spark, sf)), out)
        return spark.read.parquet(f"{out}/{table}").drop("order_month")
    return run


def q_write_bucketed(spark, sf):
    """The star written bucketed by order_id (buckets from the row count), read back."""
    out, star = scratch_path(spark, "curated"), testdata.star(spark, sf)
    buckets = curated.bucket_count(star.fact_items.count())
    curated.write_star(star, out, buckets=buckets)
    return curated.read_star(spark, out, buckets=buckets).fact_items


def _star_tables(spark, sf):
    s = testdata.star(spark, sf)
    return {"fact_orders": s.fact_orders, "fact_items": s.fact_items,
            "fact_items_options": s.fact_items_options, "date_dim": s.date_dim}


def q_run_reports(spark, sf):
    return run_reports(spark, _star_tables(spark, sf), scratch_path(spark, "results"), AS_OF, run_id="checked")


def q_run_reports_at_once(spark, sf):
    """The eight reports four at a time on one shared frame of per-order sums."""
    out = scratch_path(spark, "results")
    return run_reports(spark, _star_tables(spark, sf), out, AS_OF, run_id="checked", at_once=4, time_limit=3600)


def q_read_latest_result(spark, sf):
    """Two runs of the location report; the reader returns the later one."""
    out = scratch_path(spark, "results")
    tables = _star_tables(spark, sf)
    run_reports(spark, tables, out, AS_OF, ["locations"], run_id="20010101000000-a")
    run_reports(spark, tables, out, AS_OF, ["locations"], run_id="20020101000000-b")
    return results.read_latest(spark, out, "locations")


# --- dashboards -----------------------------------------------------------------
def _on(report: Query, fn) -> Query:
    def run(spark, sf):
        return fn(report(spark, sf))
    return run


def _weekly_one(spark, sf):
    return itr.filtered(q_sales_trend(spark, sf), TREND_PERIOD, TREND_RESTAURANT)


def _monthly_all(spark, sf):
    return itr.filtered(q_sales_trend(spark, sf), "Monthly")


def q_normalise_period_start(spark, sf):
    trend = q_sales_trend(spark, sf)
    as_epoch = trend.withColumn("period_start", F.unix_timestamp(F.col("period_start").cast("timestamp")))
    return itr.normalise_period_start(as_epoch)


def q_holidays_in_range(spark, sf):
    return itr.holidays_in_range(_weekly_one(spark, sf), testdata.star(spark, sf).date_dim)


def queries() -> dict[str, Query]:
    return {
        # R0-R8
        "order_totals": q_order_totals("zero_each"),
        "order_totals_zero_sum": q_order_totals("zero_sum"),
        "order_totals_keep_item_null": q_order_totals("keep_item_null"),
        "clv": q_clv,
        "rfm_segments": q_rfm,
        "churn_profile": q_churn,
        "avg_order_gap": q_avg_gap,
        "days_since_last_order": q_recency,
        "monthly_spend_change": q_monthly_change,
        "last_month_change": q_last_month_change,
        "loyalty_impact": q_loyalty,
        "discount_effect": q_discounts,
        "sales_trend": q_sales_trend,
        "daily_revenue": q_revenue_by("day"),
        "weekly_revenue": q_revenue_by("week"),
        "monthly_revenue": q_revenue_by("month"),
        "top_locations": q_locations,
        "date_detail": q_date_detail,
        # G1, G2
        "global_percent_rank": q_percent_rank,
        "global_ntile": q_ntile,
        # E3-E12
        "conform_orders": q_conform_orders,
        "incremental_orders": q_incremental_orders,
        "incremental_options": q_incremental_options,
        "dim_date": q_dim_date,
        "dim_app": q_dim_app,
        "fact_orders": q_fact_orders,
        "fact_items": q_fact_items,
        "fact_item_options": q_fact_item_options,
        "high_water_mark": q_high_water_mark,
        # E2, E11-E15
        "load_landing": q_load_landing("order_items"),
        "load_landing_options": q_load_landing("order_item_options"),
        "load_landing_dates": q_load_landing("date_dim"),
        "write_curated": q_write_curated("fact_items"),
        "write_curated_orders": q_write_curated("fact_orders"),
        "write_bucketed": q_write_bucketed,
        **{f"incremental_{job}{suffix}": q(table)
           for job, q in (("batch", q_incremental_batch), ("stream", q_incremental_stream))
           for suffix, table in (("", "fact_items"), ("_orders", "fact_orders"), ("_options", "fact_items_options"),
                                 ("_apps", "dim_app"), ("_dates", "date_dim"), ("_clv", "clv"))},
        "batch_killed": q_batch_killed("fact_items", "fact_orders", resume=False),
        "batch_killed_orders": q_batch_killed("fact_orders", "fact_items_options", resume=False),
        "batch_resumed": q_batch_killed("fact_items_options", "fact_items", resume=True),
        "batch_resumed_clv": q_batch_killed("clv", "pending_options", resume=True),
        "late_options_batch": q_late_options("batch", "fact_items_options"),
        "late_options_batch_clv": q_late_options("batch", "clv"),
        "late_options_stream": q_late_options("stream", "fact_items_options"),
        "distinct_orders": q_distinct_orders,
        "distinct_orders_monthly": q_distinct_orders_monthly,
        "rejects": q_rejects("rejects", "keep"),
        "rejects_left_out": q_rejects("fact_items", "reject"),
        "state_clv": q_order_state(customers.clv, "zero_each"),
        "state_rfm": q_order_state(lambda t: customers.rfm(t, AS_OF), "zero_each"),
        "state_churn": q_order_state(lambda t: customers.churn(t, AS_OF), "zero_sum"),
        "state_loyalty": q_order_state(programs.loyalty, "zero_each"),
        "state_discounts": q_order_state(programs.discounts_from_totals, "keep_item_null", True),
        "state_locations": q_order_state(sales.locations, "zero_each"),
        "compacted_items": q_compacted("fact_items"),
        "compacted_options": q_compacted("fact_items_options"),
        "run_reports": q_run_reports,
        "run_reports_at_once": q_run_reports_at_once,
        "read_latest_result": q_read_latest_result,
        # D1-D27
        "churn_kpis": _on(q_churn, ich.kpis),
        "churn_status_counts": _on(q_churn, ich.status_counts),
        "churn_status_fallback": _on(q_churn, lambda c: ich.status_fallback(c.drop("activity_status"))),
        "days_histogram": _on(q_churn, ich.days_histogram),
        "churn_risk_profile": _on(q_churn, ich.risk_profile),
        "churn_top20": _on(q_churn, ich.top_rows),
        "segment_counts": _on(q_rfm, iseg.segment_counts),
        "segment_revenue_share": _on(q_rfm, iseg.revenue_share),
        "segment_summary": _on(q_rfm, iseg.segment_summary),
        "rfm_scatter": _on(q_rfm, iseg.scatter),
        "rfm_sample20": _on(q_rfm, iseg.sample),
        "locations_rounded": _on(q_locations, iloc.rounded),
        "top5_locations": _on(q_locations, iloc.top),
        "bottom5_locations": _on(q_locations, iloc.bottom),
        "locations_by_metric": _on(q_locations, lambda d: iloc.by_metric(d, LOCATION_METRIC)),
        "loyalty_table": lambda spark, sf: iprog.loyalty_table(programs.loyalty(_totals(spark, sf), with_flag=True)),
        "discount_totals": _on(q_discounts, iprog.discount_totals),
        "order_type_share": _on(q_discounts, iprog.order_type_share),
        "discount_verdict": _on(q_discounts, iprog.discount_verdict),
        "trend_filter": _weekly_one,
        "trend_options": _on(q_sales_trend, itr.options),
        "trend_kpis": _on(_monthly_all, itr.kpis),
        "revenue_over_time": _on(_monthly_all, itr.revenue_over_time),
        "holidays_in_range": q_holidays_in_range,
        "revenue_by_restaurant": _on(_monthly_all, itr.revenue_by_restaurant),
        "revenue_by_category": _on(_monthly_all, itr.revenue_by_category),
        "trend_latest_first": _on(_weekly_one, itr.latest_first),
        "normalise_period_start": q_normalise_period_start,
    }
