"""The bucketed curated layout gives the same results with fewer shuffles."""

import datetime as dt
import math

from orderlens.operators.order_totals import order_totals
from orderlens.plans import customers, programs, sales
from orderlens.session import scratch_path
from orderlens.sources import curated, testdata

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2002, 1, 1)


def _reports(s):
    tot = order_totals(s.fact_orders, s.fact_items, s.fact_items_options)
    return {
        "loyalty": programs.loyalty(tot),
        "churn": customers.churn(order_totals(s.fact_orders, s.fact_items, s.fact_items_options, "zero_sum"), AS_OF),
        "discounts": programs.discounts(s.fact_orders, s.fact_items, s.fact_items_options),
        "trend": sales.sales_trend(s.fact_orders, s.fact_items),
    }


def test_bucketed_layout_same_results_fewer_exchanges(spark):
    star = testdata.star(spark, SF)
    plain, bucketed = scratch_path(spark, "plain"), scratch_path(spark, "bucketed")
    curated.write_star(star, plain)
    curated.write_star(star, bucketed, 8)
    a = _reports(curated.read_star(spark, plain))
    b = _reports(curated.read_star(spark, bucketed, 8))
    for name in a:
        ra, rb = sorted(map(tuple, a[name].collect()), key=repr), sorted(map(tuple, b[name].collect()), key=repr)
        assert len(ra) == len(rb), name
        for x, y in zip(ra, rb):
            assert all(math.isclose(u, v, rel_tol=1e-12) if isinstance(u, float) else u == v
                       for u, v in zip(x, y)), (name, x, y)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at scale: no fact table fits
    try:
        fresh = _reports(curated.read_star(spark, bucketed, 8))["loyalty"]
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # only the per-user and per-flag exchanges after partial aggregation remain
    assert len(exchanges) == 2, exchanges
