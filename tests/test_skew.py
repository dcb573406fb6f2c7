"""Hot keys: rows are never shuffled by user (or location) before partial aggregation.

All anonymous orders belong to one user, ``UNKNOWN``, which may hold a third of
the rows. Each exchange that hash-partitions on ``user_id`` (or on the few
locations) must sit on top of a partial aggregate, so the hot key crosses the
shuffle as at most one row per map task.
"""

import datetime as dt

import pytest

from orderlens.operators.order_totals import order_totals
from orderlens.plans import customers, programs, sales
from orderlens.sources import testdata

SF = "/root/testdata/sf0.001"
AS_OF = dt.date(2002, 1, 1)


def _plans(spark):
    s = testdata.star(spark, SF)
    tot = order_totals(s.fact_orders, s.fact_items, s.fact_items_options)
    zs = order_totals(s.fact_orders, s.fact_items, s.fact_items_options, "zero_sum")
    return {
        "churn": customers.churn(zs, AS_OF, ordered=False),
        "rfm_inputs": customers.rfm_inputs(tot, AS_OF),
        "avg_gap": customers.avg_gap(customers.customer_orders(zs)),
        "loyalty": programs.loyalty(tot),
        "discounts": programs.discounts(s.fact_orders, s.fact_items, s.fact_items_options, ordered=False),
    }


@pytest.mark.parametrize("hot", ["user_id", "location_id", "restaurant_id", "is_loyalty", "has_discount"])
def test_hot_keys_cross_shuffles_pre_aggregated(spark, hot):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the static plan shows every exchange
    try:
        plans = {n: df._jdf.queryExecution().executedPlan().toString() for n, df in _plans(spark).items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    seen = 0
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if f"Exchange hashpartitioning({hot}#" in line:
                seen += 1
                child = lines[i + 1]
                assert "HashAggregate" in child and ("partial_" in child or "merge_" in child or
                                                     "functions=[]" in child), (name, line, child)
    if hot == "user_id":
        assert seen >= 4  # churn, rfm, gap, loyalty all shuffle on the user
