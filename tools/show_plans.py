"""Write docs/PLANS.md: the exchanges left in each report's physical plan.

    python tools/show_plans.py [SF_DIR]

The reports run over the curated star with facts bucketed by ``order_id``;
static broadcast is off (as at scale, where no fact table fits) and AQE is
off so the plan shows every exchange it would start with.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderlens.operators.order_totals import order_totals  # noqa: E402
from orderlens.plans import customers, programs, sales  # noqa: E402
from orderlens.session import local_session, scratch_path  # noqa: E402
from orderlens.sources import curated, testdata  # noqa: E402

AS_OF = dt.date(2002, 1, 1)
BUCKETS = 8


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, BUCKETS)
    out = scratch_path(spark, "plans")
    curated.write_star(testdata.star(spark, sf), out, BUCKETS)
    s = curated.read_star(spark, out, BUCKETS)
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def tot(policy="zero_each"):
        return order_totals(s.fact_orders, s.fact_items, s.fact_items_options, policy)

    reports = {
        "R3 churn_profile": lambda: customers.churn(tot("zero_sum"), AS_OF),
        "R4 loyalty_impact": lambda: programs.loyalty(tot()),
        "R5 discount_effect": lambda: programs.discounts(s.fact_orders, s.fact_items, s.fact_items_options),
        "R6 sales_trend": lambda: sales.sales_trend(s.fact_orders, s.fact_items),
        "R2 rfm inputs (before ranking)": lambda: customers.rfm_inputs(tot(), AS_OF),
        "R1 clv (after the stored ranking)": lambda: customers.clv(tot()),
    }
    lines = ["# Physical plans (exchanges only)", "",
             f"Generated by `tools/show_plans.py` on {os.path.basename(sf)}: facts bucketed by `order_id` "
             f"({BUCKETS} buckets), AQE and static broadcast off. "
             "Each line is an exchange (shuffle) left in the plan, top (last) to bottom (first).", ""]
    for name, build in reports.items():
        plan = build()._jdf.queryExecution().executedPlan().toString()
        ex = [re.sub(r"#\d+L?|, \[plan_id=\d+\]", "", line).strip().lstrip(":+- ")
              for line in plan.splitlines() if "Exchange" in line]
        lines += [f"## {name}", ""] + [f"- `{e[:140]}`" for e in ex] + ([""] if ex else ["- (none)", ""])
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
