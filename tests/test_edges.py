"""Hand-made edge rows that the test-table mapping cannot produce (FIXTURES.md §6)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.insights import churn as ich
from orderlens.insights import trends as itr
from orderlens.operators import conform
from orderlens.operators.order_totals import order_totals
from orderlens.plans import customers, programs, sales
from orderlens.streaming import incremental

D = Decimal
AS_OF = dt.date(2002, 1, 1)

ORDERS_SCHEMA = ("order_id string, restaurant_id string, user_id string, printed_card_number string, "
                 "is_loyalty boolean, creation_time_utc timestamp_ntz, currency_used string")
ITEMS_SCHEMA = "order_id string, item_category string, item_total decimal(18,2)"
OPTIONS_SCHEMA = "order_id string, option_price decimal(18,4), option_total decimal(18,4)"


def ts(s):
    return dt.datetime.fromisoformat(s)


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDERS_SCHEMA)


def items(spark, rows):
    return spark.createDataFrame(rows, ITEMS_SCHEMA)


def options(spark, rows):
    return spark.createDataFrame(rows, OPTIONS_SCHEMA)


# --------------------------------------------------------------------------- E3-E12
def test_e3_parse_iso(spark):
    df = spark.createDataFrame([("2023-01-02T03:04:05.678Z",), ("2023-01-02T03:04:05Z",), ("bad",)],
                               "creation_time_utc string")
    got = [r[0] for r in conform.conform_orders(df).collect()]
    assert got == [dt.datetime(2023, 1, 2, 3, 4, 5, 678000), None, None]


def test_e4_mark_is_strict_and_nulls(spark):
    df = spark.createDataFrame([(ts("2023-01-01 00:00:00"),), (ts("2023-01-02 00:00:00"),), (None,)],
                               "creation_time_utc timestamp_ntz")
    assert incremental.new_rows(df, None).count() == 3
    kept = incremental.new_rows(df, ts("2023-01-01 00:00:00")).collect()
    assert [r[0] for r in kept] == [ts("2023-01-02 00:00:00")]


def test_e6_date_key_and_year(spark):
    df = spark.createDataFrame([("31-12-2023", "2023", False), ("2023-12-31", "abc", True)],
                               "date_key string, year string, is_holiday boolean")
    got = conform.dim_date(df).collect()
    assert got[0].date_key == dt.date(2023, 12, 31) and got[0].year == 2023
    assert got[1].date_key is None and got[1].year is None and got[1].is_holiday is True


def _items_src(spark, rows):
    return spark.createDataFrame(rows, "order_id string, lineitem_id string, app_name string, restaurant_id string, "
                                       "user_id string, printed_card_number string, is_loyalty boolean, "
                                       "creation_time_utc timestamp_ntz, currency string")


def test_e7_e8_null_app_and_stable_ids(spark):
    t = ts("2023-01-01 10:00:00")
    src = _items_src(spark, [("1", "1", None, "R", "u", "1", True, t, "USD"),
                             ("2", "1", "B", "R", None, "2", True, t, "USD"),
                             ("2", "2", "B", "R", None, "2", True, t, "USD")])
    apps = conform.dim_app(src)
    assert sorted((r.app_id, r.app_name) for r in apps.collect()) == [(1, None), (2, "B")]
    facts = conform.fact_orders(src, apps).collect()
    assert [(r.order_id, r.user_id, r.app_id, r.currency_used) for r in facts] == [("2", "UNKNOWN", 2, "USD")]
    # a second run: known names keep their ids, new names continue after the largest
    src2 = _items_src(spark, [("3", "1", "A", "R", "u", "1", True, t, "USD"),
                              ("4", "1", "B", "R", "u", "1", True, t, "USD")])
    apps2 = conform.dim_app(src2, apps)
    assert sorted((r.app_id, r.app_name or "") for r in apps2.collect()) == [(1, ""), (2, "B"), (3, "A")]


def test_e9_casts(spark):
    df = spark.createDataFrame([("1", "1", "c", "n", "2.0", "1.50"), ("1", "2", "c", "n", "x", "1.50")],
                               "lineitem_id string, order_id string, item_category string, item_name string, "
                               "item_quantity string, item_price string")
    got = conform.fact_items(df).orderBy("order_id").collect()
    assert got[0].item_quantity == 2 and got[0].item_total == D("3.00")
    assert got[1].item_quantity is None and got[1].item_total is None


def test_e10_identical_options_collapse(spark):
    row = ("1", "1", "g", "n", "1", "-0.5000")
    df = spark.createDataFrame([row, row], "lineitem_id string, order_id string, option_group_name string, "
                                           "option_name string, option_quantity string, option_price string")
    got = conform.fact_item_options(df).collect()
    assert len(got) == 1 and got[0].option_total == D("-0.5000")


def test_e12_empty_batch_keeps_mark(spark):
    empty = spark.createDataFrame([], "creation_time_utc timestamp_ntz")
    mark = ts("2023-01-01 00:00:00")
    assert incremental.next_mark(empty, mark) == mark
    one = spark.createDataFrame([(ts("2023-02-01 00:00:00"),)], "creation_time_utc timestamp_ntz")
    assert incremental.next_mark(one, mark) == ts("2023-02-01 00:00:00")


# --------------------------------------------------------------------------- R0
def test_r0_two_rows_per_order_both_carry_total(spark):
    t = ts("2023-01-01 10:00:00")
    o = orders(spark, [("1", "R", "u", "1", True, t, "USD"), ("1", "R", "u", "2", True, t, "USD")])
    i = items(spark, [("1", "c", D("5.00")), ("1", "c", D("1.00"))])
    x = options(spark, [])
    got = order_totals(o, i, x).collect()
    assert [r.order_total for r in got] == [D("6.0000"), D("6.0000")]


def test_r0_policies_without_options_or_items(spark):
    t = ts("2023-01-01 10:00:00")
    o = orders(spark, [("1", "R", "u", "1", True, t, "USD"), ("2", "R", "u", "1", True, t, "USD")])
    i = items(spark, [("1", "c", D("5.00"))])
    x = options(spark, [])
    by = {p: {r.order_id: r.order_total for r in order_totals(o, i, x, p).collect()}
          for p in ("zero_each", "zero_sum", "keep_item_null")}
    assert by["zero_each"] == {"1": D("5"), "2": D("0")}
    assert by["zero_sum"] == {"1": D("0"), "2": D("0")}  # no options -> the order counts as 0
    assert by["keep_item_null"] == {"1": D("5"), "2": None}


# --------------------------------------------------------------------------- G1, G2 via R1, R2
def _totals_for(spark, rows):
    """rows: (user, total, timestamp) -> zero_each totals with one order per row."""
    o = orders(spark, [(f"o{k}", "R", u, "1", True, t, "USD") for k, (u, _, t) in enumerate(rows)])
    i = items(spark, [(f"o{k}", "c", D(v)) for k, (_, v, _) in enumerate(rows)])
    return order_totals(o, i, options(spark, []))


def test_g1_single_user_is_low(spark):
    got = customers.clv(_totals_for(spark, [("u", "10.00", ts("2001-01-01 00:00:00"))])).collect()
    assert got[0].clv_percent == 0.0 and got[0].clv_tag == "Low CLV"


def test_g1_thresholds_at_exactly_20_and_80(spark):
    rows = [(f"u{k}", f"{k}.00", ts("2001-01-01 00:00:00")) for k in range(6)]  # ranks 0,20,..,100
    got = {r.user_id: (r.clv_percent, r.clv_tag) for r in customers.clv(_totals_for(spark, rows)).collect()}
    assert got["u1"] == (20.0, "Medium CLV") and got["u4"] == (80.0, "High CLV") and got["u0"][1] == "Low CLV"


def test_g2_fewer_than_five_users_and_ties(spark):
    rows = [(u, "1.00", ts("2001-12-01 00:00:00")) for u in ("a", "b", "c")]
    got = {r.user_id: r.monetary_rank for r in customers.rfm(_totals_for(spark, rows), AS_OF).collect()}
    assert got == {"a": 1, "b": 2, "c": 3}  # ties broken by user id


def test_g2_null_recency_ranks_last(spark):
    rows = [("a", "1.00", None), ("b", "1.00", ts("2001-12-01 00:00:00")), ("c", "1.00", ts("2001-11-01 00:00:00"))]
    got = {r.user_id: (r.days_passed, r.recency_rank) for r in customers.rfm(_totals_for(spark, rows), AS_OF).collect()}
    assert got["a"] == (None, 3) and got["b"][1] == 1 and got["c"][1] == 2


def test_r2_recency_counts_whole_days(spark):
    rows = [("a", "1.00", ts("2001-12-31 12:00:00"))]
    got = customers.rfm(_totals_for(spark, rows), AS_OF).collect()[0]
    assert got.days_passed == 0 and got.num_purchases_last_24_months == 1


# --------------------------------------------------------------------------- R3
def _co(spark, rows):
    """rows: (user, order_id, date, total) -> customer order rows."""
    return spark.createDataFrame(rows, "user_id string, order_id string, order_date date, order_total decimal(38,4)")


def test_r3a_same_day_repeat_is_zero_gap(spark):
    d = dt.date(2001, 5, 1)
    got = customers.avg_gap(_co(spark, [("u", "1", d, D(1)), ("u", "2", d, D(1)), ("v", "3", d, D(1))]))
    res = {r.user_id: r.avg_days_between_orders for r in got.collect()}
    assert res == {"u": 0.0, "v": None}


def test_r3c_previous_month_below_one_and_skipped_month(spark):
    rows = [("u", "1", dt.date(2001, 1, 5), D("0.99")), ("u", "2", dt.date(2001, 2, 5), D("2.00")),
            ("v", "3", dt.date(2001, 1, 5), D("1.00")), ("v", "4", dt.date(2001, 3, 5), D("2.00"))]
    got = {(r.user_id, r.month_start): r.pct_change_last_month
           for r in customers.monthly_change(_co(spark, rows)).collect()}
    assert got[("u", dt.date(2001, 2, 1))] is None
    assert got[("v", dt.date(2001, 3, 1))] == 100.0  # previous *active* month (January)


def test_r3_700_days_active_701_at_risk(spark):
    t700 = dt.datetime.combine(AS_OF - dt.timedelta(days=700), dt.time(9))
    t701 = dt.datetime.combine(AS_OF - dt.timedelta(days=701), dt.time(9))
    o = orders(spark, [("1", "R", "a", "1", True, t700, "USD"), ("2", "R", "b", "1", True, t701, "USD")])
    tot = order_totals(o, items(spark, []), options(spark, []), "zero_sum")
    got = {r.user_id: r.activity_status for r in customers.churn(tot, AS_OF).collect()}
    assert got == {"a": "Active", "b": "At Risk"}


# --------------------------------------------------------------------------- R4, R5
def test_r4_null_flag_is_second_non_loyalty_row(spark):
    t = ts("2001-01-01 00:00:00")
    o = spark.createDataFrame([("1", "R", "a", "1", True, t, "USD"), ("2", "R", "a", "1", None, t, "USD"),
                               ("3", "R", "b", "1", False, t, "USD")], ORDERS_SCHEMA)
    tot = order_totals(o, items(spark, []), options(spark, []))
    got = sorted(r.customer_type for r in programs.loyalty(tot).collect())
    assert got == ["Loyalty Customers", "Non-Loyalty Customers", "Non-Loyalty Customers"]


def test_r5_order_without_items_counted_not_summed(spark):
    t = ts("2001-01-01 00:00:00")
    o = orders(spark, [("1", "R", "a", "1", True, t, "USD"), ("2", "R", "a", "1", True, t, "USD")])
    i = items(spark, [("1", "c", D("10.00"))])
    got = programs.discounts(o, i, options(spark, [])).collect()
    assert len(got) == 1 and got[0].total_orders == 2 and got[0].total_revenue == 10.0
    assert got[0].avg_order_value == 10.0


# --------------------------------------------------------------------------- R7
def _loc_totals(spark, rows):
    o = orders(spark, [(oid, loc, "u", "1", True, t, "USD") for oid, loc, t, _ in rows])
    i = items(spark, [(oid, "c", D(v)) for oid, _, _, v in rows])
    return order_totals(o, i, options(spark, []))


@pytest.mark.parametrize("days,weeks", [(6, 0), (7, 1), (13, 1)])
def test_r7_whole_weeks(spark, days, weeks):
    t0 = ts("2001-01-05 10:00:00")
    rows = [("1", "L", t0, "1.00"), ("2", "L", t0 + dt.timedelta(days=days), "1.00")]
    got = sales.locations(_loc_totals(spark, rows)).collect()[0]
    assert got.orders_per_week == 2 / (weeks + 1)


def test_r7_equal_revenue_same_rank_next_skipped(spark):
    t = ts("2001-01-05 10:00:00")
    rows = [("1", "A", t, "5.00"), ("2", "B", t, "5.00"), ("3", "C", t, "1.00")]
    got = {r.location_id: r.revenue_rank for r in sales.locations(_loc_totals(spark, rows)).collect()}
    assert got == {"A": 1, "B": 1, "C": 3}


def test_r7_no_dates_gives_null_rates(spark):
    rows = [("1", "A", None, "5.00")]
    got = sales.locations(_loc_totals(spark, rows)).collect()[0]
    assert got.orders_per_day is None and got.orders_per_week is None


# --------------------------------------------------------------------------- D items
def test_d25_label_cut_after_20(spark):
    rows = spark.createDataFrame([("M", dt.date(2001, 1, 1), "R", "x" * 20, 1.0),
                                  ("M", dt.date(2001, 1, 1), "R", "y" * 21, 2.0)],
                                 "period_type string, period_start date, restaurant_id string, "
                                 "item_category string, revenue double")
    got = {r.item_category: r.label for r in itr.revenue_by_category(rows).collect()}
    assert got == {"x" * 20: "x" * 20, "y" * 21: "y" * 20 + "..."}


def test_d27_epoch_and_text(spark):
    epoch = spark.createDataFrame([(978307200,)], "period_start long")
    text = spark.createDataFrame([("2001-01-01",)], "period_start string")
    for df in (epoch, text):
        assert itr.normalise_period_start(df).collect()[0][0] == dt.datetime(2001, 1, 1)


def test_d3_fallback_status(spark):
    df = spark.createDataFrame([("a", 700), ("b", 701)], "user_id string, days_since_last_order int")
    got = {r.user_id: r.activity_status for r in ich.status_fallback(df).collect()}
    assert got == {"a": "Active", "b": "At Risk"}


def test_d4_histogram_single_value(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5)], "user_id string, days_since_last_order int")
    got = ich.days_histogram(df).collect()
    assert [(r.bin, r.customer_count) for r in got] == [(0, 2)]


def test_d16_no_orders_gives_zero_mean(spark):
    from orderlens.insights import programs as iprog
    df = spark.createDataFrame([("Discounted Order", 0, None), ("Non-Discounted Order", 0, None)],
                               "order_type string, total_orders long, total_revenue double")
    got = iprog.discount_totals(df).collect()[0]
    assert got.total_orders == 0 and got.avg_order_value == 0.0


def test_d18_verdict(spark):
    from orderlens.insights import programs as iprog
    df = spark.createDataFrame([("Discounted Order", 3, 10.5), ("Non-Discounted Order", 2, 10.25)],
                               "order_type string, total_orders long, total_revenue double")
    got = iprog.discount_verdict(df).collect()[0]
    assert got.discounted_revenue == 10.5 and got.discounts_drive_revenue is True


def test_d22_null_starts_dropped_and_summed(spark):
    rows = spark.createDataFrame([("M", dt.date(2001, 1, 1), "A", "c", 1.25), ("M", dt.date(2001, 1, 1), "B", "c", 2.5),
                                  ("M", None, "A", "c", 9.0)],
                                 "period_type string, period_start date, restaurant_id string, "
                                 "item_category string, revenue double")
    got = [(r.period_start, r.revenue) for r in itr.revenue_over_time(rows).collect()]
    assert got == [(dt.date(2001, 1, 1), 3.75)]


def test_d1_mean_days_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([("a", 1, "Active"), ("b", 2, "Active"), ("c", 2, "Active"), ("d", 2, "Active")],
                               "user_id string, days_since_last_order int, activity_status string")
    got = ich.kpis(df).collect()[0]  # mean 1.75 -> 1.8
    assert got.avg_days_since_last_order == 1.8 and got.total_customers == 4 and got.at_risk_customers == 0
