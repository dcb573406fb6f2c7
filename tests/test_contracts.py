"""Failures, odd inputs and heavy ties: what the jobs promise beyond the plain runs."""

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from orderlens import catalog, schemas
from orderlens.functions import numeric
from orderlens.insights import programs as iprog
from orderlens.operators import conform, ranking
from orderlens.plans import programs
from orderlens.plans.runner import run_reports
from orderlens.session import scratch_path
from orderlens.sources import landing, results, testdata
from orderlens.streaming import incremental

SF = "/root/testdata/sf0.001"


# --- ranking ---------------------------------------------------------------------
@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_one_value_over_many_slices_keeps_its_rank(spark, parts):
    df = spark.range(3000).select(F.col("id").alias("k"), F.expr(
        "case when id % 3 = 0 then null when id < 2500 then 5 else id % 4 end").alias("v"))
    got = ranking.with_rank(df, "v", [F.col("v").asc_nulls_last(), F.col("k")], "r", partitions=parts)
    want = df.select("k", F.rank().over(Window.orderBy(F.col("v").asc_nulls_last())).alias("r"))
    assert sorted(map(tuple, got.select("k", "r").collect())) == sorted(map(tuple, want.collect()))


def test_ranked_value_is_never_a_shuffle_key(spark):
    df = spark.range(1000).selectExpr("id AS user_id", "id % 3 AS v")
    plan = ranking.with_percent_rank(df, "v", [F.col("v"), F.col("user_id")])._jdf.queryExecution().toString()
    assert "hashpartitioning(v" not in plan


# --- landing ---------------------------------------------------------------------
def test_typed_landing_extra_and_missing_columns(spark):
    path = scratch_path(spark, "landing")
    items = testdata.order_items_typed(spark, SF)  # timestamps, numbers
    items.write.parquet(f"{path}/order_items")
    testdata.order_item_options_source(spark, SF).write.parquet(f"{path}/order_item_options")
    testdata.date_dim_typed(spark, SF).withColumn("week", F.lit(7)).write.parquet(f"{path}/date_dim")
    got = landing.load_landing(spark, path)
    text = testdata.order_items_source(spark, SF)
    cols = schemas.ORDER_ITEMS.fieldNames()
    want = landing.conform_to(text, schemas.ORDER_ITEMS)
    assert got["order_items"].select(cols).exceptAll(want.select(cols)).count() == 0
    assert conform.dim_date(got["date_dim"]).select("date_key", "week").filter("date_key is null or week <> 7").count() == 0
    items.drop("user_id").write.mode("overwrite").parquet(f"{path}/order_items")
    with pytest.raises(ValueError, match="user_id"):
        landing.load_landing(spark, path)


# --- incremental -------------------------------------------------------------------
def two_batches(spark):
    src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
    early = F.col("creation_time_utc") <= catalog.INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")
    catalog._write_test_landing(spark, SF, src, early)
    incremental.run_batch(spark, src, out, mark)
    catalog._write_test_landing(spark, SF, src, ~early, rest=False)
    incremental.run_batch(spark, src, out, mark)
    return src, out, mark


def test_an_unreadable_mark_is_an_error_not_a_first_run(spark):
    src, out, mark = two_batches(spark)
    n = incremental.read_curated(spark, out, "fact_items").count()
    spark.createDataFrame([("not a mark",)], "other string").write.mode("overwrite").json(mark)
    with pytest.raises(ValueError):
        incremental.run_batch(spark, src, out, mark)
    assert incremental.read_curated(spark, out, "fact_items").count() == n
    assert incremental.read_mark(spark, mark + "-never") is None


def test_a_crash_in_the_dimension_write_keeps_app_ids(spark):
    src, out, mark = two_batches(spark)
    ids = {r["app_name"]: r["app_id"] for r in incremental.read_curated(spark, out, "dim_app").collect()}
    last = incremental.read_mark(spark, mark)
    # a later batch that stopped halfway left an empty copy of the dimension
    token = last.strftime("%Y%m%dT%H%M%S%f")
    spark.createDataFrame([], "app_id int, app_name string").write.parquet(f"{out}/dim_app/batch={token}")
    late = testdata.order_items_source(spark, SF).limit(3).withColumns(
        {"app_name": F.lit("0-NEW"), "creation_time_utc": F.lit("2030-01-01T00:00:00.000Z")})
    landing.write_landing({"order_items": late}, src, mode="append")
    incremental.run_batch(spark, src, out, mark)
    now = {r["app_name"]: r["app_id"] for r in incremental.read_curated(spark, out, "dim_app").collect()}
    assert now == {**ids, "0-NEW": max(ids.values()) + 1}


def test_new_rows_are_filtered_on_the_scan(spark):
    path = scratch_path(spark, "landing")
    catalog._write_test_landing(spark, SF, path)
    raw = landing.load_table(spark, path, "order_items")
    df = incremental.new_rows(conform.conform_orders(incremental.newer_text(raw, catalog.INCREMENT_MARK)),
                              catalog.INCREMENT_MARK)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(creation_time_utc,2001-06-01T00:00:00.000Z)" in plan.replace(" ", "")


def test_orders_split_over_micro_batches_count_once(spark):
    got = catalog.q_incremental_stream("fact_orders")(spark, SF)
    assert got.count() == got.select("order_id").distinct().count()
    assert catalog.q_incremental_stream("date_dim")(spark, SF).groupBy("date_key").count().filter("count > 1").count() == 0


# --- numbers -----------------------------------------------------------------------
def test_large_prices_and_totals_are_exact_and_never_raise(spark):
    rows = [("1", "2000000000", "9999999999.00"), ("2", "1", "12345678901.00"), ("3", "3", "1.2345"),
            ("4", "2147483647", "9999999999999999.9999"), ("5", "x", "1"), ("6", "1", "99999999999999999999999")]
    df = spark.createDataFrame(rows, "order_id string, item_quantity string, item_price string").selectExpr(
        "*", "'1' AS lineitem_id", "'c' AS item_category", "'n' AS item_name")
    got = {r["order_id"]: r["item_total"] for r in conform.fact_items(df).collect()}
    assert str(got["1"]) == "19999999998000000000.0000" and str(got["2"]) == "12345678901.0000"
    assert str(got["3"]) == "3.7035" and got["4"] is not None and got["5"] is None and got["6"] is None


def test_loyalty_table_keeps_the_group_without_flag(spark):
    rows = [("a", "1", True, 4.0), ("b", "2", False, 2.0), ("c", "3", None, 3.0)]
    totals = spark.createDataFrame(rows, "user_id string, order_id string, is_loyalty boolean, t double").selectExpr(
        "*", "cast(t AS decimal(38,4)) AS order_total")
    table = {r["metric"]: r for r in iprog.loyalty_table(programs.loyalty(totals, with_flag=True)).collect()}
    row = table["Avg. Order Value ($)"]
    assert (row["Loyalty Customers"], row["Non-Loyalty Customers"], row["Non-Loyalty Customers (no flag)"]) == (4.0, 2.0, 3.0)


def test_mean_of_means_is_not_rounded(spark):
    totals = spark.createDataFrame([("a", str(i), True, x) for i, x in enumerate((1, 1, 2))],
                                   "user_id string, order_id string, is_loyalty boolean, x int").selectExpr(
        "*", "cast(x AS decimal(38,4)) AS order_total")
    assert programs.loyalty(totals).first()["avg_order_value"] == pytest.approx(4 / 3, abs=1e-12)
    assert numeric.money_out(F.lit(1)) is not None


# --- reports -----------------------------------------------------------------------
def star_tables(spark):
    s = testdata.star(spark, SF)
    return {"fact_orders": s.fact_orders, "fact_items": s.fact_items, "fact_items_options": s.fact_items_options,
            "date_dim": s.date_dim}


def test_a_bad_options_table_fails_its_own_reports_only(spark):
    tables = star_tables(spark) | {"fact_items_options": spark.createDataFrame([("1",)], "order_id string")}
    got = {r["report"]: r for r in run_reports(spark, tables, scratch_path(spark, "results"), dt.date(2002, 1, 1),
                                               ["clv", "date_detail", "sales_trend"], run_id="r").collect()}
    assert {k: r["state"] for k, r in got.items()} == {"clv": "FAILED", "date_detail": "SUCCEEDED", "sales_trend": "SUCCEEDED"}
    assert got["date_detail"]["rows"] == tables["date_dim"].count()


def test_reports_from_sql_files(spark, tmp_path):
    (tmp_path / "orders_per_user.sql").write_text("SELECT user_id, count(*) AS n FROM fact_orders GROUP BY user_id;\n")
    (tmp_path / "broken.sql").write_text("SELECT nothing FROM nowhere")
    tables = star_tables(spark)
    out = scratch_path(spark, "results")
    got = {r["report"]: r for r in run_reports(spark, tables, out, dt.date(2002, 1, 1), run_id="r",
                                               sql_folder=str(tmp_path)).collect()}
    assert got["orders_per_user"]["state"] == "SUCCEEDED" and got["broken"]["state"] == "FAILED"
    assert got["orders_per_user"]["rows"] == tables["fact_orders"].select("user_id").distinct().count()


def test_latest_result_is_the_latest_finished_run(spark):
    out = scratch_path(spark, "results")
    df = spark.createDataFrame([("a", 1.0)], "location_id string, total_revenue double")
    results.write_result(df, out, "r", "2001")
    df.write.option("header", True).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").csv(
        f"{out}/r/run_id=2002")
    assert results._run_ids(spark, f"{out}/r") == ["2001"]
