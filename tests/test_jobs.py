"""Jobs end to end, rejects, reports side by side."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from orderlens import catalog, jobs
from orderlens.operators import rejects
from orderlens.plans.runner import run_reports
from orderlens.session import clear_scratch, scratch_path, stored
from orderlens.sources import commits, landing, results, testdata
from orderlens.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_load_and_report_as_programs(spark, capsys):
    src, out, where = (scratch_path(spark, x) for x in ("landing", "curated", "results"))
    catalog._write_test_landing(spark, SF, src)
    assert jobs.main(["load", "--landing", src, "--out", out, "--state", "4"], spark) == 0
    assert commits.snapshot(spark, out).state_of == 4
    assert jobs.main(["report", "--out", out, "--results", where, "--as-of", "2002-01-01", "--report", "clv", "--report",
                      "discounts", "--state", "4"], spark) == 0
    assert capsys.readouterr().out.count("SUCCEEDED") == 2
    want = catalog._run_result(spark, out, "clv")
    assert results.read_latest(spark, where, "clv").count() == want.count()
    assert jobs.main(["report", "--out", out, "--results", where, "--report", "none"], spark) == 1


def test_arguments():
    args = jobs.parser().parse_args(["ingest", "--url", "u", "--properties", "p", "--landing", "l", "--table", "a=dbo.a",
                                     "--partition", "a=id:8"])
    assert jobs._pairs(args.table) == {"a": "dbo.a"} and args.partition == ["a=id:8"]
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["load", "--out", "x"])


def test_rows_that_do_not_parse_have_reasons(spark):
    rows = [("o1", "1", "2020-01-01T00:00:00.000Z", "2", "1.50"), ("o2", "1", "never", "two", "x"),
            (None, "1", None, None, None), ("o3", None, "2020-01-01T00:00:00.000Z", "2.0", ""), ("o4", "1", "", " ", "1e2")]
    df = spark.createDataFrame(rows, "order_id string, lineitem_id string, creation_time_utc string, "
                                     "item_quantity string, item_price string")
    got = {r["order_id"]: r[rejects.REASONS] for r in rejects.flagged(df, "order_items").collect()}
    assert got == {"o1": [], "o2": ["creation_time_utc is not a time", "item_quantity is not a whole number",
                                    "item_price is not a price"], None: ["order_id is missing"],
                   "o3": ["lineitem_id is missing", "item_price is not a price"],
                   "o4": ["creation_time_utc is not a time", "item_quantity is not a whole number"]}


def test_rejects_are_kept_once_and_counted(spark):
    src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
    items, options = catalog._spoiled(testdata.order_items_source(spark, SF), testdata.order_item_options_source(spark, SF))
    landing.write_landing({"order_items": items, "order_item_options": options,
                           "date_dim": testdata.date_dim_source(spark, SF)}, src)
    seen = []
    for _ in range(2):  # the second run reads the options and the bad times again
        incremental.run_batch(spark, src, out, mark, on_rows=seen.append)
    found = incremental.read_curated(spark, out, "rejects")
    n = {r["table_name"]: r["count"] for r in found.groupBy("table_name").count().collect()}
    assert seen[0]["rows"] == items.count() and seen[0]["rejected"] == n["order_items"] and n["order_item_options"] > 0
    assert seen[0]["item_price"] == items.filter("cast(order_id as long) % 60 = 0").count()
    assert '"creation_time_utc":"yesterday"' in found.filter("reason like 'creation%'").first()["row_text"]
    assert len(commits.snapshot(spark, out).batches) == 1
    # kept in the facts, as the source job did
    assert incremental.read_curated(spark, out, "fact_items").count() == items.count()


def test_a_hanging_report_is_cancelled_and_the_others_succeed(spark):
    tables, out = catalog._star_tables(spark, SF), scratch_path(spark, "results")

    @F.udf("long")
    def slow(x):
        time.sleep(0.5)
        return x

    hangs = {"hangs": lambda: spark.range(0, 4000, 1, 2).select(slow("id").alias("id")),
             "fails": lambda: spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))}
    t = time.time()
    # the limit is far above what the others take, and far below the hanging one's 1,000 s
    got = {r["report"]: r for r in run_reports(spark, tables, out, dt.date(2002, 1, 1), ["hangs", "clv", "fails", "loyalty"],
                                               at_once=4, time_limit=90, more=hangs).collect()}
    assert time.time() - t < 400
    assert {k: r["state"] for k, r in got.items()} == {"hangs": "CANCELLED", "clv": "SUCCEEDED", "fails": "FAILED",
                                                       "loyalty": "SUCCEEDED"}
    assert results.read_latest(spark, out, "loyalty").count() == 2
    with pytest.raises(FileNotFoundError):
        results.read_latest(spark, out, "hangs")


def test_sql_reports_leave_no_views(spark, tmp_path):
    (tmp_path / "n.sql").write_text("SELECT count(*) AS n FROM fact_orders;")
    run_reports(spark, catalog._star_tables(spark, SF), scratch_path(spark, "results"), dt.date(2002, 1, 1),
                sql_folder=str(tmp_path))
    assert not [t.name for t in spark.catalog.listTables() if t.name in ("fact_orders", "date_dim")]


def test_scratch_of_the_application_can_be_removed():
    import subprocess
    import sys
    code = ("from orderlens.session import *\nimport os\ns = local_session(1, 1, '1g')\n"
            "stored(s.range(3), 'x')\np = scratch_path(s, 'y').split('/orderlens-scratch')[0].removeprefix('file:')\n"
            "d = p + '/orderlens-scratch/' + s.sparkContext.applicationId\n"
            "assert os.path.isdir(d)\nassert clear_scratch(s) and not os.path.exists(d)\ns.stop()")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=200)
    assert clear_scratch and stored
