"""Incremental runs: a rerun without new data adds nothing; a replayed batch replaces itself."""

from pyspark.sql import functions as F

from orderlens import catalog
from orderlens.schemas import FACT_ITEMS
from orderlens.session import scratch_path
from orderlens.streaming import incremental

SF = "/root/testdata/sf0.001"


def early():
    return F.col("creation_time_utc") <= catalog.INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")


def _items(spark, out):
    return spark.read.schema(FACT_ITEMS).parquet(f"{out}/fact_items").count()


def test_batch_rerun_without_new_rows_changes_nothing(spark):
    src, out, mark = (scratch_path(spark, n) for n in ("landing", "curated", "mark"))
    catalog._write_test_landing(spark, SF, src)
    first = incremental.run_batch(spark, src, out, mark)
    n = _items(spark, out)
    again = incremental.run_batch(spark, src, out, mark)
    assert again == first and _items(spark, out) == n
    assert incremental.read_mark(spark, mark) == first


def test_batch_keeps_app_ids_between_runs(spark):
    src, out, mark = (scratch_path(spark, n) for n in ("landing", "curated", "mark"))
    catalog._write_test_landing(spark, SF, src, early())
    incremental.run_batch(spark, src, out, mark)
    ids1 = {r.app_name: r.app_id for r in incremental.read_curated(spark, out, "dim_app").collect()}
    catalog._write_test_landing(spark, SF, src, ~early(), rest=False)
    incremental.run_batch(spark, src, out, mark)
    ids2 = {r.app_name: r.app_id for r in incremental.read_curated(spark, out, "dim_app").collect()}
    assert all(ids2[k] == v for k, v in ids1.items())
    assert len(set(ids2.values())) == len(ids2)


def test_stream_rerun_without_new_files_changes_nothing(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("landing", "curated", "ckpt"))
    catalog._write_test_landing(spark, SF, src)
    incremental.run_incremental(spark, src, out, ckpt)
    n = incremental.read_curated(spark, out, "fact_items").count()
    incremental.run_incremental(spark, src, out, ckpt)
    assert incremental.read_curated(spark, out, "fact_items").count() == n


def test_replayed_batch_overwrites_its_own_folder(spark):
    out = scratch_path(spark, "curated")
    rows = spark.createDataFrame([("1", "o1")], "lineitem_id string, order_id string")
    for _ in range(2):  # foreachBatch may run a batch id twice
        incremental.write_curated({"fact_items": rows}, out, batch_id=7)
    assert spark.read.parquet(f"{out}/fact_items").count() == 1


def test_runner_with_shared_sums_equals_reports(spark):
    """The runner's CSV results (shared per-order sums) equal the reports run on their own."""
    import datetime as dt

    from orderlens.plans.runner import run_reports
    from orderlens.sources import results, testdata
    s = testdata.star(spark, SF)
    tables = {"fact_orders": s.fact_orders, "fact_items": s.fact_items,
              "fact_items_options": s.fact_items_options, "date_dim": s.date_dim}
    out = scratch_path(spark, "results")
    status = run_reports(spark, tables, out, dt.date(2002, 1, 1), ["churn", "discounts", "rfm"])
    assert {r.state for r in status.collect()} == {"SUCCEEDED"}
    for name, direct in (("churn", catalog.q_churn), ("discounts", catalog.q_discounts), ("rfm", catalog.q_rfm)):
        got = sorted(map(tuple, results.read_latest(spark, out, name).collect()), key=repr)
        want = sorted(map(tuple, direct(spark, SF).collect()), key=repr)
        assert got == want, name


def test_batch_runs_append_into_buckets(spark):
    """Two batch runs into the bucketed layout = one full run; reports read it shuffle-free."""
    from orderlens.sources import curated
    src, out, mark = (scratch_path(spark, n) for n in ("landing", "curated", "mark"))
    catalog._write_test_landing(spark, SF, src, early())
    incremental.run_batch(spark, src, out, mark, buckets=4)
    catalog._write_test_landing(spark, SF, src, ~early(), rest=False)
    incremental.run_batch(spark, src, out, mark, buckets=4)
    star = curated.read_star(spark, out, buckets=4)
    full = catalog.q_fact_items(spark, SF)
    assert star.fact_items.count() == full.count()
    plan = star.fact_items.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_batch_rerun_after_failure_before_mark_loads_nothing_twice(spark):
    """A crash after the facts are written but before the mark is stored: the rerun
    rewrites the same batch partition (plain and bucketed layouts)."""
    for buckets in (None, 4):
        src, out, mark = (scratch_path(spark, n) for n in ("landing", "curated", "mark"))
        catalog._write_test_landing(spark, SF, src)
        incremental.run_batch(spark, src, out, mark, buckets=buckets)
        n = incremental.read_curated(spark, out, "fact_items").count() if buckets is None else None
        spark.read.text(mark)  # the mark exists; now simulate its loss
        lost_mark = scratch_path(spark, "mark-lost")
        incremental.run_batch(spark, src, out, lost_mark, buckets=buckets)  # same batch again
        if buckets is None:
            assert incremental.read_curated(spark, out, "fact_items").count() == n
        else:
            from orderlens.sources import curated
            items = curated.read_star(spark, out, buckets).fact_items
            assert items.count() == catalog.q_fact_items(spark, SF).count()


def test_stream_into_buckets_equals_full_run(spark):
    from orderlens.sources import curated
    src, out, ckpt = (scratch_path(spark, n) for n in ("landing", "curated", "ckpt"))
    catalog._write_test_landing(spark, SF, src, early())
    incremental.run_incremental(spark, src, out, ckpt, buckets=4)
    catalog._write_test_landing(spark, SF, src, ~early(), rest=False)
    incremental.run_incremental(spark, src, out, ckpt, buckets=4)
    items = curated.read_star(spark, out, buckets=4).fact_items
    assert items.count() == catalog.q_fact_items(spark, SF).count()
    plan = items.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_bucketed_batches_readable_from_a_fresh_catalog(spark):
    """A later job (empty catalog) registers the batch-partitioned bucketed tables from their folders."""
    from orderlens.sources import curated
    src, out, mark = (scratch_path(spark, n) for n in ("landing", "curated", "mark"))
    catalog._write_test_landing(spark, SF, src)
    incremental.run_batch(spark, src, out, mark, buckets=4)
    n = curated.read_star(spark, out, buckets=4).fact_items.count()
    for name in curated.FACTS:
        spark.sql(f"DROP TABLE {curated.table_name(out, name)}")  # external: the files stay
    star = curated.read_star(spark, out, buckets=4)
    assert star.fact_items.count() == n
    assert "app_id" in star.fact_orders.columns and "batch" not in star.fact_orders.columns
    plan = star.fact_items.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_options_are_settled_in_one_pass_dealt_by_line(spark, monkeypatch):
    """Equal rows, NULLs, loaded options and waiting ones come out right of one stored pass in which
    each side is shuffled once (before: a pass for each of the results, with shuffles by all columns)."""
    text = "order_id string, lineitem_id string, option_group_name string, option_name string, option_quantity string, option_price string"
    options = spark.createDataFrame([
        ("a", "1", "g", None, "1", "2"), ("a", "1", "g", None, "1.0", "2.00"),  # one fact
        ("a", "2", "g", "x", "1", "2"),  # no line yet
        ("a", "2", "g", "x", "1", "2"), ("a", "2", "g", "x", "1.0", "2"),  # texts that wait
        ("b", "1", None, "x", "many", "3"),  # loaded before, with NULLs
        ("b", "1", None, "y", "many", "3"),
        (None, "1", "g", "x", "1", "2")], text)
    items = spark.createDataFrame([("a", "1"), ("a", "1")], "order_id string, lineitem_id string")
    loaded = spark.createDataFrame([("b", "1"), (None, "1")], "order_id string, lineitem_id string")
    passes, real = [], incremental.stored
    there = real(incremental.conform.fact_item_options(options.filter("option_name = 'x' and order_id = 'b'")), "there")
    monkeypatch.setattr(incremental, "stored", lambda df, name: passes.append(df) or real(df, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at scale
    try:
        facts, waiting = incremental.settle_options(options, items, loaded, there)
        plan = passes[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(passes) == 1 and plan.count("Exchange hashpartitioning") == 3
    assert facts.columns == incremental.schemas.FACT_ITEMS_OPTIONS.fieldNames()
    assert sorted(map(str, facts.select("order_id", "option_name", "option_quantity", "option_total").collect())) == [
        "Row(order_id='a', option_name=None, option_quantity=Decimal('1.0000'), option_total=Decimal('2.0000'))",
        "Row(order_id='b', option_name='y', option_quantity=None, option_total=None)"]
    assert sorted(map(tuple, waiting.collect())) == [("a", "2", "g", "x", "1", "2"), ("a", "2", "g", "x", "1.0", "2")]
