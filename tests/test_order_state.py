"""Per-order state: merged deltas equal a full recomputation, and only touched buckets are read and written."""

import datetime as dt
import os
import re
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens import catalog, schemas, session
from orderlens.operators.order_totals import apply_policy, order_sums
from orderlens.plans import order_state
from orderlens.session import scratch_path
from orderlens.sources import commits, curated, landing, testdata
from orderlens.streaming import incremental

SF = "/root/testdata/sf0.001"
BUCKETS = 16


def rows(df):
    return sorted((str(sorted(r.asDict().items())) for r in df.collect()))


def full(spark, out):
    return order_sums(*(incremental.read_curated(spark, out, t) for t in curated.FACTS))


@pytest.fixture(scope="module")
def loaded(spark):
    """Two batches, each merged into the state; the order lines of the second again in part."""
    src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
    early = F.col("creation_time_utc") <= catalog.INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")
    for i, part in enumerate((early, ~early)):
        catalog._write_test_landing(spark, SF, src, part, rest=i == 0)
        incremental.run_batch(spark, src, out, mark)
        order_state.refresh(spark, out, BUCKETS)
    return src, out, mark


def test_state_equals_full_recomputation(spark, loaded):
    _, out, _ = loaded
    got = order_state.order_sums(spark, out)
    want = full(spark, out)
    assert sorted(got.columns) == sorted(want.columns)
    assert {f.name: f.dataType for f in got.schema} == {f.name: f.dataType for f in want.schema}
    assert rows(got) == rows(want)
    for policy, flag in (("zero_each", False), ("zero_sum", False), ("keep_item_null", True)):
        assert rows(apply_policy(got, policy, flag)) == rows(apply_policy(want, policy, flag))


def test_a_batch_of_few_orders_touches_few_buckets(spark, loaded, monkeypatch):
    src, out, mark = loaded
    before = commits.snapshot(spark, out)
    items = testdata.order_items_source(spark, SF)
    one = items.filter("app_name is not null").orderBy("order_id").limit(1)
    late = (one.withColumn("creation_time_utc", F.lit("2030-01-01T00:00:00.000Z"))  # another line of a known order
            .unionByName(one.withColumns({"order_id": F.lit("new"), "creation_time_utc": F.lit("2030-01-02T00:00:00.000Z"),
                                          "item_price": F.lit(None).cast("decimal(20,4)")})))
    landing.write_landing({"order_items": late}, src, mode="append")
    options = testdata.order_item_options_source(spark, SF)
    extra = options.limit(1).withColumns({"order_id": F.lit("new"), "lineitem_id": F.lit(one.first()["lineitem_id"]),
                                          "option_price": F.lit(-2).cast("decimal(20,4)")})
    landing.write_landing({"order_item_options": extra}, src, mode="append")
    incremental.run_batch(spark, src, out, mark)
    assert rows(order_state.order_sums(spark, out)) != rows(full(spark, out))  # behind until refreshed
    read = []
    real = order_state.merge

    def merge(old, new, touched):
        read.extend(old.inputFiles() if old is not None else [])
        return real(old, new, touched)

    monkeypatch.setattr(order_state, "merge", merge)
    after = order_state.refresh(spark, out)
    changed = {b for b in after.state if after.state[b] != before.state.get(b)}
    assert 1 <= len(changed) <= 2 and after.state_of == BUCKETS
    assert {int(re.search(r"bucket=(\d+)", f)[1]) for f in read} <= changed
    assert rows(order_state.order_sums(spark, out)) == rows(full(spark, out))
    new = order_state.order_sums(spark, out).filter("order_id = 'new'").collect()
    assert [(r["item_total"], r["option_total"], r["has_discount"]) for r in new] == [(None, -2, 1)]
    assert order_state.refresh(spark, out).size == after.size  # nothing new, no commit


def test_refreshes_side_by_side_and_dead_ones(spark, loaded):
    src, out, mark = loaded
    seen = commits.snapshot(spark, out)
    # a refresh worked out from an older state, and files that were never committed
    commits.commit_state(spark, out, commits.Snapshot(size=seen.size, state_version="older"), "stale", ["x"], [0, 1], BUCKETS)
    now = commits.snapshot(spark, out)
    assert now.state == seen.state and now.state_loads == seen.state_loads


def test_compaction_leaves_loads_that_the_state_lacks(spark, loaded):
    src, out, mark = loaded
    items = testdata.order_items_source(spark, SF).limit(2)
    landing.write_landing({"order_items": items.withColumn("creation_time_utc", F.lit("2031-01-01T00:00:00.000Z"))},
                          src, mode="append")
    incremental.run_batch(spark, src, out, mark)
    newest = commits.snapshot(spark, out).batches[-1]
    batch = curated.compact(spark, out)
    assert set(commits.snapshot(spark, out).batches) == {batch, newest}
    order_state.refresh(spark, out)
    assert rows(order_state.order_sums(spark, out)) == rows(full(spark, out))
    assert curated.compact(spark, out) and rows(order_state.order_sums(spark, out)) == rows(full(spark, out))


def test_runner_takes_the_state(spark, loaded):
    from orderlens.plans.runner import run_reports
    from orderlens.sources import results
    _, out, _ = loaded
    facts = {t: incremental.read_curated(spark, out, t) for t in curated.FACTS}
    state = {"order_sums": order_state.order_sums(spark, out)}
    names = ["clv", "discounts"]
    got = []
    for tables in (facts, facts | state):
        where = scratch_path(spark, "results")
        assert {r["state"] for r in run_reports(spark, tables, where, dt.date(2002, 1, 1), names).collect()} == {"SUCCEEDED"}
        got.append([rows(results.read_latest(spark, where, n)) for n in names])
    assert got[0] == got[1]


def test_errors_without_log_or_state(spark):
    out = scratch_path(spark, "nothing")
    with pytest.raises(ValueError, match="commit log"):
        order_state.refresh(spark, out)
    commits.begin(spark, out)
    with pytest.raises(FileNotFoundError):
        order_state.order_sums(spark, out)


def test_merge_is_dealt_by_order_and_keeps_rows_without_a_delta(spark):
    """Work spreads over orders however few buckets there are (before: one task a bucket)."""
    def delta(order, items, option):
        orders = spark.createDataFrame([(order, 1, "r", "u", "c", True, dt.datetime(2001, 1, 1), "USD")], schemas.FACT_ORDERS)
        lines = spark.createDataFrame([("1", order, "c", "n", 1, x, x) for x in items], schemas.FACT_ITEMS)
        options = spark.createDataFrame([("1", order, "g", "n", Decimal(1), x, x) for x in option], schemas.FACT_ITEMS_OPTIONS)
        return order_state.deltas(orders, lines, options, 2)

    old = order_state.merge(None, delta("a", [Decimal(3), None], [Decimal(-1)]).unionByName(delta(None, [], [])), 2)
    new = delta("a", [Decimal(4)], [Decimal(-1), Decimal(5)]).unionByName(delta("b", [None], []))
    merged = order_state.merge(old, new, 2)
    got = {r["order_id"]: (len(r["orders"]), r["item_total"], r["option_total"], r["has_discount"], len(r["options"]))
           for r in merged.collect()}
    assert got == {"a": (1, 7, 4, 1, 2), None: (1, None, None, None, 0), "b": (1, None, None, None, 0)}
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(bucket#\d+, \d+\)", plan)


def test_option_sums_come_with_the_delta_and_stay_exact_where_rows_repeat(spark):
    """Sums are plain aggregates (before: arrays added up outside generated code); a row that comes
    twice, in a delta or again in a later one, counts once."""
    def delta(options):
        orders = spark.createDataFrame([], schemas.FACT_ORDERS)
        rows = [("1", o, "g", name, Decimal(1), x, x) for o, name, x in options]
        return order_state.deltas(orders, spark.createDataFrame([], schemas.FACT_ITEMS),
                                  spark.createDataFrame(rows, schemas.FACT_ITEMS_OPTIONS), 2)

    first = delta([("a", "x", Decimal(3)), ("a", "x", Decimal(3)), ("a", "y", Decimal(3)), ("b", "x", None), ("c", "x", Decimal(1))])
    assert {"option_total", "has_discount"} <= set(first.columns)
    merged = order_state.merge(None, first, 2)
    assert "transform" not in merged.select("has_discount")._jdf.queryExecution().optimizedPlan().toString()
    for more in ([("a", "y", Decimal(3)), ("a", "z", Decimal(-1))], [("b", "x", None), ("b", "y", Decimal(2)), ("c", "y", None)]):
        merged = order_state.merge(merged, delta(more), 2)
    got = {r["order_id"]: (r["option_total"], r["has_discount"], len(r["options"])) for r in merged.collect()}
    assert got == {"a": (5, 1, 3), "b": (2, 0, 2), "c": (1, 0, 2)}


def test_a_refresh_leaves_its_state_and_nothing_else(spark, monkeypatch):
    """Scratch output, shuffle files and replaced versions stayed on disk, and each option row
    took a whole digest with its total."""
    src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
    monkeypatch.setattr(order_state, "MERGED_AT_ONCE", 1)  # a merge a bucket
    merges, written, real, kept = [], [], order_state.merge, session.stored
    monkeypatch.setattr(order_state, "merge", lambda *a: merges.append(a[2]) or real(*a))

    def stored(df, name):
        found = kept(df, name)
        written.append(found.inputFiles())
        return found

    for module in (order_state, incremental):
        monkeypatch.setattr(module, "stored", stored)
    early = F.col("creation_time_utc") <= catalog.INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")
    for i, part in enumerate((early, ~early)):
        catalog._write_test_landing(spark, SF, src, part, rest=i == 0)
        incremental.run_batch(spark, src, out, mark)
        order_state.refresh(spark, out, 4)
        assert order_state.vacuum(spark, out) == ([] if i == 0 else [f"version={first}"])
        first = commits.snapshot(spark, out).state_version
    assert merges == [4, 1, 1, 1, 1]  # the first delta has no state to meet and no shuffle
    files = [f.removeprefix("file:").replace("//", "") for some in written for f in some]
    assert files and not any(os.path.exists(f) for f in files)
    assert order_state.vacuum(spark, out) == []
    assert rows(order_state.order_sums(spark, out)) == rows(full(spark, out))
    state = spark.read.parquet(f"{out}/{order_state.NAME}/version={first}")
    assert "options" not in state.columns
    assert {len(k) for r in state.select("keys").collect() for k in r["keys"]} == {16}


def test_state_files_of_the_older_form_are_read(spark, loaded):
    """Whole digests with totals, as refreshes wrote them before: an option row that comes again
    still counts once."""
    src, out, mark = loaded
    snap = commits.snapshot(spark, out)
    facts = [incremental.read_curated(spark, out, t) for t in curated.FACTS]
    text = F.sha2(F.to_json(F.struct(*sorted(facts[2].columns)), {"ignoreNullFields": "false"}), 256)
    old = (facts[2].groupBy("order_id").agg(F.collect_list(F.struct(
        F.unhex(text).alias("key"), F.col("option_total").alias("total"), F.lit(0).alias("discount"))).alias("options")))
    old = order_state._read(spark, out, snap, snap.state).drop("options").join(old, "order_id", "left")
    old = old.withColumn("options", F.coalesce("options", F.array().cast(old.schema["options"].dataType)))
    where = scratch_path(spark, "older")
    old.write.partitionBy("bucket").parquet(f"{where}/{order_state.NAME}/version=old")
    older = commits.Snapshot(state=dict.fromkeys(snap.state, "old"), state_of=snap.state_of)
    there = order_state._read(spark, where, older, older.state)
    want = order_state._read(spark, out, snap, snap.state)
    show = lambda df: rows(df.withColumn("options", F.sort_array("options")).select(*sorted(df.columns)))
    assert show(there) == show(want)
    assert rows(order_state.order_sums(spark, where, older)) == rows(order_state.order_sums(spark, out))
    again = order_state.deltas(*(f.limit(0) for f in facts[:2]), facts[2], snap.state_of)
    merged = order_state.merge(there, again, len(snap.state))
    assert show(merged) == show(want)


def test_shuffle_files_of_finished_work_are_removed(spark):
    """They stayed until the driver happened to collect its garbage."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks, found = manager.getAllFiles().iterator(), set()
        while blocks.hasNext():
            found |= {x for x in re.findall(r"shuffle_(\d+)_", blocks.next().getName())}
        return found

    before = shuffles()
    with session.scratch_released(spark):
        spark.range(1000).repartition(3).write.parquet(scratch_path(spark, "shuffled"))
        made = shuffles() - before
    assert made
    until = time.time() + 30
    while shuffles() & made and time.time() < until:  # the cleaner works beside the driver
        time.sleep(0.5)
        session.release_shuffles(spark)  # as the next step does
    assert not shuffles() & made
