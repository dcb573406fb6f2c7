"""Commit log: a batch is seen in all tables or in none, whenever its run dies; compaction; late options."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from orderlens import catalog
from orderlens.session import scratch_path
from orderlens.sources import commits, curated, landing, testdata
from orderlens.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = (*incremental.CURATED_TABLES, "pending_options")


def early():
    return F.col("creation_time_utc") <= catalog.INCREMENT_MARK.strftime("%Y-%m-%dT%H:%M:%S.000Z")


def state(spark, out):
    return {t: sorted(map(str, incremental.read_curated(spark, out, t).collect())) for t in TABLES}


@pytest.fixture(scope="module")
def two_states(spark):
    """The landing folder of two batches, what readers see after each, and a copy of the curated
    folder and the mark after the first."""
    src, out, mark = (scratch_path(spark, x).removeprefix("file:") for x in ("landing", "curated", "mark"))
    catalog._write_test_landing(spark, SF, src, early())
    incremental.run_batch(spark, src, out, mark)
    first, kept = state(spark, out), scratch_path(spark, "kept").removeprefix("file:")
    shutil.copytree(out, f"{kept}/curated")
    shutil.copytree(mark, f"{kept}/mark")
    catalog._write_test_landing(spark, SF, src, ~early(), rest=False)
    incremental.run_batch(spark, src, out, mark)
    return src, first, state(spark, out), kept


@pytest.mark.parametrize("after", [*TABLES, "commit"])
def test_readers_stay_on_the_last_commit_whenever_a_run_dies(spark, two_states, monkeypatch, after):
    src, first, both, kept = two_states
    out, mark = (scratch_path(spark, x).removeprefix("file:") for x in ("curated", "mark"))
    shutil.copytree(f"{kept}/curated", out)
    shutil.copytree(f"{kept}/mark", mark)
    if after == "commit":  # dies between the commit and the copy of the mark
        monkeypatch.setattr(incremental, "write_mark", lambda *a: (_ for _ in ()).throw(catalog._Killed()))
        with pytest.raises(catalog._Killed):
            incremental.run_batch(spark, src, out, mark)
        monkeypatch.undo()
        assert state(spark, out) == both
    else:
        with pytest.raises(catalog._Killed):
            incremental.run_batch(spark, src, out, mark, on_write=catalog._kill_after(after))
        assert state(spark, out) == first
    incremental.run_batch(spark, src, out, mark)
    assert state(spark, out) == both
    assert len(commits.snapshot(spark, out).batches) == 2


def test_a_first_run_that_dies_leaves_empty_tables(spark, two_states):
    src, _, both, _ = two_states
    out, mark = scratch_path(spark, "curated"), scratch_path(spark, "mark")
    with pytest.raises(catalog._Killed):
        incremental.run_batch(spark, src, out, mark, on_write=catalog._kill_after("fact_items"))
    assert all(rows == [] for rows in state(spark, out).values())
    assert curated.read_star(spark, out, buckets=4).fact_items.count() == 0
    incremental.run_batch(spark, src, out, mark)
    assert state(spark, out)["fact_items"] == both["fact_items"]


def test_a_replayed_micro_batch_is_skipped_and_a_dead_one_written_again(spark, monkeypatch):
    src, out, ckpt = (scratch_path(spark, x) for x in ("landing", "curated", "ckpt"))
    catalog._write_test_landing(spark, SF, src)
    real, commit = incremental.commits.commit_load, []

    def dies_after(*a, **k):
        real(*a, **k)
        if not commit:
            commit.append(1)
            raise catalog._Killed("after the commit, before the stream's own")

    monkeypatch.setattr(incremental.commits, "commit_load", dies_after)
    with pytest.raises(Exception):
        incremental.run_incremental(spark, src, out, ckpt)
    full = state(spark, out)
    incremental.run_incremental(spark, src, out, ckpt)  # the stream replays batch 0
    assert state(spark, out) == full
    assert commits.snapshot(spark, out).batches == ("0",)


def test_log_rules(spark):
    out = scratch_path(spark, "log")
    assert commits.snapshot(spark, out) is None
    seen = commits.begin(spark, out)
    assert seen.batches == () and seen.latest is None and commits.begin(spark, out).size == 1
    mark = dt.datetime(2001, 2, 3, 4, 5, 6, 789000)
    commits.commit_load(spark, out, seen, "a", mark, "2001-01-01")
    commits.commit_load(spark, out, commits.snapshot(spark, out), "b")
    now = commits.snapshot(spark, out)
    assert now.batches == ("a", "b") and now.mark == mark and now.options_from == "2001-01-01" and now.latest == "b"
    commits.commit_load(spark, out, now, "c")  # beside a compaction that saw a and b
    assert commits.commit_compaction(spark, out, now, "ab", ["a", "b"])
    assert not commits.commit_compaction(spark, out, commits.snapshot(spark, out), "again", ["a"])  # too late
    assert set(commits.snapshot(spark, out).batches) == {"c", "ab"}
    commits.commit_load(spark, out, commits.snapshot(spark, out), "a")  # a replay adds nothing
    assert set(commits.snapshot(spark, out).batches) == {"c", "ab"}


def _files(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("_metadata.file_name").distinct().collect())


@pytest.mark.parametrize("buckets", [None, 4])
def test_compaction_while_a_batch_is_appended(spark, monkeypatch, buckets):
    src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
    cuts = ["2001-02-01", "2001-06-01"]
    times = F.col("creation_time_utc")
    catalog._write_test_landing(spark, SF, src, times <= cuts[0])
    incremental.run_batch(spark, src, out, mark, buckets=buckets)
    catalog._write_test_landing(spark, SF, src, (times > cuts[0]) & (times <= cuts[1]), rest=False)
    incremental.run_batch(spark, src, out, mark, buckets=buckets)
    before = state(spark, out)
    real = commits.commit_compaction

    def late(*a):  # a third batch is committed before the compaction is
        catalog._write_test_landing(spark, SF, src, times > cuts[1], rest=False)
        incremental.run_batch(spark, src, out, mark, buckets=buckets)
        return real(*a)

    monkeypatch.setattr(curated.commits, "commit_compaction", late)
    batch = curated.compact(spark, out, buckets)
    monkeypatch.undo()
    snap = commits.snapshot(spark, out)
    assert batch in snap.batches and len(snap.batches) == 2
    assert state(spark, out)["fact_items"] != before["fact_items"]
    want = sorted(map(str, catalog.q_fact_items(spark, SF).collect()))
    assert state(spark, out)["fact_items"] == want
    assert state(spark, out)["dim_app"] == before["dim_app"]
    if buckets:
        star = curated.read_star(spark, out, buckets)
        assert sorted(map(str, star.fact_items.collect())) == want
        for name in curated.FACTS:
            assert len(_files(spark, f"{out}/{name}/batch={batch}")) <= buckets
        plan = star.fact_items.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
    gone = curated.vacuum(spark, out)
    assert len(gone) == 2 * len(curated.FACTS)
    assert state(spark, out)["fact_items"] == want


def test_compaction_reads_and_writes_each_bucket_in_one_task(spark, two_states):
    src = two_states[0]
    out, mark = scratch_path(spark, "curated"), scratch_path(spark, "mark")
    incremental.run_batch(spark, src, out, mark, buckets=3)
    own = spark.newSession()
    own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    batches = commits.snapshot(spark, out).batches
    for name in curated.FACTS:
        rows = curated._once(curated._batches_of(own, out, name, 3, batches).drop("batch"), name)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and rows.rdd.getNumPartitions() == 3


def test_waiting_options_are_kept_until_their_line_comes(spark):
    src, out, mark = (scratch_path(spark, x) for x in ("landing", "curated", "mark"))
    items = testdata.order_items_source(spark, SF)
    options = testdata.order_item_options_source(spark, SF)
    landing.write_landing({"date_dim": testdata.date_dim_source(spark, SF)}, src)
    landing.write_landing({"order_items": items.filter(early())}, src)
    odd = options.limit(1).withColumns({"order_id": F.lit("no such order")})
    no_key = options.limit(1).withColumns({"lineitem_id": F.lit(None).cast("string")})
    landing.write_landing({"order_item_options": options.unionByName(odd).unionByName(no_key)}, src,
                          ingest_date=dt.date(2001, 6, 1))
    incremental.run_batch(spark, src, out, mark)
    matched = incremental.read_curated(spark, out, "fact_items_options").count()
    waiting = incremental.read_curated(spark, out, "pending_options").count()
    assert waiting > 1 and matched + waiting == options.distinct().count() + 1
    landing.write_landing({"order_items": items.filter(~early())}, src, mode="append")
    incremental.run_batch(spark, src, out, mark)
    assert [r["order_id"] for r in incremental.read_curated(spark, out, "pending_options").collect()] == ["no such order"]
    n = commits.snapshot(spark, out).size
    incremental.run_batch(spark, src, out, mark)  # nothing new: no commit
    assert commits.snapshot(spark, out).size == n


def test_options_are_read_from_the_days_not_yet_loaded(spark):
    src = scratch_path(spark, "landing")
    options = testdata.order_item_options_source(spark, SF)
    for day in (1, 2, 3):
        landing.write_landing({"order_item_options": options}, src, ingest_date=dt.date(2001, 6, day))
    some = incremental.new_options(landing.load_table(spark, src, "order_item_options"), "2001-06-02")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert some.count() == 2 * options.count()
    assert len(some.inputFiles()) >= 2
