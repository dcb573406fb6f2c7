"""R0 kept up to date: the per-order sums as a state table that batches change by deltas.

The reports start from one row per order with its item and option sums. Instead of adding up all
facts for every run, ``refresh`` takes the batches committed since the state was last changed,
adds them up per order, and merges them into the state rows of the same orders. The state lies in
``buckets`` folders by the hash of ``order_id``; only buckets that a new batch touches are read and
written again, as files of a new version, and one record in the commit log swaps all of them in.

An order row or an option row counts once however many batches bring it, so the state keeps what
tells them apart: the distinct order rows, and a digest of 128 bits of each option row (digests are
compared within an order only). Item lines all count, so their sum is enough. A state row grows
with the rows of its order only. Replaced versions stay for their readers until ``vacuum``.

Refreshes do not hinder loads: a state may be behind the newest batch until the next refresh. Two
refreshes at once are settled by the log: the second names a state that is no longer the newest,
and does not take effect.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from orderlens import schemas
from orderlens.session import CODEC, release_shuffles, scratch_released, stored
from orderlens.sources import commits, curated
from orderlens.sources.commits import Snapshot

NAME = "order_state"
MERGED_AT_ONCE = 256 << 20  # bytes of state files that one merge reads, so that its shuffle stays bounded
_ORDER_COLUMNS = [f.name for f in schemas.FACT_ORDERS.fields if f.name != "order_id"]
_ROW = StructType([f for f in schemas.FACT_ORDERS.fields if f.name != "order_id"]).simpleString()
_SUM = "decimal(38,4)"
_FILES = (f"order_id string, orders array<{_ROW}>, item_total {_SUM}, option_total {_SUM}, has_discount int, "
          "keys array<binary>, options array<struct<key: binary>>")


def _option_sum(options) -> F.Column:
    """SUM over the option totals: NULL without a total."""
    totals = F.filter(F.transform(options, lambda o: o["total"]), lambda t: t.isNotNull())
    zero = F.lit(0).cast(_SUM)
    return F.when(F.size(totals) > 0, F.aggregate(totals, zero, lambda a, t: (a + t).cast(_SUM)))


def deltas(orders: DataFrame, items: DataFrame, options: DataFrame, buckets: int) -> DataFrame:
    """One row per order of a batch: bucket, order_id, orders (distinct rows), item_total (NULL
    without a total), options (distinct rows as digest, total), option_total, has_discount."""
    text = F.sha2(F.to_json(F.struct(*sorted(options.columns)), {"ignoreNullFields": "false"}), 256)
    option = F.struct(_key(F.unhex(text)).alias("key"), F.col("option_total").cast("decimal(30,4)").alias("total"))
    discount = F.when(F.col("option_price") < 0, 1).otherwise(0).alias("discount")
    # lines are most of the rows: added up first, so that only their sums are collected with the rest
    sums = items.groupBy("order_id").agg(F.sum("item_total").cast(_SUM).alias("item_total"))
    parts = (orders.select("order_id", F.struct(*_ORDER_COLUMNS).alias("row"))
             .unionByName(sums, allowMissingColumns=True)
             .unionByName(options.select("order_id", option.alias("option"), discount), allowMissingColumns=True))
    found = parts.groupBy("order_id").agg(
        F.collect_set("row").alias("orders"), F.sum("item_total").cast(_SUM).alias("item_total"),
        F.collect_set("option").alias("options"), F.count("option").alias("_rows"),
        F.sum("option.total").cast(_SUM).alias("_total"), F.max("discount").alias("has_discount"))
    # the array is added up, row by row outside generated code, only where an option row came twice
    total = F.when(F.size("options") == F.col("_rows"), F.col("_total")).otherwise(_option_sum(F.col("options")))
    return found.select(_bucket(buckets), "order_id", "orders", "item_total", "options",
                        total.alias("option_total"), "has_discount")


def _key(digest: F.Column) -> F.Column:
    return F.substring(digest, 1, 16)


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int").alias("bucket")


def merge(old: DataFrame | None, new: DataFrame, touched: int) -> DataFrame:
    """The state rows of the ``touched`` buckets after a delta; both hold an order once. The two are
    joined by order, so the work is dealt over orders however few buckets there are, and a state
    row that the delta does not change goes through as it is."""
    columns = ["bucket", "order_id", "orders", "item_total", "option_total", "has_discount"]
    if old is None:
        return new.select(*columns, F.col("options.key").alias("options"))
    o, n = old.withColumn("_there", F.lit(True)).alias("o"), new.withColumn("_there", F.lit(True)).alias("n")
    col = lambda side, c: F.col(f"{side}.{c}")
    kept, fresh = col("n", "_there").isNull(), col("o", "_there").isNull()

    def either(c: str, both: F.Column) -> F.Column:
        return F.when(kept, col("o", c)).when(fresh, col("n", c)).otherwise(both).alias(c)

    added = lambda c: F.coalesce((col("o", c) + col("n", c)).cast(_SUM), col("o", c), col("n", c))
    fresh_keys = col("n", "options.key")
    # an option row that the state holds is in its sum: only those that it lacks are added
    more = _option_sum(F.filter(col("n", "options"), lambda x: ~F.array_contains(col("o", "options"), x["key"])))
    again = F.coalesce((col("o", "option_total") + more).cast(_SUM), col("o", "option_total"), more)
    joined = o.join(n, [col("o", "bucket") == col("n", "bucket"), col("o", "order_id").eqNullSafe(col("n", "order_id"))], "full")
    return joined.select(
        *[F.coalesce(col("o", c), col("n", c)).alias(c) for c in ("bucket", "order_id")],
        either("orders", F.array_union(col("o", "orders"), col("n", "orders"))),
        either("item_total", added("item_total")),
        # the arrays are gone through only where an option row came again
        either("option_total", F.when(F.arrays_overlap(col("o", "options"), fresh_keys), again).otherwise(added("option_total"))),
        # one of the arrays may be empty: greatest skips its NULL
        either("has_discount", F.greatest(col("o", "has_discount"), col("n", "has_discount"))),
        F.when(kept, col("o", "options")).when(fresh, fresh_keys)
         .otherwise(F.array_union(col("o", "options"), fresh_keys)).alias("options"))


def _paths(out: str, snap: Snapshot, buckets) -> list[str]:
    return [f"{out.rstrip('/')}/{NAME}/version={snap.state[b]}/bucket={b}" for b in sorted(buckets) if b in snap.state]


def _read(spark: SparkSession, out: str, snap: Snapshot, buckets) -> DataFrame | None:
    """The state rows of some buckets: their files and no others."""
    paths = _paths(out, snap, buckets)
    if not paths:
        return None
    state = spark.read.schema(_FILES).parquet(*paths)
    # files of an older form hold whole digests, each with its row's total
    keys = F.coalesce("keys", F.transform("options", lambda o: _key(o["key"])))
    return state.withColumns({"options": keys, "bucket": _bucket(snap.state_of)}).drop("keys")


def _groups(spark: SparkSession, out: str, snap: Snapshot, touched: list[int]) -> list[list[int]]:
    """The touched buckets in groups whose state files hold ``MERGED_AT_ONCE`` bytes, or one bucket."""
    jvm, groups, held = spark.sparkContext._jvm, [], 0
    for b in sorted(touched):
        size = 0
        for p in _paths(out, snap, [b]):
            path = jvm.org.apache.hadoop.fs.Path(p)
            size += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
        if not groups or held + size > MERGED_AT_ONCE:
            groups, held = [*groups, []], 0
        groups[-1].append(b)
        held += size
    return groups


def refresh(spark: SparkSession, out: str, buckets: int = 64) -> Snapshot:
    """Bring the state up to the newest commit; the committed state afterwards. ``buckets`` is set by
    the first refresh and stays as it is; choose it so that a bucket's rows fit one task."""
    seen = commits.snapshot(spark, out)
    if seen is None:
        raise ValueError(f"no commit log under {out}")
    fresh = [b for b in seen.batches if b in seen.loads - seen.state_loads]
    if not fresh:
        return seen
    n = seen.state_of or buckets
    facts = [curated.read_some(spark, out, name, fresh, once=False) for name in curated.FACTS]  # the sets drop equal rows
    version = f"{seen.size:06d}-{uuid.uuid4().hex[:8]}"
    path = f"{out.rstrip('/')}/{NAME}/version={version}"
    with scratch_released(spark):
        delta = stored(deltas(*facts, n), "deltas")  # read twice
        release_shuffles(spark)
        touched = [r[0] for r in delta.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        for some in _groups(spark, out, seen, touched):
            state = merge(_read(spark, out, seen, some), delta.filter(F.col("bucket").isin(some)), len(some))
            (state.withColumnRenamed("options", "keys").write.mode("append").partitionBy("bucket")
             .parquet(path, compression=CODEC))
            release_shuffles(spark)
    commits.commit_state(spark, out, seen, version, fresh, touched, n)
    return commits.snapshot(spark, out)


def vacuum(spark: SparkSession, out: str) -> list[str]:
    """Remove the state files that no reader of the committed state needs: buckets that a later
    refresh has replaced and what dead refreshes left. Run it while no refresh runs and no reader
    holds an older state (``curated.vacuum`` does the same for the facts)."""
    snap = commits.snapshot(spark, out)
    if snap is None:
        return []
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/{NAME}")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    live, gone = {f"version={v}/bucket={b}" for b, v in snap.state.items()}, []
    for version in fs.listStatus(base) if fs.exists(base) else []:
        name = version.getPath().getName()
        dead = {f"{name}/{x.getPath().getName()}" for x in fs.listStatus(version.getPath())} - live
        if not any(x.startswith(f"{name}/") for x in live):
            dead = {name}
        for x in sorted(x for x in dead if "/" not in x or "/bucket=" in x):
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/{x}"), True)
            gone.append(x)
    return gone


def order_sums(spark: SparkSession, out: str, snap: Snapshot | None = None) -> DataFrame:
    """The state as the frame that every report shares (``operators.order_totals.order_sums``): order
    rows with their raw sums. No join and no aggregation is left; the digests are not read."""
    snap = snap or commits.snapshot(spark, out)
    state = None if snap is None else _read(spark, out, snap, snap.state)
    if state is None:
        raise FileNotFoundError(f"no order state under {out}; run refresh first")
    keyed = F.col("order_id").isNotNull()  # rows without an order have no sums
    rows = state.select("order_id", F.explode("orders").alias("row"),
                        *[F.when(keyed, F.col(c)).alias(c) for c in ("item_total", "option_total", "has_discount")])
    return rows.select("order_id", "row.*", "item_total", "option_total", "has_discount")
