"""The curated zone: the star tables as Parquet, read with declared schemas.

Two layouts:

* plain: ``fact_orders`` partitioned by order month, the other tables as-is;
* bucketed (``buckets=n``): the three fact tables bucketed by ``order_id``
  into the same ``n`` buckets (catalog tables over the given folders). Every
  report starts by summing items and options per order and joining them to
  the orders; on bucketed tables those aggregations and joins read matching
  buckets and need no shuffle — the facts are shuffled once, when written,
  instead of once per report.

Tables that the jobs write batch by batch are read through the commit log
(``commits``): only the batches of committed runs, all tables at one state.
``compact`` rewrites many batches into one with a file per bucket.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens import schemas
from orderlens.sources import commits
from orderlens.sources.commits import Snapshot
from orderlens.sources.testdata import Star

FACTS = ("fact_orders", "fact_items", "fact_items_options")
SCHEMAS = {"fact_orders": schemas.FACT_ORDERS, "fact_items": schemas.FACT_ITEMS,
           "fact_items_options": schemas.FACT_ITEMS_OPTIONS, "dim_app": schemas.DIM_APP,
           "date_dim": schemas.DATE_DIM, "pending_options": schemas.ORDER_ITEM_OPTIONS,
           "rejects": schemas.REJECTS}
BUCKET_KEY = "order_id"

STAR_ORDERS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.FACT_ORDERS.fields
                        if f.name != "app_id")
DDL = {
    "fact_orders": STAR_ORDERS,
    "fact_items": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.FACT_ITEMS.fields),
    "fact_items_options": ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                    for f in schemas.FACT_ITEMS_OPTIONS.fields),
}


def bucket_count(rows: int, rows_per_bucket: int = 2_000_000) -> int:
    """Buckets for a fact table of so many rows: some hundred MB of Parquet each."""
    return max(1, -(-rows // rows_per_bucket))


def table_name(out: str, name: str) -> str:
    """Catalog name of a bucketed table stored under ``out`` (one name per folder)."""
    return f"ol_{hashlib.sha1(out.rstrip('/').encode()).hexdigest()[:12]}_{name}"


def write_star(star: Star, out: str, buckets: int | None = None) -> None:
    base = out.rstrip("/")
    if buckets is None:
        (star.fact_orders.withColumn("order_month", F.date_format("creation_time_utc", "yyyy-MM"))
         .write.mode("overwrite").partitionBy("order_month").parquet(f"{base}/fact_orders"))
        star.fact_items.write.mode("overwrite").parquet(f"{base}/fact_items")
        star.fact_items_options.write.mode("overwrite").parquet(f"{base}/fact_items_options")
    else:
        for name in FACTS:
            # one shuffle into the buckets, so each task writes one file per bucket it owns
            (getattr(star, name).repartition(buckets, BUCKET_KEY)
             .write.mode("overwrite").bucketBy(buckets, BUCKET_KEY)
             .option("path", f"{base}/{name}").saveAsTable(table_name(out, name)))
    star.date_dim.write.mode("overwrite").parquet(f"{base}/date_dim")


def _register(spark: SparkSession, out: str, name: str, buckets: int, ddl: str | None = None) -> str:
    """The name of the bucketed table over ``out/name``; registered over its folder when the
    catalog lacks it, with the batches that the folder holds. ``ddl``: the columns of a table
    that is about to be written in batches."""
    table = table_name(out, name)
    path = f"{out.rstrip('/')}/{name}"
    if spark.catalog.tableExists(table):
        return table
    batches = _has_batches(spark, path)  # written batch by batch (run_batch / run_incremental)
    if batches and ddl is None:
        files = spark.read.parquet(path)  # schema of the files (footer read) + batch column
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in files.schema.fields if f.name != "batch")
    if ddl is not None:
        spark.sql(f"CREATE TABLE {table} ({ddl}, batch string) USING parquet PARTITIONED BY (batch) "
                  f"CLUSTERED BY ({BUCKET_KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
        if batches:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    else:
        spark.sql(f"CREATE TABLE {table} ({DDL[name]}) USING parquet "
                  f"CLUSTERED BY ({BUCKET_KEY}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return table


def _batches_of(spark: SparkSession, out: str, name: str, buckets: int, batches) -> DataFrame:
    """The rows (with their batch) of some batches of a bucketed table."""
    table = _register(spark, out, name, buckets)
    known = {r[0].removeprefix("batch=") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    if not set(batches) <= known:  # written by another session since the table was registered
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table).filter(F.col("batch").isin(list(batches)))


def _bucketed(spark: SparkSession, out: str, name: str, buckets: int, snap: Snapshot | None) -> DataFrame:
    """The bucketed table over ``out/name``: the committed batches where a job has written it."""
    if snap is not None:
        if not snap.batches:
            return spark.createDataFrame([], SCHEMAS[name])
        return _once(_batches_of(spark, out, name, buckets, snap.batches).drop("batch"), name)
    df = spark.table(_register(spark, out, name, buckets))
    return _once(df.drop("batch"), name) if "batch" in df.columns else df


def _once(df: DataFrame, name: str) -> DataFrame:
    """Rows of all batches of a table: an order or option that came with the lines of several
    batches counts once (lines are source rows and all count). On tables bucketed by
    ``order_id`` the distinct needs no exchange."""
    return df.distinct() if name in ("fact_orders", "fact_items_options") else df


def read_batches(spark: SparkSession, out: str, name: str, snap: Snapshot | None = None,
                 once: bool = True) -> DataFrame:
    """A curated table written in batch folders: the facts of all committed batches, the newest
    committed copy of a dimension (or of the waiting options). ``snap`` pins the state, so that
    several tables are read at one. Tables without a commit log are read as they are. Without
    ``once`` a row that several batches hold may come more than once, for callers that sort that out."""
    base = f"{out.rstrip('/')}/{name}"
    snap = snap or commits.snapshot(spark, out)
    fact = name in FACTS
    if snap is not None:
        # rejects are not compacted: those of every load
        live = snap.batches if fact else sorted(snap.loads) if name == "rejects" else [snap.latest] if snap.latest else []
        if not live:
            return spark.createDataFrame([], SCHEMAS[name])
        return read_some(spark, out, name, live, once)
    df = spark.read.parquet(base)
    if "batch" not in df.columns:
        return df
    if not fact:
        return df.filter(F.col("batch") == df.agg(F.max("batch")).scalar()).drop("batch")
    return _once(df.drop("batch"), name) if once else df.drop("batch")


def read_some(spark: SparkSession, out: str, name: str, batches, once: bool = True) -> DataFrame:
    """The rows of some batches of a fact table."""
    df = spark.read.parquet(*[f"{out.rstrip('/')}/{name}/batch={b}" for b in batches])
    return _once(df, name) if once else df


def _has_batches(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and any(st.isDirectory() and st.getPath().getName().startswith("batch=")
                                for st in fs.listStatus(p))


def read_star(spark: SparkSession, path: str, buckets: int | None = None) -> Star:
    base = path.rstrip("/")
    snap = commits.snapshot(spark, path)  # one state for all tables
    date_dim = read_batches(spark, path, "date_dim", snap)
    if buckets is not None:
        return Star(*(_bucketed(spark, path, n, buckets, snap) for n in FACTS), date_dim=date_dim)
    if snap is not None:
        return Star(*(read_batches(spark, path, n, snap) for n in FACTS), date_dim=date_dim)
    return Star(
        fact_orders=spark.read.schema(STAR_ORDERS + ", order_month string")
        .parquet(f"{base}/fact_orders").drop("order_month"),
        fact_items=spark.read.schema(schemas.FACT_ITEMS).parquet(f"{base}/fact_items"),
        fact_items_options=spark.read.schema(schemas.FACT_ITEMS_OPTIONS).parquet(f"{base}/fact_items_options"),
        date_dim=date_dim,
    )


def write_batch_bucketed(df: DataFrame, out: str, name: str, buckets: int, batch: str) -> None:
    """Write one batch into a bucketed fact table partitioned by ``batch``.

    The partition is replaced, not appended to:
    rerunning a batch after a failure rewrites the same partition, so no row is
    loaded twice. A table written by an earlier session is registered over its
    folder first.
    """
    spark = df.sparkSession
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    table = _register(spark, out, name, buckets, ddl)
    cols = [c for c in spark.table(table).columns if c != "batch"]
    # a static partition replaces only itself, whatever the session's overwrite mode
    view = f"{table}_{uuid.uuid4().hex[:8]}"
    df.select(*cols).repartition(buckets, BUCKET_KEY).createOrReplaceTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch = '{batch}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def compact(spark: SparkSession, out: str, buckets: int | None = None) -> str | None:
    """Rewrite all live batches of the fact tables into one batch and swap it in through the
    commit log; the new batch, or None if there was nothing to do (or another compaction won).

    Batches that are committed meanwhile stay as they are, and readers see either the old batches
    or the new one. With ``buckets`` each bucket is read, made distinct where the table counts a
    row once, and written by one task, so every bucket ends up in one file and nothing is
    shuffled; without, AQE sizes the files. The replaced folders stay for readers that still hold
    them until ``vacuum``. Batches that a per-order state does not include yet are left out: their
    rows could not be told apart afterwards.
    """
    seen = commits.snapshot(spark, out)
    if seen is None:
        return None
    waits = seen.loads - seen.state_loads if seen.state_version else set()
    replaced = [b for b in seen.batches if b not in waits]
    if len(replaced) < 2:
        return None
    batch = f"compact-{seen.size:06d}-{uuid.uuid4().hex[:8]}"
    for name in FACTS:
        if buckets is None:
            read_some(spark, out, name, replaced).hint("rebalance").write.parquet(f"{out.rstrip('/')}/{name}/batch={batch}")
        else:
            # a session of its own: the planner would give up the bucketed scan, as no join or
            # aggregation of the items asks for it
            own = spark.newSession()
            own.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
            rows = _once(_batches_of(own, out, name, buckets, replaced).drop("batch"), name)
            path, table = f"{out.rstrip('/')}/{name}/batch={batch}", table_name(out, name)
            # a table of its own over the new folder, which then becomes a partition
            (rows.write.bucketBy(buckets, BUCKET_KEY).option("path", path).saveAsTable(f"{table}_new"))
            spark.sql(f"DROP TABLE {table}_new")  # external: the files stay
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (batch = '{batch}') LOCATION '{path}'")
    return batch if commits.commit_compaction(spark, out, seen, batch, replaced) else None


def vacuum(spark: SparkSession, out: str, names: tuple[str, ...] = FACTS) -> list[str]:
    """Remove the fact folders that no committed state needs: batches replaced by a compaction and
    what dead runs left. Run it while no load or compaction runs and no reader holds an older state."""
    snap = commits.snapshot(spark, out)
    if snap is None:
        return []
    jvm = spark.sparkContext._jvm
    gone = []
    for name in names:
        base = jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/{name}")
        fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(base):
            continue
        for st in fs.listStatus(base):
            folder = st.getPath().getName()
            if folder.startswith("batch=") and folder.removeprefix("batch=") not in snap.batches:
                fs.delete(st.getPath(), True)
                gone.append(f"{name}/{folder}")
        table = table_name(out, name)
        if spark.catalog.tableExists(table):
            for x in gone:
                if x.startswith(f"{name}/batch="):
                    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (batch = '{x.split('=', 1)[1]}')")
    return gone
