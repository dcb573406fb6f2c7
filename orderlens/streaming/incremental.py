"""Incremental loading of the star schema.

Two ways to run the transform job:

* ``run_batch`` – the batch job with a high-water mark: only order rows newer
  than the stored mark are conformed and appended; the new mark is the batch's
  largest creation time. Rows at or below the mark are never loaded (late
  data is lost, as in the source job); a run that finds nothing new writes
  nothing and keeps the mark.
* ``run_incremental`` – the same transform as a Structured Streaming job over
  the landing folders of items and options: the stream's checkpoint remembers
  which *files* were processed, so late rows in new files are not lost.

Both end a batch with one record in the commit log (``sources.commits``) that
carries the new mark. Readers see the batch from then on, in all tables at
once; a run that dies before leaves them on the state before, and the next run
writes the same partitions again. ``foreachBatch`` is at-least-once: a replayed
batch that was committed is skipped.

Options may arrive before, with or after their lines. An option whose line is
not loaded yet waits in ``pending_options`` (one copy per batch, like the
dimensions); each batch settles new and waiting options against its own lines
and the lines already loaded.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens import schemas
from orderlens.operators import conform, rejects
from orderlens.session import CODEC, release_shuffles, scratch_released, stored
from orderlens.sources import commits, curated
from orderlens.sources.commits import Snapshot
from orderlens.sources.landing import INGEST_DATE, conform_to, load_table

FIRST_BATCH = "00000000T000000000000"  # the batch partition of a run without a mark; sorts first
CURATED_TABLES = ("date_dim", "dim_app", "fact_orders", "fact_items", "fact_items_options")
LINE = ["order_id", "lineitem_id"]


# --------------------------------------------------------------------------- E4
def new_rows(order_items: DataFrame, last: dt.datetime | None) -> DataFrame:
    """Rows created strictly after the mark; without a mark, all rows (NULL times too)."""
    if last is None:
        return order_items
    mark = F.lit(last).cast("timestamp_ntz") if isinstance(last, dt.datetime) else F.lit(last)
    return order_items.filter(F.col("creation_time_utc") > mark)


def newer_text(order_items: DataFrame, last: dt.datetime | None) -> DataFrame:
    """Landing rows whose time text sorts after the mark: a plain comparison of fixed-width ISO
    text that reaches the file scan. ``new_rows`` still decides on the parsed time."""
    if last is None:
        return order_items
    text = last.strftime("%Y-%m-%dT%H:%M:%S.") + f"{last.microsecond // 1000:03d}Z"
    return order_items.filter(F.col("creation_time_utc") >= text)


# --------------------------------------------------------------------------- E5
def related_options(options: DataFrame, new_items: DataFrame) -> DataFrame:
    """Option rows whose (order_id, lineitem_id) occurs among the new item rows.

    A semi join: option rows are never multiplied by duplicate item keys.
    """
    return options.join(new_items.select(*LINE), LINE, "left_semi")


def new_options(options: DataFrame, since: str | None) -> DataFrame:
    """Options landed on or after a date (that day may still get files; a row that is loaded twice
    counts once). A landing without ingest dates gives all options: each run scans them again."""
    if since is None or INGEST_DATE not in options.columns:
        return options
    return options.filter(F.col(INGEST_DATE) >= F.lit(since).cast("date"))


def settle_options(options: DataFrame, new_items: DataFrame, loaded_items: DataFrame | None = None,
                   loaded_options: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(facts of the options whose line is in the new or the loaded items, without those that are
    loaded already; options that go on waiting, as they came). Both distinct.

    All sides meet in one pass that is dealt by line: options that are loaded drop out first, the
    others look for their line, and equal ones are dropped where they lie. Of the loaded lines only
    two columns are read. Options without a full key can have no line.
    """
    raw = {"_raw_quantity": "option_quantity", "_raw_price": "option_price"}
    rows = options.dropna(subset=LINE)
    names = schemas.FACT_ITEMS_OPTIONS.fieldNames()
    if loaded_options is not None:
        # as text on this side, so that a row is dealt with its values once; the total follows from them
        typed = {"option_quantity": conform.to_decimal("option_quantity", 12, 4),
                 "option_price": conform.to_decimal("option_price", 20, 4)}
        values = [c for c in names if c != "option_total"]
        there = loaded_options.select(*[F.col(c).alias(f"_there_{c}") for c in values])
        pairs = {c: (typed.get(c, F.col(c)), F.col(f"_there_{c}")) for c in values}
        # the line's keys in the order of the next join, which then needs no shuffle. NULL equals NULL
        # in the others; spelled out, as <=> would become a join key and ask for a shuffle of its own
        equal = [F.col(c) == F.col(f"_there_{c}") for c in LINE]
        equal += [F.coalesce(a == b, a.isNull() & b.isNull()) for c, (a, b) in pairs.items() if c not in LINE]
        rows = rows.join(there, equal, "left_anti")
    lines = new_items.select(*LINE)
    if loaded_items is not None:
        lines = lines.unionByName(loaded_items.select(*LINE))
    rows = rows.join(lines.distinct().withColumn("_line", F.lit(True)), LINE, "left")
    rows = conform.typed_options(rows.withColumns({k: F.col(c) for k, c in raw.items()}))
    # a fact is distinct by its typed values, a waiting option by its text
    found = F.col("_line").isNotNull()
    rows = stored(rows.withColumns({k: F.when(~found, F.col(k)) for k in raw}).dropDuplicates(), "settled")
    waiting = rows.filter(~found).withColumns({c: F.col(k) for k, c in raw.items()})
    return rows.filter(found).select(*names), waiting.select(*schemas.ORDER_ITEM_OPTIONS.fieldNames())


# --------------------------------------------------------------------------- E12
def high_water_mark(batch: DataFrame) -> DataFrame:
    """One row: the batch's largest creation time (NULL for an empty batch)."""
    return batch.agg(F.max("creation_time_utc").alias("last_processed_timestamp"))


def next_mark(batch: DataFrame, previous: dt.datetime | None) -> dt.datetime | None:
    """The new mark: the batch's largest creation time, or ``previous`` when it has none."""
    value = high_water_mark(batch).first()[0]
    return previous if value is None else value


def read_mark(spark: SparkSession, path: str) -> dt.datetime | None:
    """The stored mark; None before the first run. A mark that cannot be read is an error."""
    try:
        rows = spark.read.schema("last_processed_timestamp string").json(path).collect()  # one row
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if len(rows) != 1 or rows[0][0] is None:
        raise ValueError(f"unreadable mark in {path}: {rows}")
    return dt.datetime.fromisoformat(rows[0][0])


def write_mark(spark: SparkSession, path: str, mark: dt.datetime) -> None:
    spark.createDataFrame([(mark.isoformat(sep=" "),)], "last_processed_timestamp string") \
        .coalesce(1).write.mode("overwrite").json(path)


# --------------------------------------------------------------------------- E11
def write_curated(tables: dict[str, DataFrame], out: str, batch_id: int | str | None = None,
                  fact_mode: str = "append", buckets: int | None = None, dims_per_batch: bool = False,
                  on_write: Callable[[str], None] | None = None) -> None:
    """Write the five curated tables as Parquet.

    With ``batch_id`` the facts of a batch go to their own ``batch=<id>``
    partition, replaced on a rerun (idempotent): plain Parquet folders, or
    bucketed by ``order_id`` (``buckets``: the layout the reports read without
    per-order shuffles). Without ``batch_id`` facts are appended, partitioned by
    order month when they carry a creation time. Dimensions are overwritten
    whole (the dimension passed in is complete), or kept as one copy per batch
    (``dims_per_batch``: a crash never harms the copy that readers and later runs use).
    ``on_write`` is told each table that has been written.
    """
    for name, df in tables.items():
        path = f"{out.rstrip('/')}/{name}"
        fact = name.startswith("fact_")
        if fact and batch_id is not None:
            if buckets is not None:
                curated.write_batch_bucketed(df, out, name, buckets, str(batch_id))
            else:
                df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}", compression=CODEC)
        elif fact:
            writer = df.write.mode(fact_mode)
            if "creation_time_utc" in df.columns:
                df = df.withColumn("order_month", F.date_format("creation_time_utc", "yyyy-MM"))
                writer = df.write.mode(fact_mode).partitionBy("order_month")
            writer.parquet(path)
        elif dims_per_batch and batch_id is not None:
            df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}", compression=CODEC)
        else:
            df.write.mode("overwrite").parquet(path)
        if on_write is not None:
            on_write(name)


def transform(order_items: DataFrame, options: DataFrame, date_dim: DataFrame,
              existing_apps: DataFrame | None = None) -> dict[str, DataFrame]:
    """E6-E10 on one conformed batch of order rows and the options of their lines."""
    apps = conform.dim_app(order_items, existing_apps)
    return _star(order_items, conform.fact_item_options(related_options(options, order_items)), date_dim, apps)


def _star(order_items: DataFrame, option_facts: DataFrame, date_dim: DataFrame, apps: DataFrame) -> dict[str, DataFrame]:
    return {
        "date_dim": conform.dim_date(date_dim),
        "dim_app": apps,
        "fact_orders": conform.fact_orders(order_items, apps),
        "fact_items": conform.fact_items(order_items),
        "fact_items_options": option_facts,
    }


def _load(spark: SparkSession, out: str, seen: Snapshot, token: str, bad: DataFrame, items: DataFrame,
          options: DataFrame, dates: DataFrame, buckets: int | None, mark: dt.datetime | None, options_from: str | None,
          on_write: Callable[[str], None] | None, on_bad: str, always: bool) -> bool:
    """Write and commit one batch; False (and nothing written) if it holds no lines, no options
    that find their line and no new rejects, unless ``always``. ``bad`` are the rejects among the
    order lines that were read, ``items`` the flagged lines of the batch."""
    declared = schemas.ORDER_ITEM_OPTIONS.fieldNames()
    options = rejects.flagged(options.select(*declared), "order_item_options")
    bad = bad.unionByName(rejects.reject_rows(options, "order_item_options", declared))
    known = curated.read_batches(spark, out, "rejects", seen) if seen.loads else None
    if known is not None:  # landed rows that are read again
        bad = bad.join(known.select("table_name", "row_text"), ["table_name", "row_text"], "left_anti").select(*bad.columns)
    bad = stored(bad, "rejects")
    if on_bad == "reject":
        items, options = rejects.parsed_rows(items), rejects.parsed_rows(options)
    waiting = _latest(spark, out, "pending_options", seen)
    options = options.select(*declared)
    if waiting is not None:
        options = options.unionByName(waiting)
    # an option may be loaded already: landed twice, or on a day that is read again
    loaded = [curated.read_batches(spark, out, t, seen, once=False) if seen.batches else None
              for t in ("fact_items", "fact_items_options")]
    facts, later = settle_options(options, items, *loaded)
    release_shuffles(spark)
    if not always and items.isEmpty() and bad.isEmpty() and facts.isEmpty():
        return False
    # stored: the planner broadcasts the dimension by the size of its files, and deals no lines by app
    apps = stored(conform.dim_app(items, _latest(spark, out, "dim_app", seen)), "apps")
    tables = _star(items, facts, dates, apps)
    tables["pending_options"] = later
    tables["rejects"] = bad
    write_curated(tables, out, batch_id=token, buckets=buckets, dims_per_batch=True, on_write=on_write)
    commits.commit_load(spark, out, seen, token, mark, options_from)
    return True


def _flagged_items(raw: DataFrame, last: dt.datetime | None,
                   on_rows: Callable[[dict], None] | None) -> tuple[DataFrame, DataFrame, dt.datetime | None]:
    """(order lines, flagged and conformed: those after the mark, and those whose time cannot be
    read; their rejects; the largest time or ``last``). One pass over the checked columns finds the
    time and the counts of rows and rejects that ``on_rows`` gets; whole rows are read for rejects
    only if it finds some. The lines are not stored: the landing files are, and each output reads
    its own columns of them."""
    rows = conform.conform_orders(rejects.flagged(raw, "order_items"))
    unread = F.col("creation_time_utc").isNull() & F.col(rejects.RAW_TIME).isNotNull()
    if last is not None:
        rows = rows.filter((F.col("creation_time_utc") > F.lit(last).cast("timestamp_ntz")) | unread)
    found = rows.agg(*rejects.counts("order_items"), F.max("creation_time_utc").alias("_mark")).first().asDict()
    mark = found.pop("_mark")
    bad = rows if found["rejected"] else rows.limit(0)
    bad = stored(rejects.reject_rows(bad, "order_items", schemas.ORDER_ITEMS.fieldNames()), "bad-lines")
    if on_rows is not None:
        on_rows(found)
    return rows, bad, last if mark is None else mark


def run_batch(spark: SparkSession, landing: str, out: str, mark_path: str, buckets: int | None = None,
              on_write: Callable[[str], None] | None = None, on_bad: str = "keep",
              on_rows: Callable[[dict], None] | None = None) -> dt.datetime | None:
    """The batch transform job with a stored high-water mark; returns the new mark.

    The batch is "rows after <last mark>" and the options landed since the last run; its tables
    go to the partition named after that mark and the number of commits, so a rerun after a
    failure rewrites the same partitions. The commit record is what makes the batch visible and
    what holds the mark; ``mark_path`` keeps a copy of it for others to read. ``on_write`` is told
    each table that has been written (an exception there stops the run as a crash would).

    Rows whose text does not parse go to the table ``rejects`` with the reason; in the facts their
    bad values are NULL (``on_bad="keep"``, as in the source job), or they are left out
    (``"reject"``). A row whose time cannot be read has no place before or after the mark: it
    is found where its text sorts after the mark's. ``on_rows`` gets the counts of the order lines
    read and rejected.
    """
    release_shuffles(spark)  # of whatever was done before
    with scratch_released(spark):
        return _run_batch(spark, landing, out, mark_path, buckets, on_write, on_bad, on_rows)


def _run_batch(spark: SparkSession, landing: str, out: str, mark_path: str, buckets: int | None,
               on_write: Callable[[str], None] | None, on_bad: str, on_rows: Callable[[dict], None] | None) -> dt.datetime | None:
    last = read_mark(spark, mark_path)
    seen = commits.begin(spark, out)
    if seen.mark is not None:
        last = seen.mark  # a run may have died between its commit and the copy
    src = {name: load_table(spark, landing, name) for name in ("order_items", "order_item_options", "date_dim")}
    rows, bad, mark = _flagged_items(newer_text(src["order_items"], last), last, on_rows)
    batch = new_rows(rows, last)
    options = new_options(src["order_item_options"], seen.options_from)
    upto = None
    if INGEST_DATE in options.columns:
        upto = options.agg(F.max(INGEST_DATE)).first()[0]  # of the folder names' column
    start = FIRST_BATCH if last is None else last.strftime("%Y%m%dT%H%M%S%f")
    if _load(spark, out, seen, f"{start}-{seen.size:06d}", bad, batch, options, src["date_dim"], buckets, mark,
             str(upto) if upto else None, on_write, on_bad, always=False) and mark is not None:
        write_mark(spark, mark_path, mark)
    return mark


# --------------------------------------------------------------------------- E13
def run_incremental(spark: SparkSession, landing: str, out: str, checkpoint: str, buckets: int | None = None,
                    on_write: Callable[[str], None] | None = None, on_bad: str = "keep") -> None:
    """Conform every new landing file of items and options once, as a Structured Streaming job.

    ``trigger(availableNow=True)`` processes what has arrived and stops, so
    the job can be scheduled like the batch one. Both folders are sources of one
    query, so the checkpoint tracks their files together; dates are read with each
    micro-batch. With ``buckets`` the facts of each micro-batch replace their own
    batch partition of the bucketed fact tables (the layout the reports read).
    """
    base, out = landing.rstrip("/"), out.rstrip("/")
    commits.begin(spark, out)

    def source(name: str) -> DataFrame:
        files = spark.read.parquet(f"{base}/{name}").schema  # typed or text, with any other columns
        return spark.readStream.schema(files).parquet(f"{base}/{name}").select(F.struct("*").alias(name))

    stream = source("order_items").unionByName(source("order_item_options"), allowMissingColumns=True)

    def process(batch: DataFrame, batch_id: int) -> None:
        seen = commits.snapshot(spark, out)
        if str(batch_id) in seen.loads:
            return  # replayed after its commit
        with scratch_released(spark):
            # read once, then by every output
            rows = stored(batch, f"batch-{batch_id}")
            part = lambda name: rows.filter(F.col(name).isNotNull()).select(f"{name}.*")
            items, bad, mark = _flagged_items(conform_to(part("order_items"), schemas.ORDER_ITEMS), None, None)
            options = conform_to(part("order_item_options"), schemas.ORDER_ITEM_OPTIONS)
            _load(spark, out, seen, str(batch_id), bad, items, options, load_table(spark, base, "date_dim"), buckets,
                  seen.mark if mark is None else mark, None, on_write, on_bad, always=True)

    query = (stream.writeStream.foreachBatch(process)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _latest(spark: SparkSession, out: str, name: str, seen: Snapshot) -> DataFrame | None:
    """The copy of a dimension (ids stay stable) or of the waiting options of the newest load."""
    return None if seen.latest is None else curated.read_batches(spark, out, name, seen).select(
        *curated.SCHEMAS[name].fieldNames())


def read_curated(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A curated table of the batch or stream job (facts of all batches, latest dimension)."""
    return curated.read_batches(spark, out, name)
