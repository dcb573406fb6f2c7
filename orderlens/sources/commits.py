"""Commit log of the curated zone: a batch is visible when its one record is.

A load writes several tables; a reader must see all of a batch or none of it. Every load (and
every compaction) therefore ends with one record in ``<out>/commit_log/commit=<id>/``: the batch,
the tables' partition it names, the batches it replaces, and the new high-water mark. Spark
publishes that one file by a rename, so a record is there whole or not at all; readers take the
partitions of the records and nothing else, whatever a run that died has left in the folders.

Ids count the records that the writer saw, so they sort in commit order without a clock. Loads
and compactions may commit side by side: each has a folder of its own, and the live batches are
worked out by one rule in id order – a load adds its batch (a batch that is already there is not
added twice), a compaction takes effect only if all the batches it replaces are still live, a
change of the per-order state only if it was worked out from the newest state.

The log has one small row a run, which the driver reads.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

LOG = "commit_log"
BEGIN, LOAD, COMPACT, STATE = "begin", "load", "compact", "state"
_FIELDS = ("kind string, batch string, replaces array<string>, mark string, options_from string, "
           "touched array<int>, buckets int, base string")


@dataclass(frozen=True)
class Snapshot:
    """What readers see: the live fact batches and the newest load (whose copies of the dimensions,
    the waiting options and the marks hold)."""
    batches: tuple[str, ...] = ()
    latest: str | None = None
    mark: dt.datetime | None = None
    options_from: str | None = None
    loads: frozenset[str] = frozenset()
    size: int = 0
    state: dict[int, str] = field(default_factory=dict)  # bucket of the per-order state -> version
    state_of: int | None = None  # its number of buckets
    state_loads: frozenset[str] = frozenset()  # the loads that it includes
    state_version: str | None = None


def read_if_there(read, path: str) -> DataFrame | None:
    """``read(path)``; None if nothing was written there yet. Any other failure is raised: a table
    that cannot be read is no first run."""
    try:
        return read(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def snapshot(spark: SparkSession, out: str) -> Snapshot | None:
    """The committed state of ``out``; None where no job has begun a log."""
    log = read_if_there(spark.read.schema(_FIELDS + ", commit string").json, f"{out.rstrip('/')}/{LOG}")
    if log is None:
        return None
    rows = sorted(log.collect(), key=lambda r: r["commit"])  # one row a run
    batches, loads, latest, mark, options_from = [], set(), None, None, None
    state, state_of, state_loads, version = {}, None, set(), None
    for r in rows:
        if r["kind"] == LOAD and r["batch"] not in loads:
            batches.append(r["batch"])
            loads.add(r["batch"])
            latest = r["batch"]
            mark = dt.datetime.fromisoformat(r["mark"]) if r["mark"] else mark
            options_from = r["options_from"] or options_from
        elif r["kind"] == COMPACT and set(r["replaces"]) <= set(batches):
            batches = [*(b for b in batches if b not in r["replaces"]), r["batch"]]
        elif r["kind"] == STATE and r["base"] == version:
            version, state_of = r["batch"], r["buckets"]
            state_loads.update(r["replaces"])
            state.update(dict.fromkeys(r["touched"], version))
    return Snapshot(tuple(batches), latest, mark, options_from, frozenset(loads), len(rows), state, state_of,
                    frozenset(state_loads), version)


def _write(spark: SparkSession, out: str, kind: str, size: int, batch: str | None = None, replaces=(),
           mark: dt.datetime | None = None, options_from: str | None = None, touched=(),
           buckets: int | None = None, base: str | None = None) -> None:
    path = f"{out.rstrip('/')}/{LOG}/commit={size:010d}-{uuid.uuid4().hex[:8]}"
    row = (kind, batch, list(replaces), mark.isoformat(sep=" ") if mark else None, options_from, list(touched),
           buckets, base)
    spark.createDataFrame([row], _FIELDS).coalesce(1).write.json(path)


def begin(spark: SparkSession, out: str) -> Snapshot:
    """The committed state; starts the log first if there is none, so that nothing a first run
    leaves behind is taken for a table of a time before the log."""
    found = snapshot(spark, out)
    if found is None:
        _write(spark, out, BEGIN, 0)
        found = snapshot(spark, out)
    return found


def commit_load(spark: SparkSession, out: str, seen: Snapshot, batch: str, mark: dt.datetime | None = None,
                options_from: str | None = None) -> None:
    _write(spark, out, LOAD, seen.size, batch, mark=mark, options_from=options_from)


def commit_compaction(spark: SparkSession, out: str, seen: Snapshot, batch: str, replaces) -> bool:
    """Whether the compaction took effect (another one may have replaced the same batches)."""
    _write(spark, out, COMPACT, seen.size, batch, replaces)
    return batch in snapshot(spark, out).batches


def commit_state(spark: SparkSession, out: str, seen: Snapshot, version: str, loads, touched, buckets: int) -> None:
    """Swap in new files of the touched buckets, which include the rows of the loads."""
    _write(spark, out, STATE, seen.size, version, loads, touched=touched, buckets=buckets, base=seen.state_version)
