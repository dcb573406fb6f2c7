"""Session helpers.

On a cluster the session comes from the platform; the only thing this
package needs from it is ``spark.checkpoint.dir`` — a folder on shared
storage used to cut lineage (``DataFrame.checkpoint``) and for scratch
outputs. It is read from the session; a local folder is created only when
the session runs in local mode and has none (tests, the driver's smoke run).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


CODEC = "zstd"  # of Parquet files that stay: about a quarter smaller than the default


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "orderlens") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Both are needed: large task results (e.g. a broadcast side) are
        # fetched from the address the driver advertises.
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast decisions on measured sizes only: the planner's file-size
        # estimate is off for compressed columnar files, AQE's runtime size of
        # a finished shuffle stage is not. Explicit broadcast hints (bounded
        # sides) still apply.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(10 << 20))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove checkpoint files once the checkpointed data is no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set a local one only in local mode."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server side owns the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder on shared storage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="orderlens-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate output of this application."""
    return f"{_scratch(spark)}/{uuid.uuid4().hex}/{name}"


def _scratch(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/orderlens-scratch/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> bool:
    """Remove all intermediate output of this application. Call it once every result that was
    built on it is written; frames that still read from it fail afterwards."""
    return _remove(spark, _scratch(spark))


def _remove(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# the folders that ``stored`` has written since the innermost ``scratch_released`` began
_HELD: ContextVar[list[str] | None] = ContextVar("held", default=None)


@contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """A step that leaves only its outputs on disk: what ``stored`` writes inside is removed at the
    end, and so are shuffle files. No frame that is built on it may leave the step."""
    held: list[str] = []
    token = _HELD.set(held)
    try:
        yield
    finally:
        _HELD.reset(token)
        for folder in held:
            _remove(spark, folder)
        release_shuffles(spark)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished work now. Its cleaner goes by the driver's
    garbage collection, which may not come for a long time on a driver that only plans."""
    spark.sparkContext._jvm.java.lang.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: computed once, its lineage cut, and a lost
    executor costs only its own tasks. One pass, where an eager checkpoint computes df twice."""
    path = scratch_path(df.sparkSession, name)
    if (held := _HELD.get()) is not None:
        held.append(path.rpartition("/")[0])
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
