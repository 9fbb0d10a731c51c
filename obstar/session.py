"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import contextvars
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Names of days and months are formatted through the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key with a large part of the rows is split, even where that costs a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcasts are decided by size in memory, of which a Parquet file is a fraction.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # Landing text takes long to judge: tasks of Spark's 128 MB leave cores idle at the end.
    "spark.sql.files.maxPartitionBytes": "32MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: The folder of the run that is going on, if it keeps its tables together.
_RUN: contextvars.ContextVar[str | None] = contextvars.ContextVar("run_folder", default=None)


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a session on one machine may do without; it writes below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def listed(spark: SparkSession, path: str) -> list[str] | None:
    """The names in one folder, wherever Spark can read; None if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else None


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever Spark can write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def run_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """Keep the intermediate tables written inside together; they go with the run.

    What outlives the run must have been written elsewhere by then.
    """
    path = f"{scratch_root(spark)}/obstar/{label}-{uuid.uuid4().hex}"
    before = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(before)
        remove(spark, path)


def materialize(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
    """Write a frame once and return a frame that reads it back.

    Cuts the lineage in a way that survives lost executors, fixes row ids and
    gives the planner the real size, so that later joins broadcast only what is
    known to be small. `spark` is the session to read with, by default the
    frame's own.
    """
    spark = spark or df.sparkSession
    folder = _RUN.get() or f"{scratch_root(spark)}/obstar"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side(*steps: Callable[[], Any]) -> list[Any]:
    """Run steps that do not need each other at the same time.

    Their jobs share the executors; small ones need not wait for one another.
    """
    inheriting = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [
            pool.submit(contextvars.copy_context().run, inheriting(step)) for step in steps
        ]
        return [step.result() for step in running]
