"""The append-only log of runs, and the state it tells."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obstar.operators.dedupe import last_per_key
from obstar.schemas import RUN_LOG
from obstar.session import listed, remove

# fixed values: what a row of the log says of a run
RUNNING, SUCCESS, FAILED, SKIPPED = "running", "success", "failed", "skipped_empty"
REPLAYED, REFUSED = "already_published", "refused"
IDLE, FINISHED, ERROR = "idle", "finished", "error"


_ENTRY, _LEVEL = "entry", "level"
_STORED = T.StructType([*RUN_LOG.fields, T.StructField(_ENTRY, T.StringType())])
#: Files of a level that are put together into one of the next.
WIDTH = 16


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows, some of them twice: a file stays for a while after it was put together."""
    if listed(spark, path) is None:
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).option("recursiveFileLookup", "true").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The log, empty before the first run."""
    return _stored(spark, path).dropDuplicates([_ENTRY]).drop(_ENTRY)


def next_id(spark: SparkSession, path: str) -> int:
    """The id after the highest in the log."""
    return (_stored(spark, path).agg(F.max("log_id").alias("top")).first()["top"] or 0) + 1


def append(
    spark: SparkSession,
    path: str,
    process_name: str,
    status: str,
    start_time: datetime,
    end_time: datetime | None = None,
    error_message: str | None = None,
    rows_processed: int | None = None,
    log_id: int | None = None,
) -> None:
    """Add one row; rows are never changed, the end of a run is another row."""
    log_id = next_id(spark, path) if log_id is None else log_id
    entry = uuid.uuid4().hex
    values = (
        log_id, process_name, status, start_time, end_time, error_message, rows_processed, None, entry,
    )
    row = spark.createDataFrame([values], _STORED).withColumn("created_at", F.current_timestamp())
    # a folder per entry: processes that log at the same time do not meet
    row.coalesce(1).write.parquet(f"{path}/{_LEVEL}=0/{entry}")


def _level(spark: SparkSession, path: str, level: int) -> dict[str, set[str]]:
    """The folders of a level with the entries in them."""
    if listed(spark, f"{path}/{_LEVEL}={level}") is None:
        return {}
    stored = spark.read.schema(_STORED).option("recursiveFileLookup", "true").parquet(f"{path}/{_LEVEL}={level}")
    folder = F.regexp_extract("_metadata.file_path", r"/([0-9a-f]+)/[^/]*$", 1)
    folders: dict[str, set[str]] = {}
    for row in stored.select(folder.alias("folder"), _ENTRY).collect():
        folders.setdefault(row["folder"], set()).add(row[_ENTRY])
    return folders


def compact(spark: SparkSession, path: str, width: int = WIDTH) -> None:
    """Put files together, `width` of a level into one of the next; for the holder of the lease.

    What was put together is removed one compaction later, when nobody that listed it
    before is still reading; until then readers drop what they find twice. So a level has
    at most some 2 * `width` files, and the log's files grow with the logarithm of its
    rows. Only a level that has enough files makes the next one be looked at.
    """
    if len(listed(spark, f"{path}/{_LEVEL}=0") or ()) < width:
        return
    level, below = 0, _level(spark, path, 0)
    while len(below) >= width:
        above = _level(spark, path, level + 1)
        known = set().union(*above.values())
        for folder in [f for f, entries in below.items() if entries <= known]:
            remove(spark, f"{path}/{_LEVEL}={level}/{folder}")
            del below[folder]
        if len(below) >= width:
            folders = [f"{path}/{_LEVEL}={level}/{f}" for f in below]
            rows = spark.read.schema(_STORED).parquet(*folders).dropDuplicates([_ENTRY])
            rows.coalesce(1).write.parquet(f"{path}/{_LEVEL}={level + 1}/{uuid.uuid4().hex}")
            above = _level(spark, path, level + 1)
        level, below = level + 1, above


def status(log: DataFrame) -> DataFrame:
    """The state of each process: that of its latest row.

    A start that was refused says nothing of the run that was going on.
    """
    latest = last_per_key(
        log.where(F.col("status") != REFUSED).select("process_name", "start_time", "created_at", "log_id", "status", "error_message"),
        ["process_name"],
        ["start_time", "created_at", "log_id"],
    )
    state = (
        F.when(F.col("status") == RUNNING, RUNNING)
        .when(F.col("status") == FAILED, F.concat_ws(": ", F.lit(ERROR), "error_message"))
        .otherwise(FINISHED)
    )
    return latest.select("process_name", state.alias("state"), "start_time")


def current_state(log: DataFrame, process_name: str) -> str:
    """The state of one process, idle if it never ran."""
    row = status(log.where(F.col("process_name") == process_name)).first()
    return row["state"] if row else IDLE
