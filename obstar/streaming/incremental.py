"""The same load for the files that have arrived since the last run.

The target tables are the state: there is no watermark, a late observation is
accepted and the last arrival of a key wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from obstar.plans import batch
from obstar.session import configure
from obstar.sources import landing

# The identity of a streaming query, kept in its checkpoint, as Spark tells it to a batch.
_QUERY_ID = "sql.streaming.queryId"


def start(
    spark: SparkSession,
    landing_path: str,
    root: str,
    checkpoint: str,
    name: str = "landing",
    on_overflow: str = "reject",
    max_files: int | None = None,
    trigger: dict | None = None,
    on_bad_time: str = "fail",
    expected: DataFrame | Sequence[str] | None = None,
) -> StreamingQuery:
    """Load new files batch by batch; by default until none is left.

    A second start while the first one runs is refused; Spark's default would
    stop the running one. Batches are numbered by checkpoint: one that is replayed
    after a failure is recognised by the identity the checkpoint keeps and its
    number, and skipped if it had been published. Another checkpoint is another
    stream, whatever its name, which only stands in the commit records. `trigger`
    takes the arguments of DataStreamWriter.trigger.
    """
    configure(spark)
    spark.conf.set("spark.sql.streaming.stopActiveRunOnRestart", "false")

    def load(records: DataFrame, number: int) -> None:
        identity = spark.sparkContext.getLocalProperty(_QUERY_ID)
        if not identity:
            raise RuntimeError("the batch does not say which stream it belongs to")
        batch.load(
            spark, records, root, on_overflow, f"{name}-{identity}-{number}", (identity, number),
            on_bad_time, expected,
        )

    stream = landing.read_stream(spark, landing_path, max_files)
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
