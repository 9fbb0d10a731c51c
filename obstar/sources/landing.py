"""The landing folder: files of JSON lines, one record each.

A record's position is its file, the place in the file where the part that Spark read it
with begins, and its place among the rows of that part. Parts are read from front to back,
so positions have the order of the lines, however the files are cut. They are compared,
never counted: of two, the smaller one came first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT, SOURCE, BLOCK, PLACE = "text", "source", "block", "place"
#: The order in which records arrived.
ARRIVAL = [SOURCE, BLOCK, PLACE]


def _records(lines: DataFrame) -> DataFrame:
    """Each non-blank line with the file and the part of it that it came from."""
    named = lines.select(
        F.col("value").alias(TEXT),
        F.col("_metadata.file_path").alias(SOURCE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )
    return named.where(F.trim(TEXT) != "")


def placed(records: DataFrame) -> DataFrame:
    """Records with their whole position, what is missing of it added.

    A stream cannot number rows, so its batches get the place here; it must be asked for
    before anything moves the rows.
    """
    if SOURCE not in records.columns:
        records = records.withColumn(SOURCE, F.lit(None).cast("string"))
    if BLOCK not in records.columns:
        records = records.withColumn(BLOCK, F.lit(0).cast("bigint"))
    if PLACE not in records.columns:
        records = records.withColumn(PLACE, F.monotonically_increasing_id())
    return records


def read(spark: SparkSession, path: str) -> DataFrame:
    return placed(_records(spark.read.text(path)))


def read_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The files as they arrive, at most `max_files` to a batch."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _records(reader.load(path))
