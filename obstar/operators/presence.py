"""Which ids occur in each group, as exact bitmaps.

A bitmap has a bit for each of 32768 ids that follow each other, so its size does not
depend on the rows; a group has a bitmap for each block of ids that occur in it. Bitmaps
are merged by OR, so what several groups have together needs no look at the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, BITS = "id_block", "bits"


def by(rows: DataFrame, groups: Sequence[str], id_column: str) -> DataFrame:
    """One row per group and block of ids: the bitmap, and the number of rows."""
    return rows.groupBy(*groups, F.bitmap_bucket_number(id_column).alias(BLOCK)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_column)).alias(BITS),
        F.count("*").alias("rows"),
    )


def merged(bitmaps: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The bitmaps of larger groups, or of all rows."""
    return bitmaps.groupBy(*groups, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(bitmaps: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The number of distinct ids of each group."""
    one = merged(bitmaps, groups).select(*groups, F.bitmap_count(BITS).alias("n"))
    return one.groupBy(*groups).agg(F.sum("n").alias("n"))


def has(position: Column) -> Column:
    """Whether the bit at a position of the bitmap of the row is set."""
    byte = F.conv(F.hex(F.substring(F.col(BITS), (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("bigint"), (position % 8).cast("int")) == 1


def holding(bitmaps: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """The rows of `bitmaps` that have one of the ids, with the id; one row for each."""
    wanted = ids.select(
        id_column,
        F.bitmap_bucket_number(id_column).alias("_block"),
        F.bitmap_bit_position(id_column).alias("_position"),
    )
    met = bitmaps.join(wanted, F.col(BLOCK) == F.col("_block")).where(has(F.col("_position")))
    return met.drop("_block", "_position")
