"""Dense surrogate keys without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.session import materialize

_ROW, _PART, _SHIFT = "_row", "_part", "_shift"
# monotonically_increasing_id puts the partition number above this many bits
_BITS = 33


def dense_ids(df: DataFrame, order_by: Sequence[str], id_column: str, start: int = 0) -> DataFrame:
    """Number the rows start+1, start+2, … in the order of a unique key.

    The rows are range-partitioned and sorted on the key, then written once with
    their place within the partition: range bounds are sampled anew each time a
    plan runs, so they must be fixed before the numbers can be added up. Only one
    count per partition goes through the driver.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by]
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_ROW, F.monotonically_increasing_id()),
        "ids",
    )
    counts = (
        placed.groupBy(F.shiftright(_ROW, _BITS).alias(_PART))
        .agg(F.count("*").alias("n"), F.min(_ROW).alias("first"))
        .orderBy(_PART)
        .collect()
    )
    totals = list(accumulate((r["n"] for r in counts), initial=start))
    shifts = [(r[_PART], total + 1 - r["first"]) for r, total in zip(counts, totals)]

    if len(shifts) <= 1:
        shift = shifts[0][1] if shifts else 0
        return placed.withColumn(id_column, F.col(_ROW) + F.lit(shift)).drop(_ROW)
    per_partition = df.sparkSession.createDataFrame(shifts, f"{_PART} bigint, {_SHIFT} bigint")
    return (
        placed.withColumn(_PART, F.shiftright(_ROW, _BITS))
        # one row per partition of the numbered frame: bounded, whatever the data
        .join(F.broadcast(per_partition), _PART)
        .withColumn(id_column, F.col(_ROW) + F.col(_SHIFT))
        .drop(_ROW, _PART, _SHIFT)
    )


def highest_id(df: DataFrame, id_column: str) -> int:
    """The highest id in use, 0 if none."""
    return df.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).first()["top"]
