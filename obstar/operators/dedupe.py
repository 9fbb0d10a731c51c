"""One row per key: the first or the last in a stated order.

A frame has no order of its own, so the order is always given. Columns it does
not mention are appended to it, which makes the outcome independent of the
partitioning. Every map task keeps at most one row per key before the shuffle,
so a key that holds a large part of the data does not travel whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "_rank"


def total_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[str]:
    named = [c for c in order_by if c not in keys]
    return named + [c for c in df.columns if c not in keys and c not in named]


def _one_per_key(df: DataFrame, keys: Sequence[str], order: list) -> DataFrame:
    if not order:  # the key is the whole row
        return df.dropDuplicates(list(keys))
    window = W.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in total_order(df, keys, order_by)]
    return _one_per_key(df, keys, order)


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in total_order(df, keys, order_by)]
    return _one_per_key(df, keys, order)
