"""Joins on a natural key.

Key columns are NOT NULL and compared with plain equality, except those listed
in `nullable`, where NULL equals NULL. Plain equality is kept wherever it can be:
its hash partitioning is shared with the deduplication of the same key.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PREFIX = "_k_"


def prefixed(df: DataFrame, keys: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """The key columns under private names, and the other columns asked for."""
    return df.select(*[F.col(k).alias(_PREFIX + k) for k in keys], *values)


def matches(keys: Sequence[str], nullable: Collection[str] = ()) -> Column:
    """Join condition between key columns and their prefixed counterparts."""
    return reduce(
        and_,
        [
            F.col(k).eqNullSafe(F.col(_PREFIX + k)) if k in nullable else F.col(k) == F.col(_PREFIX + k)
            for k in keys
        ],
    )


def drop_prefixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.drop(*[_PREFIX + k for k in keys])


def present_in(
    df: DataFrame, other: DataFrame, keys: Sequence[str], nullable: Collection[str] = ()
) -> DataFrame:
    """Rows whose key occurs in `other`."""
    return df.join(prefixed(other, keys), matches(keys, nullable), "left_semi")


def absent_from(
    df: DataFrame, other: DataFrame, keys: Sequence[str], nullable: Collection[str] = ()
) -> DataFrame:
    """Rows whose key does not occur in `other`."""
    return df.join(prefixed(other, keys), matches(keys, nullable), "left_anti")


def lookup(
    df: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    nullable: Collection[str] = (),
) -> DataFrame:
    """Add the `values` of the row of `other` with the same key, or NULL.

    `other` must be unique by key, otherwise rows would multiply.
    """
    joined = df.join(prefixed(other, keys, values), matches(keys, nullable), "left")
    return drop_prefixed(joined, keys)
