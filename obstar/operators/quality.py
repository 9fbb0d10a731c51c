"""Constraint checks, completeness and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obstar.operators.keys import absent_from
from obstar.schemas import EXPECTED_CITIES


class ConstraintViolation(RuntimeError):
    """Rows that must not be published."""


class Guard:
    """Constraints of rows, counted as they are written.

    `rows` are the rows with the counters in their plan: writing them fills the counters,
    nothing is read for the checks alone. `parents` is as for `orphans`.
    """

    def __init__(
        self,
        df: DataFrame,
        not_null: Sequence[str] = (),
        parents: Mapping[str, tuple[DataFrame, str]] | None = None,
    ):
        parents = parents or {}
        self._seen = Observation()
        counters = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in not_null]
        counters += [F.count_if(_orphan(fk)).alias(f"orphan {fk}") for fk in parents]
        flagged = _with_parents(df, parents)
        self.rows = flagged.observe(self._seen, F.count(F.lit(1)).alias("rows"), *counters).select(*df.columns)

    def checked(self) -> int:
        """The number of rows that were written; fails if a constraint does not hold."""
        counts = self._seen.get
        broken = {k: n for k, n in counts.items() if k != "rows" and n}
        if broken:
            raise ConstraintViolation(", ".join(f"{k}: {n}" for k, n in sorted(broken.items())))
        return counts["rows"]


def check_unique(batch: DataFrame, keys: Sequence[str], offered: int, met: int, added: int) -> None:
    """Uniqueness, asked of the keys that a batch brings only.

    `batch` is the batch, which must not have a key twice; of `offered` keys `met` were
    found in the target and `added` were not: more in all means that the target had one
    twice.
    """
    twice = duplicate_keys(batch, keys).agg(F.count("*").alias("n")).first()["n"]
    if twice or met + added != offered:
        told = f"{twice} twice in the batch, {met + added - offered} more in the table"
        raise ConstraintViolation(f"unique {', '.join(keys)}: {told}")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column that must not have any, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows that point to a missing parent.

    `parents` maps a foreign key column to the parent frame and its key column.
    """
    flagged = _with_parents(df, parents)
    return flagged.where(reduce(or_, [_orphan(fk) for fk in parents])).select(*df.columns)


def orphan_counts(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows checked and, per foreign key, rows without a parent, in one pass."""
    flagged = _with_parents(df.select(*parents), parents)
    return flagged.agg(
        F.count("*").alias("checked"),
        *[F.count_if(_orphan(fk)).alias(f"orphans_{fk}") for fk in parents],
    )


def _orphan(fk: str) -> Column:
    return F.col(fk).isNotNull() & F.col(f"_has_{fk}").isNull()


def _with_parents(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    for fk, (parent, key) in parents.items():
        present = parent.select(F.col(key).alias(f"_id_{fk}"), F.lit(True).alias(f"_has_{fk}"))
        df = df.join(present, F.col(fk) == F.col(f"_id_{fk}"), "left").drop(f"_id_{fk}")
    return df


def coverage(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """How many of the expected keys were observed."""
    seen = observed.select(F.col(key).alias("_seen")).distinct()
    joined = expected.select(key).distinct().join(seen, F.col(key) == F.col("_seen"), "left")
    return joined.agg(
        F.count("*").alias("expected"),
        F.count("_seen").alias("seen"),
        F.count_if(F.col("_seen").isNull()).alias("missing"),
    )


def missing_keys(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Expected keys that were not observed."""
    return absent_from(expected.select(key).distinct(), observed.select(key).distinct(), [key])


def expected_cities(spark: SparkSession) -> DataFrame:
    """The cities a complete run covers."""
    return spark.createDataFrame([(c,) for c in EXPECTED_CITIES], "city string")
