"""Resolving natural keys to surrogate keys, and the rows of the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.functions.times import time_key
from obstar.operators.dedupe import last_per_key
from obstar.operators.keys import lookup
from obstar.schemas import CONDITION_KEY, FACT_KEY, TIME_KEY

FOREIGN_KEYS = ["id_dim_lieu_fk", "id_dim_temps_fk", "id_dim_condition_fk"]


def with_location(observations: DataFrame, locations: DataFrame) -> DataFrame:
    """Each observation with the natural key of its location, if known."""
    return lookup(observations, locations, ["id_lieu"], ["nom", "region", "pays"])


def location_keys(locations: DataFrame, dim: DataFrame) -> DataFrame:
    """The surrogate key of each source location; all three names must agree,
    a missing region with a missing region."""
    known = dim.select(
        F.col("nom_ville").alias("nom"), "region", "pays", F.col("id_dim_lieu").alias("id_dim_lieu_fk")
    )
    return lookup(locations, known, ["nom", "region", "pays"], ["id_dim_lieu_fk"], nullable=["region"])


def resolve_location(observations: DataFrame, locations: DataFrame, dim: DataFrame) -> DataFrame:
    """Add id_dim_lieu_fk.

    Source locations are joined with the dimension first, so that the
    observations are joined once, on one integer, and carry no names.
    """
    keys = location_keys(locations, dim)
    return lookup(observations, keys, ["id_lieu"], ["id_dim_lieu_fk"])


def resolve_condition(observations: DataFrame, dim: DataFrame) -> DataFrame:
    known = dim.select("code_condition", F.col("id_dim_condition").alias("id_dim_condition_fk"))
    return lookup(observations, known, CONDITION_KEY, ["id_dim_condition_fk"])


def resolve_time(observations: DataFrame, dim: DataFrame, ts: str) -> DataFrame:
    known = dim.select(*TIME_KEY, F.col("id_dim_temps").alias("id_dim_temps_fk"))
    keyed = observations.withColumns(time_key(F.col(ts)))
    return lookup(keyed, known, TIME_KEY, ["id_dim_temps_fk"]).drop(*TIME_KEY)


def resolve(
    observations: DataFrame,
    locations: DataFrame,
    dim_location: DataFrame,
    dim_condition: DataFrame,
    dim_time: DataFrame,
    ts: str = "datetime_observation",
) -> DataFrame:
    """Observations with a parsed time and their three keys, NULL if unknown."""
    timed = observations.where(F.col(ts).isNotNull())
    located = resolve_location(timed, locations, dim_location)
    return resolve_time(resolve_condition(located, dim_condition), dim_time, ts)


def resolved(keyed: DataFrame) -> DataFrame:
    return keyed.dropna(subset=FOREIGN_KEYS, how="any")


def unresolved(keyed: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Observations that cannot become facts, with the keys that failed."""
    failed = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in FOREIGN_KEYS]))
    return keyed.select(*carried, F.array_join(failed, ",").alias("failed_keys")).where(
        F.col("failed_keys") != ""
    )


def fact_rows(
    keyed: DataFrame,
    measures: Sequence[str],
    order_by: Sequence[str],
    extra: Sequence[str] = (),
    one_per_key: bool = False,
) -> DataFrame:
    """One row per location and minute: the last in the given order.

    `one_per_key` says that the observations have one row per location and minute
    already, so there is nothing to shuffle.
    """
    columns = dict.fromkeys([*FOREIGN_KEYS, *measures, *extra, *order_by])
    kept = resolved(keyed).select(*columns)
    if not one_per_key:
        kept = last_per_key(kept, FACT_KEY, order_by)
    return kept.select(*FOREIGN_KEYS, *measures, *extra)
