"""Rows of the three dimensions, without and with surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.functions.times import calendar, time_key
from obstar.operators.numbering import dense_ids
from obstar.schemas import DIM_CONDITIONS, DIM_LIEUX, DIM_TEMPS, TIME_KEY


def time_rows(observations: DataFrame, ts: str) -> DataFrame:
    """One row per distinct minute of the observations.

    Only the key is compared; the other columns follow from it and are added to
    the distinct minutes.
    """
    minutes = (
        observations.where(F.col(ts).isNotNull())
        .select(*[c.alias(name) for name, c in time_key(F.col(ts)).items()])
        .distinct()
    )
    described = calendar(F.col("date"))
    return minutes.select(
        "date",
        *[described[c].alias(c) for c in ("annee", "mois", "jour")],
        "heure",
        "minute",
        *[described[c].alias(c) for c in ("jour_semaine", "nom_mois")],
    )


def location_rows(locations: DataFrame) -> DataFrame:
    return locations.select(F.col("nom").alias("nom_ville"), "region", "pays").distinct()


def condition_rows(conditions: DataFrame) -> DataFrame:
    return conditions.select("code_condition", "texte_condition").distinct()


def dim_time(observations: DataFrame, ts: str) -> DataFrame:
    numbered = dense_ids(time_rows(observations, ts), TIME_KEY, "id_dim_temps")
    return numbered.select(*DIM_TEMPS.names)


def dim_location(locations: DataFrame) -> DataFrame:
    """Locations numbered by name; the name must be unique among them."""
    numbered = dense_ids(location_rows(locations), ["nom_ville"], "id_dim_lieu")
    return numbered.select(*DIM_LIEUX.names)


def dim_condition(conditions: DataFrame) -> DataFrame:
    numbered = dense_ids(condition_rows(conditions), ["code_condition"], "id_dim_condition")
    return numbered.select(*DIM_CONDITIONS.names)
