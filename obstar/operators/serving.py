"""The star join and the views served from it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obstar.functions.measures import decimals_as_double

NEWEST = ["date", "heure", "minute", "id_observation_horaire"]
# fixed values: the names of the served record
GROUPS = {
    "lieu": ["id_dim_lieu", "nom_ville", "region", "pays"],
    "temps": [
        "id_dim_temps", "date", "annee", "mois", "jour", "heure", "minute", "jour_semaine", "nom_mois",
    ],
    "condition": ["id_dim_condition", "code_condition", "texte_condition"],
}


@dataclass(frozen=True)
class Star:
    """The fact and its dimensions, each dimension unique by its id."""

    fact: DataFrame
    location: DataFrame
    time: DataFrame
    condition: DataFrame


def _newest_first() -> list[Column]:
    return [F.col(c).desc() for c in NEWEST]


def _join_location(df: DataFrame, dim: DataFrame) -> DataFrame:
    return df.join(dim.select(*GROUPS["lieu"]), F.col("id_dim_lieu_fk") == F.col("id_dim_lieu"))


def _join_time(df: DataFrame, dim: DataFrame) -> DataFrame:
    return df.join(dim.select(*GROUPS["temps"]), F.col("id_dim_temps_fk") == F.col("id_dim_temps"))


def _join_condition(df: DataFrame, dim: DataFrame) -> DataFrame:
    return df.join(
        dim.select(*GROUPS["condition"]), F.col("id_dim_condition_fk") == F.col("id_dim_condition")
    )


def star_join(star: Star) -> DataFrame:
    """Every fact with the columns of its three dimensions."""
    joined = _join_time(star.fact, star.time)
    return _join_condition(_join_location(joined, star.location), star.condition)


def _period(df: DataFrame, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("date") < F.lit(end))
    return df


#: How many facts the list without a filter has.
TOP = 1000
DEFAULT = -1


def newest_of(n: int | None, city: str | None, start: date | None, end: date | None) -> int | None:
    """The cut of a view: as asked for, else 1000 without a filter and none with one."""
    if n != DEFAULT:
        return n
    return TOP if city is None and start is None and end is None else None


def latest(
    star: Star,
    n: int | None = DEFAULT,
    city: str | None = None,
    start: date | None = None,
    end: date | None = None,
    checked_keys: bool = False,
) -> DataFrame:
    """The newest n facts of the star join, flat, in order; all with n None.

    City and period (start inclusive, end exclusive) are filtered before the cut;
    unless told otherwise only the list without a filter is cut, at 1000.
    Only the time dimension decides the order, so the others are joined to the n
    rows that are left. A fact without its parents must not take one of the n
    places: `checked_keys` says that there are none, otherwise they are dropped
    by semi-joins on the ids.
    """
    n = newest_of(n, city, start, end)
    facts = star.fact
    if city is not None:
        wanted = star.location.where(F.col("nom_ville") == city)
        facts = _semi(facts, wanted, "id_dim_lieu_fk", "id_dim_lieu")
    elif not checked_keys:
        facts = _semi(facts, star.location, "id_dim_lieu_fk", "id_dim_lieu")
    if not checked_keys:
        facts = _semi(facts, star.condition, "id_dim_condition_fk", "id_dim_condition")
    timed = _join_time(facts, _period(star.time, start, end))
    # a top-k before the wide joins; without a cut the rows are sorted once, at the end
    newest = timed if n is None else timed.orderBy(*_newest_first()).limit(n)
    joined = _join_condition(_join_location(newest, star.location), star.condition)
    columns = [*star.fact.columns, *GROUPS["lieu"], *GROUPS["temps"], *GROUPS["condition"]]
    flat = decimals_as_double(joined.select(*columns)).orderBy(*_newest_first())
    return flat if n is None else flat.limit(n)


def _semi(df: DataFrame, parent: DataFrame, fk: str, key: str) -> DataFrame:
    ids = parent.select(F.col(key).alias("_parent"))
    return df.join(ids, F.col(fk) == F.col("_parent"), "left_semi")


def nested(flat: DataFrame) -> DataFrame:
    """The served record: dimension columns gathered into structs, ISO dates."""
    inner = {c for columns in GROUPS.values() for c in columns}
    own = [c for c in flat.columns if c not in inner]
    iso = flat.withColumn("date", F.col("date").cast("string"))
    return iso.select(*own, *[F.struct(*columns).alias(name) for name, columns in GROUPS.items()])


def as_json(records: DataFrame) -> DataFrame:
    """One JSON object per record; absent values are written as null."""
    whole = F.struct(*records.columns)
    return records.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("json"))


def location_names(dim: DataFrame) -> DataFrame:
    return dim.select("nom_ville").distinct().orderBy("nom_ville")
