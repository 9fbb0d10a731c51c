"""What a warehouse serves."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.operators import presence, serving
from obstar.plans.star import star_of
from obstar.sources.warehouse import PART, DayKey, PartKey, Snapshot


def _in_period(snapshot: Snapshot, start: date | None, end: date | None) -> set[DayKey]:
    return {
        day
        for day in snapshot.days
        if (start is None or day >= (start.year, start.month, start.day))
        and (end is None or day <= (end.year, end.month, end.day))
    }


def parts_with(snapshot: Snapshot, city: str, days: set[DayKey] | None = None) -> set[PartKey]:
    """The parts that hold facts of a city, as the bitmaps of locations tell it."""
    ids = snapshot.dim("DimLieux").where(F.col("nom_ville") == city).select("id_dim_lieu")
    held = presence.holding(snapshot.presence(days), ids, "id_dim_lieu")
    return {tuple(r) for r in held.select(*PART).distinct().collect()}


def _newest(snapshot: Snapshot, parts: set[PartKey], n: int, city: str) -> set[PartKey]:
    """The parts of the latest days that together have n facts of a city."""
    wanted: set[PartKey] = set()
    found, step = 0, 1
    left = sorted({p[:3] for p in parts}, reverse=True)
    ids = [r["id_dim_lieu"] for r in snapshot.dim("DimLieux").where(F.col("nom_ville") == city).collect()]
    while left and found < n:
        # twice as many days each time: few passes, and at most twice the days needed
        days, left = set(left[:step]), left[step:]
        some = {p for p in parts if p[:3] in days}
        found += snapshot.fact(some).where(F.col("id_dim_lieu_fk").isin(ids)).count()
        wanted |= some
        step *= 2
    return wanted


def latest(
    snapshot: Snapshot,
    n: int | None = serving.DEFAULT,
    city: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """The newest n facts, reading only the parts that can hold them.

    Without n, a city or period has all its facts, and the list without a filter 1000.
    Without a filter the last days that have n facts between them are read; with
    a period, the days of the period; with a city, the parts that hold it, with n from the
    newest on until the city has n facts. Published facts have all their parents, so the
    dimensions need not be asked before the cut.
    """
    n = serving.newest_of(n, city, start, end)
    days = _in_period(snapshot, start, end)
    if city is None:
        if n is not None and len(days) == len(snapshot.days):
            days &= snapshot.newest_days(n)
        parts = snapshot.parts_of(days)
    else:
        parts = parts_with(snapshot, city, days)
        if n is not None:
            parts = _newest(snapshot, parts, n, city)
    return serving.latest(star_of(snapshot, parts), n, city, start, end, checked_keys=True)


def coverage(
    snapshot: Snapshot,
    expected: DataFrame,
    by: Sequence[str] = (),
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """How many of the expected cities have facts in a period, from the bitmaps alone.

    `expected` has the names of the cities as `nom`; `by` cuts the period into years
    (annee), months (annee, mois) or days.
    """
    names = expected.select("nom").distinct()
    known = snapshot.dim("DimLieux").select(F.col("nom_ville").alias("nom"), "id_dim_lieu").join(names, "nom")
    seen = presence.merged(snapshot.presence(_in_period(snapshot, start, end)), by)
    # a city has one id, so each id that is there is a city
    met = presence.holding(seen, known.select("id_dim_lieu"), "id_dim_lieu").groupBy(*by).agg(F.count("*").alias("seen"))
    groups = seen.select(*by).distinct() if by else None
    found = met if groups is None else groups.join(met, list(by), "left").fillna(0, ["seen"])
    total = names.count()
    return found.select(
        *by, F.lit(total).cast("bigint").alias("expected"), "seen", (F.lit(total) - F.col("seen")).alias("missing")
    )


def latest_records(snapshot: Snapshot, n: int | None = serving.DEFAULT, **filters) -> DataFrame:
    """The same as nested records."""
    return serving.nested(latest(snapshot, n, **filters))


def write_records(records: DataFrame, path: str) -> None:
    """Write nested records as JSON lines."""
    serving.as_json(records).write.mode("errorifexists").text(path)


def locations(snapshot: Snapshot) -> DataFrame:
    return serving.location_names(snapshot.dim("DimLieux"))
