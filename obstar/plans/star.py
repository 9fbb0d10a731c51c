"""Loading one staged batch into the star schema."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from obstar.operators import dims, facts, merge, quality
from obstar.operators.dedupe import last_per_key
from obstar.operators.keys import present_in
from obstar.operators.numbering import dense_ids, highest_id
from obstar.operators.serving import Star
from obstar.plans.staging import Staging
from obstar.schemas import CONDITION_KEY, FACT_KEY, LOCATION_KEY, MEASURES, TIME_KEY
from obstar.session import materialize, side_by_side
from obstar.sources import warehouse
from obstar.sources.warehouse import BUCKET, DAY, FACT, LOCATION, PART, PartKey, Snapshot

_ARRIVAL = "id_observation_horaire"
_TIME = "datetime_observation"


@dataclass(frozen=True)
class Loaded:
    """What a load would publish, and what it left out."""

    snapshot: Snapshot
    rejects: DataFrame
    observations: int
    dropped: int
    facts: int
    actions: dict[str, dict[str, int]]


@dataclass(frozen=True)
class Merged:
    """A dimension after the merge, the version that has it, and what the merge did."""

    name: str
    version: str
    rows: DataFrame
    did: dict[str, int]


def star_of(snapshot: Snapshot, parts: Collection[PartKey] | None = None) -> Star:
    """The tables of a snapshot, the fact without its storage columns."""
    return Star(
        snapshot.fact(parts).drop(*PART),
        snapshot.dim("DimLieux"),
        snapshot.dim("DimTemps"),
        snapshot.dim("DimConditionsMeteo"),
    )


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """A frame as stored, and its rows, counted as they were written."""
    seen = Observation()
    stored = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return stored, seen.get["n"]


def load(staging: Staging, base: Snapshot) -> Loaded:
    """Write the dimensions and touched parts of the next snapshot.

    Dimensions take every staged row, also of observations that will be dropped.
    Keys are looked up in the merged dimensions, so rows of earlier runs count. A
    dimension that the batch neither adds to nor changes keeps its version. The parts
    (days and buckets of locations) that the batch's keys fall into are read once. What is
    written is checked as it is written: a key that is NULL, twice there, or without its
    parent fails the load. Nothing is visible to readers until the result is published.
    """
    version = warehouse.new_version(base)
    observations = staging.observations

    def kept_or(name: str, did: dict[str, int], key: list[str], merged: Callable[[], DataFrame]) -> Merged:
        if name in base.dims and not did[merge.INSERTED] + did[merge.UPDATED]:
            return Merged(name, base.dims[name], base.dim(name), did)
        guard = quality.Guard(merged(), not_null=key)
        rows = warehouse.write_dim(base, name, guard.rows, version)
        guard.checked()
        return Merged(name, version, rows, did)

    def merge_dim(name: str, rows: DataFrame, key: list[str], order: list[str], ids: str) -> Merged:
        target = base.dim(name)
        arriving, offered = _counted(last_per_key(rows, key, order), "arriving")
        values = [c for c in target.columns if c in arriving.columns and c not in key and c != ids]
        done = merge.apply(target, arriving, key, values)
        quality.check_unique(arriving, key, offered, done.matched, done.did[merge.INSERTED])
        return kept_or(
            name, done.did, key, lambda: merge.numbered(done, target, key, ids, highest_id(target, ids))
        )

    def merge_times() -> tuple[DataFrame, Merged]:
        minutes, offered = _counted(dims.time_rows(observations, _TIME), "minutes")
        target = base.dim("DimTemps")
        fresh, new = _counted(merge.fresh_rows(target, minutes, TIME_KEY, one_per_key=True), "fresh-minutes")
        did = {merge.INSERTED: new, merge.UPDATED: 0, merge.UNCHANGED: offered - new, "affected": new}

        def merged() -> DataFrame:
            start = highest_id(target, "id_dim_temps")
            added = dense_ids(fresh, TIME_KEY, "id_dim_temps", start=start)
            return target.unionByName(added.select(*target.columns))

        return minutes, kept_or("DimTemps", did, TIME_KEY, merged)

    # a city seen twice keeps the names of the location that was seen last
    cities = staging.locations.withColumnRenamed("nom", "nom_ville")
    texts = dims.condition_rows(staging.conditions)
    conditions, locations, (minutes, times) = side_by_side(
        lambda: merge_dim("DimConditionsMeteo", texts, CONDITION_KEY, CONDITION_KEY, "id_dim_condition"),
        lambda: merge_dim("DimLieux", cities, LOCATION_KEY, ["id_lieu"], "id_dim_lieu"),
        merge_times,
    )

    # only the batch's minutes are looked up: small enough to broadcast in a regular run
    batch_times = materialize(present_in(times.rows, minutes, TIME_KEY), "batch-times")
    resolved = facts.resolve(observations, staging.locations, locations.rows, conditions.rows, batch_times)
    seen = Observation()
    unkeyed = F.greatest(*[F.col(k).isNull() for k in facts.FOREIGN_KEYS])
    keyed = materialize(
        resolved.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(unkeyed).alias("dropped")), "keyed"
    )
    place = {"annee": F.year(_TIME), "mois": F.month(_TIME), "jour": F.dayofmonth(_TIME)}
    stored_by = keyed.withColumns(place | {BUCKET: base.bucket_of(F.col(LOCATION))})
    # staging has one row per location and minute
    rows, offered = _counted(facts.fact_rows(stored_by, MEASURES, [], extra=PART, one_per_key=True), "facts")

    touched = {tuple(r) for r in rows.select(*PART).distinct().collect()}
    target = base.fact(touched)
    values = [c for c in rows.columns if c not in (*FACT_KEY, *PART)]
    done = merge.apply(target, rows, FACT_KEY, values)
    quality.check_unique(rows, FACT_KEY, offered, done.matched, done.did[merge.INSERTED])
    guard = quality.Guard(
        merge.numbered(done, target, FACT_KEY, _ARRIVAL, base.top_fact_id),
        not_null=[_ARRIVAL, *facts.FOREIGN_KEYS],
        parents={
            "id_dim_lieu_fk": (locations.rows, "id_dim_lieu"),
            "id_dim_condition_fk": (conditions.rows, "id_dim_condition"),
            "id_dim_temps_fk": (_minutes_of(times.rows, touched), "id_dim_temps"),
        },
    )
    written = warehouse.write_parts(base, guard.rows, version, touched)
    if touched:
        guard.checked()
    after = replace(
        base,
        dims={m.name: m.version for m in (times, locations, conditions)},
        parts=(*[p for p in base.parts if p.key not in touched], *written),
        top_fact_id=base.top_fact_id + done.did[merge.INSERTED],
    )
    return Loaded(
        after,
        facts.unresolved(keyed, observations.columns),
        seen.get["read"],
        seen.get["dropped"],
        offered,
        {m.name: m.did for m in (times, locations, conditions)} | {FACT: done.did},
    )


def _minutes_of(times: DataFrame, parts: Collection[PartKey]) -> DataFrame:
    """The minutes of the days of some parts."""
    days = times.sparkSession.createDataFrame(sorted({p[:3] for p in parts}), ", ".join(f"{c} int" for c in DAY))
    return present_in(times, days, DAY)
