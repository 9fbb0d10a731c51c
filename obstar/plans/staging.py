"""The three staging relations of one run, replaced as a whole each time."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obstar.functions import times
from obstar.operators import conflicts, ingest
from obstar.operators.dedupe import first_per_key
from obstar.operators.keys import lookup, present_in
from obstar.operators.numbering import dense_ids
from obstar.schemas import CONDITIONS_METEO, DONNEES_METEO, LIEUX, MEASURES, STAGING
from obstar.session import remove, side_by_side
from obstar.sources import numbered
from obstar.sources.landing import ARRIVAL

_NAME = ["nom", "region", "pays"]
_LAST = "last_seen"
_POINTERS, _POINTER = "current", "token STRING"


@dataclass(frozen=True)
class Staging:
    locations: DataFrame
    conditions: DataFrame
    observations: DataFrame

    def is_empty(self) -> bool:
        """True if any of the three has no row: there is nothing to load then."""
        return any(df.isEmpty() for df in (self.locations, self.conditions, self.observations))


def build(flat: DataFrame) -> Staging:
    """From flattened records (with their position) to the three relations.

    First come, first kept, in the order of the files and of the lines in them. A time
    that cannot be read fails the run. Observations whose condition was not kept
    are left out, as a foreign key would do. Locations are numbered in the order
    in which they were last seen, so of two the higher number came later.
    """
    spark = flat.sparkSession
    conditions, locations = side_by_side(
        lambda: conflicts.insert_ignore_all(
            spark.createDataFrame([], CONDITIONS_METEO),
            flat.select("code_condition", "texte_condition", *ARRIVAL),
            [["code_condition"], ["texte_condition"]],
            ARRIVAL,
        ),
        lambda: dense_ids(
            flat.groupBy(*_NAME).agg(F.max(F.struct(*ARRIVAL)).alias(_LAST)), [_LAST, *_NAME], "id_lieu"
        ).select(*LIEUX.names),
    )
    placed = lookup(flat, locations, _NAME, ["id_lieu"], nullable=["region"])
    timed = placed.withColumn("datetime_observation", times.parse_strict(F.col("datetime_observation")))
    known = present_in(timed, conditions, ["code_condition"]).select(
        *ARRIVAL, "id_lieu", "datetime_observation", *MEASURES, "code_condition"
    )
    kept = first_per_key(known, ["id_lieu", "datetime_observation"], ARRIVAL)
    # nobody refers to these ids: unique is enough, and needs no sort
    numbered = kept.withColumn("id_observation_horaire", F.monotonically_increasing_id() + 1)
    return Staging(locations, conditions, numbered.select(*DONNEES_METEO.names))


def empty(spark: SparkSession) -> Staging:
    return Staging(*[spark.createDataFrame([], schema) for schema in STAGING.values()])


def replace(staging: Staging, root: str) -> Staging:
    """Write the relations to a new folder, make it the current one, and return them.

    Numbered records name the folders; the highest one is the current. A load that dies
    between its writes leaves the record before it in force. The folder before the current
    one is removed once there is a new record.
    """
    run = uuid.uuid4().hex
    spark = staging.locations.sparkSession
    frames = (staging.locations, staging.conditions, staging.observations)

    def store(name: str, schema: StructType, df: DataFrame) -> None:
        path = f"{root}/staging/{run}/{name}"
        df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.parquet(path)

    side_by_side(*[partial(store, *table, df) for table, df in zip(STAGING.items(), frames)])
    number, before = _current_run(spark, root)
    numbered.append(spark, f"{root}/staging/{_POINTERS}", number + 1, (run,), _POINTER, run)
    if before is not None:
        remove(spark, f"{root}/staging/{before}")
    return read(spark, root)


def _current_run(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The number of the current record and the folder it names."""
    folder = f"{root}/staging/{_POINTERS}"
    number = numbered.latest(spark, folder)
    if not number:
        return 0, None
    row = numbered.read(spark, folder, number, _POINTER)
    if row is None:
        raise numbered.Taken(f"record {number} of {folder} is not one record")
    return number, row["token"]


def read(spark: SparkSession, root: str) -> Staging:
    """The current staging, empty before the first run."""
    _, run = _current_run(spark, root)
    if run is None:
        return empty(spark)
    base = f"{root}/staging/{run}"
    return Staging(
        *[spark.read.schema(schema).parquet(f"{base}/{name}") for name, schema in STAGING.items()]
    )
