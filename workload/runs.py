"""Whole runs over records made of events: landing files, two loads, what is published.

Two loads get half of the events each, in several files. Customers whose name ends in 7
move to another country after the first quarter of the events, so the first load sees
them in two countries.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obstar.functions.measures import decimals_as_double
from obstar.operators import ingest, quality, serving
from obstar.operators.dedupe import first_per_key, last_per_key
from obstar.plans import batch, staging, views
from obstar.plans.star import star_of
from obstar.schemas import MEASURES
from obstar.session import materialize, scratch_root
from obstar.sources import landing, lease, rejects, runlog, warehouse
from obstar.sources.warehouse import DAY, LOCATION, PART
from obstar.streaming import incremental
from workload import mappings as M

EVENTS_PER_FILE, FIRST_FILE, ELSEWHERE = 500, 10**9, "AAA"
#: Files grow with the events until they have a good size; then their number does.
FILES, MOST_PER_FILE = 200, 50_000
CITY = "Customer#000000007"


def events_per_file(total: int) -> int:
    """How many event numbers that follow each other go to one landing file."""
    return max(EVENTS_PER_FILE, min(-(-total // FILES), MOST_PER_FILE))


def landing_files(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """One folder per half; files follow each other by name, and lines in them, as the events do."""
    total = M.table(spark, sf_dir, "events").agg(F.max("event_id") + 1).first()[0] or 0
    event = F.col("event_id")
    moved = (event >= total // 4) & F.col("text").rlike('"name":"[^"]*7"')
    elsewhere = F.regexp_replace("text", '"country":"[^"]*"', f'"country":"{ELSEWHERE}"')
    rows = M.records(spark, sf_dir).select(
        F.when(event < total // 2, 1).otherwise(2).alias("half"),
        (F.floor(event / events_per_file(total)) + FIRST_FILE).alias("file"),  # as many digits each
        "event_id",
        F.when(moved, elsewhere).otherwise(F.col("text")).alias("text"),
    )
    _in_order(rows, ["half", "file"], ["event_id"], folder)


def _in_order(rows: DataFrame, files: list[str], order: list[str], folder: str) -> None:
    """Add a text file per value of `files`, its lines in order."""
    # numbers as folders: text would be looked at once more and sorted again
    ordered = rows.repartition(*files).sortWithinPartitions(*files, *order)
    ordered.select(*files, "text").write.mode("append").partitionBy(*files).text(folder)


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.table(spark, sf_dir, "customer").select(F.col("c_name").alias("nom"))


def _new_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/obstar-runs/{uuid.uuid4().hex}"


@lru_cache(maxsize=8)
def _loaded(spark: SparkSession, application: str, sf_dir: str, tables: tuple) -> str:
    """The root of a warehouse after both loads."""
    folder = _new_folder(spark)
    landing_files(spark, sf_dir, f"{folder}/landing")
    for half in "12":
        batch.run(
            spark, f"{folder}/landing/half={half}", f"{folder}/warehouse", batch=f"half-{half}",
            expected=cities(spark, sf_dir),
        )
    return f"{folder}/warehouse"


@lru_cache(maxsize=8)
def _streamed(spark: SparkSession, application: str, sf_dir: str, tables: tuple) -> str:
    """The same by a stream: the second half arrives after the first was loaded."""
    folder = _new_folder(spark)
    landing_files(spark, sf_dir, f"{folder}/landing")
    for half in "12":
        arrived = spark.read.text(f"{folder}/landing/half={half}").select(
            F.col("value").alias("text"), "file", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n")
        )
        _in_order(arrived, ["file"], ["file_block_start", "n"], f"{folder}/stream")
        incremental.start(
            spark, f"{folder}/stream", f"{folder}/warehouse", f"{folder}/checkpoint",
            expected=cities(spark, sf_dir),
        ).awaitTermination()
    return f"{folder}/warehouse"


def forget() -> None:
    """Load anew at the next call."""
    _loaded.cache_clear()
    _streamed.cache_clear()
    _guarded.cache_clear()


def _files(spark: SparkSession, sf_dir: str) -> tuple:
    """The files that the runs read: changed tables are loaded anew."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    found = listing.load([f"{sf_dir}/{t}.parquet" for t in ("events", "customer", "nation", "region")])
    return tuple(map(tuple, found.select("path", "modificationTime", "length").sort("path").collect()))


def loaded(spark: SparkSession, sf_dir: str) -> str:
    return _loaded(spark, spark.sparkContext.applicationId, sf_dir, _files(spark, sf_dir))


def streamed(spark: SparkSession, sf_dir: str) -> str:
    return _streamed(spark, spark.sparkContext.applicationId, sf_dir, _files(spark, sf_dir))


def _served(spark: SparkSession, root: str) -> DataFrame:
    joined = serving.star_join(star_of(warehouse.current(spark, root)))
    return decimals_as_double(
        joined.select(
            "id_observation_horaire", "id_dim_lieu", "id_dim_temps", "id_dim_condition", "nom_ville",
            "region", "pays", "date", "heure", "minute", "texte_condition", *MEASURES,
        )
    )


def pipeline_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star join of what two loads published."""
    return _served(spark, loaded(spark, sf_dir))


def stream_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star join of what a stream published in two runs."""
    return _served(spark, streamed(spark, sf_dir))


def pipeline_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three dimensions after the second load."""
    snapshot = warehouse.current(spark, loaded(spark, sf_dir))
    location = snapshot.dim("DimLieux").select(
        F.lit("DimLieux").alias("dimension"), F.col("id_dim_lieu").alias("id"),
        F.concat_ws("|", "nom_ville", "region", "pays").alias("value"),
    )
    minute = snapshot.dim("DimTemps").select(
        F.lit("DimTemps"), "id_dim_temps", F.concat_ws("|", "date", "heure", "minute", "jour_semaine", "nom_mois")
    )
    condition = snapshot.dim("DimConditionsMeteo").select(
        F.lit("DimConditionsMeteo"), "id_dim_condition", F.concat_ws("|", "code_condition", "texte_condition")
    )
    return location.union(minute).union(condition)


def pipeline_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations staged by the second load, with their location."""
    staged = staging.read(spark, loaded(spark, sf_dir))
    placed = staged.observations.join(staged.locations, "id_lieu")
    return decimals_as_double(
        placed.select("id_lieu", "nom", "region", "pays", "datetime_observation", *MEASURES, "code_condition")
    )


def pipeline_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations that could not become facts, of both loads."""
    kept = rejects.read(spark, loaded(spark, sf_dir), rejects.OBSERVATIONS)
    return decimals_as_double(
        kept.select("batch", "commit", "id_lieu", "datetime_observation", *MEASURES, "code_condition", "failed_keys")
    )


def pipeline_record_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected fields, with how many of them have the text of their record."""
    kept = rejects.read(spark, loaded(spark, sf_dir), rejects.RECORDS)
    return kept.groupBy("batch", "commit", "field", "reason").agg(
        F.count("*").alias("n"), F.count("text").alias("with_text")
    )


def pipeline_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each load says of itself."""
    told = warehouse.history(spark, loaded(spark, sf_dir))
    wanted = {
        "records": "records", "valid": "valid", "observations": "observations", "dropped": "dropped",
        "facts": "facts", "cities_expected": "cities.expected", "cities_seen": "cities.seen",
        "inserted": "FaitDonneesMeteo.inserted",
    }
    return told.select("number", "batch", *[F.col("counts")[k].alias(n) for n, k in wanted.items()])


def pipeline_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of both loads, without times."""
    log = runlog.read(spark, batch.log_path(loaded(spark, sf_dir)))
    return log.select("log_id", "process_name", "status", "rows_processed", "error_message")


def pipeline_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of the fact, with the load that wrote each, as its files' names tell."""
    snapshot = warehouse.current(spark, loaded(spark, sf_dir))
    wrote = F.regexp_extract(F.input_file_name(), r"/version=(\d+)-", 1).cast("bigint")
    return snapshot.fact().groupBy(*PART, wrote.alias("wrote")).agg(F.count("*").alias("facts"))


def pipeline_city_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts that are read for the facts of one city, and how many of its facts they hold."""
    snapshot = warehouse.current(spark, loaded(spark, sf_dir))
    dim = snapshot.dim("DimLieux").where(F.col("nom_ville") == CITY).select(F.col("id_dim_lieu").alias(LOCATION))
    read = snapshot.fact(views.parts_with(snapshot, CITY))
    mine = read.join(dim.withColumn("mine", F.lit(1)), LOCATION, "left")
    return mine.groupBy(*PART).agg(F.count("*").alias("facts"), F.count("mine").alias("of_city"))


def pipeline_day_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the expected cities have facts on each day, from the bitmaps."""
    snapshot = warehouse.current(spark, loaded(spark, sf_dir))
    return views.coverage(snapshot, cities(spark, sf_dir), DAY)


@lru_cache(maxsize=8)
def _guarded(spark: SparkSession, application: str, sf_dir: str, tables: tuple) -> str:
    """A warehouse that loads were kept from, or that was taken back.

    A load while another holds the lease; the first half once that lease has run out; a
    landing folder without a valid record; the first half again while cities are missing in
    the dimension; a reset; the second half.
    """
    folder = _new_folder(spark)
    root, landed = f"{folder}/warehouse", f"{folder}/landing"
    landing_files(spark, sf_dir, landed)

    def run(path: str, refused: type[Exception] | None = None) -> None:
        try:
            batch.run(spark, path, root, expected=cities(spark, sf_dir))
        except Exception as error:
            if refused is None or not isinstance(error, refused):
                raise

    held = lease.take(spark, root, "a load that died", 3600)
    run(f"{landed}/half=1", lease.LeaseHeld)
    held.end()
    run(f"{landed}/half=1")

    rejects.read(spark, root, rejects.RECORDS).select("text").write.text(f"{landed}/refused")
    run(f"{landed}/refused")

    base = warehouse.current(spark, root)
    version = warehouse.new_version(base)
    left = base.dim("DimLieux").where(F.col("id_dim_lieu") % 3 != 0)
    warehouse.write_dim(base, "DimLieux", left, version)
    warehouse.publish(replace(base, dims={**base.dims, "DimLieux": version}), "lost rows")
    # the same records again: their parts hold facts of cities that are gone
    run(f"{landed}/half=1", quality.ConstraintViolation)

    warehouse.reset(spark, root)
    run(f"{landed}/half=2")
    return root


def guarded(spark: SparkSession, sf_dir: str) -> str:
    return _guarded(spark, spark.sparkContext.applicationId, sf_dir, _files(spark, sf_dir))


def guarded_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log says of loads that were refused, had nothing to load, or failed a check."""
    log = runlog.read(spark, batch.log_path(guarded(spark, sf_dir)))
    what = F.regexp_extract("error_message", r"(holds the lease|orphan \w+)", 1)
    return log.select("log_id", "process_name", "status", "rows_processed", F.coalesce(what, F.lit("")).alias("error"))


def guarded_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commits of the same loads: those that were kept from it have none."""
    told = warehouse.history(spark, guarded(spark, sf_dir))
    named = F.when(F.col("batch").isin("lost rows", "reset"), F.col("batch")).otherwise("load")
    return told.select("number", named.alias("batch"))


def reset_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star join after a reset and one load: nothing from before it is left."""
    return _served(spark, guarded(spark, sf_dir))


def landing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the last line of each city, whose records meet in the same files."""
    folder = f"{_new_folder(spark)}/landing"
    event = F.col("event_id")
    rows = M.records(spark, sf_dir).select(
        "event_id", (F.floor(event / (8 * EVENTS_PER_FILE)) + FIRST_FILE).alias("file"), "text"
    )
    # the newest event comes first in a file: the values say nothing of the order
    _in_order(rows.withColumn("back", -event), ["file"], ["back"], folder)
    parsed = ingest.parse_records(landing.read(spark, folder), landing.TEXT)
    flat = materialize(ingest.flatten(ingest.valid(parsed), landing.ARRIVAL), "flat")
    first, last = (
        one(flat.select("nom", *landing.ARRIVAL, "datetime_observation", "temperature_celsius"), ["nom"], landing.ARRIVAL)
        for one in (first_per_key, last_per_key)
    )
    return decimals_as_double(
        first.alias("f").join(last.alias("l"), "nom").select(
            "nom",
            *[F.col(f"{side}.{c}").alias(f"{name}_{c}") for side, name in (("f", "first"), ("l", "last"))
              for c in ("datetime_observation", "temperature_celsius")],
        )
    )


RUNS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        pipeline_facts, stream_facts, pipeline_second_run, pipeline_staging, pipeline_rejects,
        pipeline_record_rejects, pipeline_coverage, pipeline_log, landing_order, pipeline_parts,
        pipeline_city_parts, pipeline_day_coverage, guarded_log, guarded_commits, reset_facts,
    )
}
