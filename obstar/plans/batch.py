"""One run: landing records to published star schema, with a log of it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from dataclasses import replace as changed
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obstar.functions import times
from obstar.operators import ingest, quality
from obstar.operators.ingest import ERRORS
from obstar.plans import staging, star
from obstar.schemas import EXPECTED_CITIES
from obstar.session import configure, materialize, run_folder
from obstar.sources import landing, lease, rejects, runlog, warehouse

# fixed values: the processes of the log
RUN, TRANSFER = "run_etl", "transfer_data_to_warehouse"


@dataclass(frozen=True)
class Result:
    """Outcome of a run.

    The rejects are stored with the warehouse: fields of records with the record's
    text, and observations whose keys were not found. `coverage` counts the expected
    cities, `actions` what the merges did to each table.
    """

    status: str
    counts: dict[str, int] = field(default_factory=dict)
    record_rejects: DataFrame | None = None
    fact_rejects: DataFrame | None = None
    coverage: dict[str, int] = field(default_factory=dict)
    actions: dict[str, dict[str, int]] = field(default_factory=dict)


def log_path(root: str) -> str:
    return f"{root}/etl_logs"


def run(
    spark: SparkSession,
    landing_path: str,
    root: str,
    on_overflow: str = "reject",
    batch: str | None = None,
    on_bad_time: str = "fail",
    expected: DataFrame | Sequence[str] | None = None,
    lease_seconds: float = lease.SECONDS,
    buckets: int | None = None,
) -> Result:
    """Load all files of a landing folder."""
    configure(spark)

    def records() -> DataFrame:
        return landing.read(spark, landing_path)

    return load(
        spark, records, root, on_overflow, batch, None, on_bad_time, expected, lease_seconds, buckets
    )


def load(
    spark: SparkSession,
    records: DataFrame | Callable[[], DataFrame],
    root: str,
    on_overflow: str = "reject",
    batch: str | None = None,
    stream: tuple[str, int] | None = None,
    on_bad_time: str = "fail",
    expected: DataFrame | Sequence[str] | None = None,
    lease_seconds: float = lease.SECONDS,
    buckets: int | None = None,
) -> Result:
    """Load landing records; logs the start and the end, also of a failure.

    A load that starts while another one has the lease of the warehouse is refused before
    it looks at its records (LeaseHeld, and a row in the log). The lease of a load that
    died runs out after `lease_seconds`. The first load of a warehouse may say into how many
    `buckets` of locations a day is cut: what a late record makes a load rewrite is one of
    them, so a day should have as many as its files of a good size.

    `stream` is the identity of a stream, as its checkpoint keeps it, and the number
    of one of its batches; a batch that has been published already is skipped, so a
    replay changes nothing. `on_bad_time` says what a time that cannot be read does:
    "fail" the run, or "reject" the record. `expected` are the names of the cities a
    complete run has (a list, or a frame with the column `nom`), by default those of
    the contract.
    """
    started, batch = datetime.now(timezone.utc), batch or uuid.uuid4().hex
    log = log_path(root)

    def record(process: str, status: str, **more) -> None:
        runlog.append(spark, log, process, status, started, **more)

    try:
        held = lease.take(spark, root, batch, lease_seconds)
    except lease.LeaseHeld as refusal:
        record(RUN, runlog.REFUSED, end_time=datetime.now(timezone.utc), error_message=str(refusal))
        raise
    steps: list[str] = []
    try:
        record(RUN, runlog.RUNNING)
        try:
            with run_folder(spark, "load"):
                result = _load(
                    spark, records() if callable(records) else records, root, on_overflow, batch,
                    stream, on_bad_time, expected, steps, held, buckets,
                )
        except Exception as error:
            ended = {"end_time": datetime.now(timezone.utc), "error_message": str(error)}
            for process in [*steps, RUN]:
                record(process, runlog.FAILED, **ended)
            raise
        ended = {"end_time": datetime.now(timezone.utc), "rows_processed": result.counts.get("facts", 0)}
        if result.status == runlog.SUCCESS:
            record(TRANSFER, result.status, **ended)
        record(RUN, result.status, **ended)
        runlog.compact(spark, log)
    finally:
        held.release()
    return result


def cities_of(names: Sequence[str]) -> list[str]:
    """The names by which records call the expected cities."""
    return [n.rsplit("/", 1)[-1].replace("_", " ") for n in names]


def _timed(parsed: DataFrame) -> DataFrame:
    """Reject records whose time cannot be read."""
    bad = F.array(F.struct(F.lit("last_updated").alias("field"), F.lit("uncoercible").alias("reason")))
    unread = (F.size(ERRORS) == 0) & ~times.is_minute(F.col("last_updated"))
    return parsed.withColumn(ERRORS, F.when(unread, bad).otherwise(F.col(ERRORS)))


def _load(
    spark: SparkSession,
    records: DataFrame,
    root: str,
    on_overflow: str,
    batch: str,
    stream: tuple[str, int] | None,
    on_bad_time: str,
    expected: DataFrame | Sequence[str] | None,
    steps: list[str],
    held: lease.Lease,
    buckets: int | None,
) -> Result:
    base = warehouse.current(spark, root)
    if buckets and not base.parts:
        base = changed(base, buckets=buckets)
    if stream and stream[1] <= base.streams.get(stream[0], -1):
        return Result(runlog.REPLAYED)

    records = landing.placed(records)
    parsed = ingest.parse_records(records, landing.TEXT, on_overflow=on_overflow, keep_rejected=True)
    if on_bad_time == "reject":
        # the text of all records is needed to tell the rejected ones
        parsed = _timed(materialize(_with_text(records, on_overflow), "read", spark)).withColumn(
            landing.TEXT, F.when(F.size(ERRORS) > 0, F.col(landing.TEXT))
        )
    seen = Observation()
    counted = [F.count(F.lit(1)).alias("records"), F.count_if(F.size(ERRORS) == 0).alias("valid")]
    parsed = materialize(parsed.observe(seen, *counted), "parsed", spark)
    counts = dict(seen.get)
    held.renew()
    refused = ingest.rejects(parsed, [landing.SOURCE, landing.TEXT])

    def skipped() -> Result:
        told = rejects.write(refused, root, rejects.RECORDS, batch, None)
        return Result(runlog.SKIPPED, counts, told)

    if counts["valid"] == 0:
        staging.replace(staging.empty(spark), root)
        return skipped()

    flat = ingest.flatten(ingest.valid(parsed), landing.ARRIVAL, on_overflow=on_overflow)
    staged = staging.replace(staging.build(flat), root)
    if staged.is_empty():
        return skipped()
    expected = cities_of(EXPECTED_CITIES) if expected is None else expected
    if not isinstance(expected, DataFrame):
        expected = spark.createDataFrame([(c,) for c in expected], "nom string")
    coverage = quality.coverage(expected, staged.locations, "nom").first().asDict()

    steps.append(TRANSFER)
    held.renew()
    loaded = star.load(staged, base)
    told = rejects.write(refused, root, rejects.RECORDS, batch, base.number + 1)
    unkeyed = rejects.write(loaded.rejects, root, rejects.OBSERVATIONS, batch, base.number + 1)
    counts |= {
        "observations": loaded.observations,
        "dropped": loaded.dropped,
        "facts": loaded.facts,
    }
    flat_actions = {f"{t}.{a}": n for t, did in loaded.actions.items() for a, n in did.items()}
    flat_coverage = {f"cities.{k}": n for k, n in coverage.items()}
    after = changed(loaded.snapshot, counts=counts | flat_coverage | flat_actions)
    if stream:
        after = changed(after, streams={**after.streams, stream[0]: stream[1]})
    held.renew()
    warehouse.publish(after, batch)
    return Result(runlog.SUCCESS, counts, told, unkeyed, coverage, loaded.actions)


def _with_text(records: DataFrame, on_overflow: str) -> DataFrame:
    """Parsed records, each with its text."""
    doubled = records.withColumn("_text", F.col(landing.TEXT))
    parsed = ingest.parse_records(doubled, landing.TEXT, on_overflow=on_overflow)
    return parsed.withColumnRenamed("_text", landing.TEXT)
