"""Whole runs: landing files to published tables, in batch and as a stream."""

from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from helpers import record, rows
from pyspark.errors import PySparkException

from obstar.operators import serving
from obstar.plans import batch, staging, star, views
from obstar.sources import landing, rejects, runlog, warehouse
from obstar.streaming import incremental


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "warehouse")


@pytest.fixture()
def land(tmp_path):
    """Write a landing file; a batch folder per name."""

    def write(folder, *texts, file="part.json"):
        path = tmp_path / "landing" / folder
        path.mkdir(parents=True, exist_ok=True)
        (path / file).write_text("\n".join(texts) + "\n")
        return str(path)

    return write


FIRST = (
    record("Dakar"),
    record("Thies", "Thies", time="2024-03-09 7:30", text="Cloudy", code=1003, temp_c=30.1),
    record("Lome", "Maritime", "Togo", time="2024-02-28 10:00"),
)


def served(snapshot):
    view = serving.star_join(star.star_of(snapshot))
    return rows(view, "nom_ville", "pays", "date", "heure", "minute", "texte_condition", "temperature_celsius")


def tables(snapshot):
    frames = [snapshot.dim(n) for n in sorted(snapshot.dims)] + [snapshot.fact()]
    return [rows(df) for df in frames]


def test_first_run(spark, root, land):
    result = batch.run(spark, land("a", *FIRST, "broken", "", record("Kara", uv=None)), root)
    assert result.status == runlog.SUCCESS
    assert result.counts == {"records": 5, "valid": 3, "observations": 3, "dropped": 0, "facts": 3}
    assert rows(result.record_rejects, "field", "reason") == [("$", "malformed"), ("uv", "missing")]
    snapshot = warehouse.current(spark, root)
    assert snapshot.number == 1
    assert sorted(snapshot.days) == [(2024, 2, 28), (2024, 3, 9)]
    assert rows(snapshot.dim("DimLieux"), "id_dim_lieu", "nom_ville") == [(1, "Dakar"), (2, "Lome"), (3, "Thies")]
    assert rows(snapshot.dim("DimTemps"), "id_dim_temps", "mois", "heure", "minute") == [
        (1, 2, 10, 0), (2, 3, 7, 30), (3, 3, 13, 5),
    ]
    assert rows(snapshot.fact(), "id_observation_horaire", "temperature_celsius") == [
        (1, Decimal("28.30")), (2, Decimal("28.30")), (3, Decimal("30.10")),
    ]


def test_same_batch_twice_changes_nothing(spark, root, land):
    path = land("a", *FIRST)
    batch.run(spark, path, root)
    before = tables(warehouse.current(spark, root))
    batch.run(spark, path, root)
    after = warehouse.current(spark, root)
    assert after.number == 2
    assert tables(after) == before


def test_second_run_updates_and_adds(spark, root, land):
    batch.run(spark, land("a", *FIRST), root)
    first = warehouse.current(spark, root)
    batch.run(
        spark,
        land(
            "b",
            record("Dakar", temp_c=31.0, text="Clear"),  # same minute; its code has a new text
            record("Bamako", "Bamako", "Mali", time="2024-03-10 00:00", code=1009, text="Mist"),
        ),
        root,
    )
    second = warehouse.current(spark, root)
    # only the part of the late row and the new part are written; others are carried over by name
    kept = {p.key for p in second.parts if p in first.parts}
    assert {p.key for p in second.parts} - kept == {(2024, 3, 9, 1), (2024, 3, 10, 0)}
    assert kept == {(2024, 2, 28, 2), (2024, 3, 9, 3)}
    assert rows(second.dim("DimConditionsMeteo")) == [(1, 1000, "Clear"), (2, 1003, "Cloudy"), (3, 1009, "Mist")]
    assert rows(second.dim("DimLieux"), "id_dim_lieu", "nom_ville")[-1] == (4, "Bamako")
    got = {r["id_observation_horaire"]: r["temperature_celsius"] for r in second.fact().collect()}
    dakar = serving.star_join(star.star_of(second)).where("nom_ville = 'Dakar'").first()
    assert got[dakar["id_observation_horaire"]] == Decimal("31.00")
    assert set(got) == {1, 2, 3, 4}
    assert tables(first) != tables(second)  # the earlier version can still be read


@pytest.mark.parametrize(("first", "last"), [("Mali", "Togo"), ("Togo", "Mali")])
def test_city_in_two_countries_keeps_the_last(spark, root, land, first, last):
    land("a", record("San", "r", first), file="1.json")
    path = land("a", record("San", "r", last, temp_c=20.0), file="2.json")
    result = batch.run(spark, path, root)
    snapshot = warehouse.current(spark, root)
    assert rows(snapshot.dim("DimLieux"), "nom_ville", "pays") == [("San", last)]
    assert result.counts["dropped"] == 1
    assert rows(result.fact_rejects, "failed_keys") == [("id_dim_lieu_fk",)]
    assert [r[-1] for r in served(snapshot)] == [Decimal("20.00")]


@pytest.mark.parametrize("countries", [("Mali", "Togo"), ("Togo", "Mali")])
def test_lines_of_one_file_have_an_order(spark, root, land, countries):
    """First come, first kept within a file; a city keeps the country it was last seen in."""
    first, last = countries
    path = land(
        "a",
        record("San", "r", first),
        record("Dakar", temp_c=9.0), record("Dakar", temp_c=5.0), record("Dakar", temp_c=7.0),
        record("San", "r", last),
        record("Kara", "k", "Togo", code=1000, text="Another text for 1000"),
        record("Lome", "m", "Togo", code=1001, text="Sunny"),  # the text is taken: its observation goes
    )
    batch.run(spark, path, root)
    snapshot = warehouse.current(spark, root)
    assert rows(snapshot.dim("DimLieux"), "nom_ville", "pays")[-1] == ("San", last)
    assert {r[0]: r[-1] for r in served(snapshot)}["Dakar"] == Decimal("9.00")
    assert rows(snapshot.dim("DimConditionsMeteo"), "code_condition", "texte_condition") == [(1000, "Sunny")]
    assert "Lome" not in {r[0] for r in served(snapshot)}


def test_order_of_a_file_that_is_read_in_parts(spark, root, land):
    """Descending values, read in many parts: the first line of each minute stays."""
    texts = [
        record("Dakar", time=f"2024-03-09 10:{m:02}", temp_c=float(90 - n)) for n in range(40) for m in range(20)
    ]
    path = land("a", *texts)
    sizes = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        lines = landing.read(spark, path)
        assert lines.rdd.getNumPartitions() > 10
        found = lines.orderBy(*landing.ARRIVAL).select("text").collect()
        batch.run(spark, path, root)
    finally:
        for key in sizes:
            spark.conf.unset(key)
    assert [r["text"] for r in found] == texts
    assert rows(warehouse.current(spark, root).fact(), "temperature_celsius") == [(Decimal("90.00"),)] * 20


def test_lines_of_a_stream_have_an_order(spark, root, land, tmp_path):
    path = land("stream", *[record("Dakar", temp_c=t) for t in (3.0, 1.0, 2.0)])
    incremental.start(spark, path, root, str(tmp_path / "checkpoint")).awaitTermination()
    assert [r[-1] for r in served(warehouse.current(spark, root))] == [Decimal("3.00")]


def test_nothing_valid_changes_nothing(spark, root, land):
    batch.run(spark, land("a", *FIRST), root)
    before = warehouse.current(spark, root)
    result = batch.run(spark, land("b", "broken", '{"error":{}}'), root)
    assert result.status == runlog.SKIPPED
    assert warehouse.current(spark, root) == before


def test_unreadable_time_fails_the_run_and_is_logged(spark, root, land):
    batch.run(spark, land("a", *FIRST), root)
    before = warehouse.current(spark, root)
    with pytest.raises(PySparkException):
        batch.run(spark, land("b", record(time="2024-13-01 00:00")), root)
    assert warehouse.current(spark, root) == before
    log = runlog.read(spark, batch.log_path(root))
    assert runlog.current_state(log, batch.RUN).startswith("error: ")


def test_failure_between_writes_leaves_the_old_version(spark, root, land, monkeypatch):
    batch.run(spark, land("a", *FIRST), root)
    before = warehouse.current(spark, root)
    content = tables(before)

    def fail(*_args):
        raise OSError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, "write_parts", fail)
        with pytest.raises(OSError, match="disk full"):
            batch.run(spark, land("b", record("Kara", "Kara", "Togo")), root)
    assert warehouse.current(spark, root) == before
    assert tables(before) == content
    batch.run(spark, land("c", record("Kara", "Kara", "Togo")), root)
    assert len(served(warehouse.current(spark, root))) == 4


def test_second_loader_is_refused(spark, root, land):
    batch.run(spark, land("a", *FIRST), root)
    base = warehouse.current(spark, root)
    warehouse.publish(base, "one")
    with pytest.raises(warehouse.ConcurrentLoad):
        warehouse.publish(base, "two")


def test_reset(spark, root, land):
    batch.run(spark, land("a", *FIRST), root)
    warehouse.reset(spark, root)
    empty = warehouse.current(spark, root)
    assert all(t == [] for t in tables(empty)) and served(empty) == []
    batch.run(spark, land("a", *FIRST), root)
    assert rows(warehouse.current(spark, root).fact(), "id_observation_horaire") == [(1,), (2,), (3,)]


def test_two_streams_into_one_warehouse(spark, root, land, tmp_path):
    for i, text in enumerate((record("Dakar"), record("Kara", "Kara", "Togo"))):
        path = land(f"landing{i}", text)
        incremental.start(spark, path, root, str(tmp_path / f"checkpoint{i}")).awaitTermination()
    snapshot = warehouse.current(spark, root)
    assert [r[0] for r in served(snapshot)] == ["Dakar", "Kara"]
    assert sorted(snapshot.streams.values()) == [0, 0]


def test_stream_after_a_reset_and_a_fresh_checkpoint(spark, root, land, tmp_path):
    path = land("landing", *FIRST)
    incremental.start(spark, path, root, str(tmp_path / "one")).awaitTermination()
    warehouse.reset(spark, root)
    assert warehouse.current(spark, root).streams == {}
    incremental.start(spark, path, root, str(tmp_path / "two")).awaitTermination()
    assert len(served(warehouse.current(spark, root))) == 3


def test_number_of_a_commit_is_read_below_the_commits(spark, tmp_path, land):
    root = str(tmp_path / "n=5" / "warehouse")
    for name in ("a", "b"):
        batch.run(spark, land(name, *FIRST), root)
    assert warehouse.current(spark, root).number == 2


def test_commit_with_two_records_is_not_followed(spark, root, land):
    batch.run(spark, land("a", *FIRST), root)
    record_of = spark.read.text(f"{root}/commits/n=1")
    record_of.write.mode("append").text(f"{root}/commits/n=1")
    for found in spark.read.format("binaryFile").load(f"{root}/commits/n=1/*.txt").select("path").collect():
        moved = found["path"].removeprefix("file:")
        Path(moved).rename(moved.replace(".txt", ".json"))
    with pytest.raises(warehouse.ConcurrentLoad):
        warehouse.current(spark, root)


def test_rejects_coverage_and_actions_are_kept(spark, root, land):
    bad = record("Kara", uv=None)
    result = batch.run(spark, land("a", *FIRST, "broken", bad), root, expected=["Dakar", "Lome", "Kara"])
    assert rows(rejects.read(spark, root, rejects.RECORDS), "text", "field", "reason", "commit") == sorted(
        [("broken", "$", "malformed", 1), (bad, "uv", "missing", 1)]
    )
    assert result.coverage == {"expected": 3, "seen": 2, "missing": 1}
    assert result.actions["FaitDonneesMeteo"] == {"inserted": 3, "updated": 0, "unchanged": 0, "affected": 3}
    batch.run(spark, land("b", "broken too"), root)
    assert rejects.read(spark, root, rejects.RECORDS).where("commit is null").count() == 1
    again = batch.run(spark, land("c", FIRST[0], record("Lome", "Maritime", "Togo", time="2024-02-28 10:00", temp_c=1.0)), root)
    assert again.actions["FaitDonneesMeteo"] == {"inserted": 0, "updated": 1, "unchanged": 1, "affected": 2}
    assert warehouse.current(spark, root).counts["FaitDonneesMeteo.updated"] == 1


def test_one_late_row_rewrites_one_day(spark, root, land):
    days = [record(time=f"2024-03-{d:02} 10:00") for d in range(1, 11)]
    batch.run(spark, land("a", *days), root)
    before = warehouse.current(spark, root)
    batch.run(spark, land("b", record(time="2024-03-04 11:00")), root)
    after = warehouse.current(spark, root)
    assert [p.day for p in after.parts if p not in before.parts] == [(2024, 3, 4)]
    assert after.fact().count() == 11


def test_unchanged_dimensions_keep_their_version(spark, root, land):
    batch.run(spark, land("a", *FIRST), root)
    before = warehouse.current(spark, root).dims
    batch.run(spark, land("b", record("Dakar", temp_c=31.0)), root)
    assert warehouse.current(spark, root).dims == before
    batch.run(spark, land("c", record("Dakar", text="Clear", time="2024-03-09 13:06")), root)
    after = warehouse.current(spark, root).dims
    assert {n for n in before if after[n] != before[n]} == {"DimTemps", "DimConditionsMeteo"}


def test_bad_time_rejected_on_request(spark, root, land):
    bad = record("Kara", time="2024-13-01 00:00")
    result = batch.run(spark, land("a", *FIRST, bad), root, on_bad_time="reject")
    assert result.counts["facts"] == 3
    assert rows(result.record_rejects, "text", "field", "reason") == [(bad, "last_updated", "uncoercible")]


def test_whole_numbers_clamped_in_a_run(spark, root, land):
    batch.run(spark, land("a", record(cloud=99_999_999_999, humidity=-99_999_999_999)), root, on_overflow="clamp")
    fact = warehouse.current(spark, root).fact()
    assert rows(fact, "nuages_pourcentage", "humidite_pourcentage") == [(2**31 - 1, -(2**31))]


def test_filtered_view_is_not_cut(spark, root, land):
    minutes = [record(time=f"2024-03-{1 + i // 1440:02} {i // 60 % 24}:{i % 60}") for i in range(1500)]
    batch.run(spark, land("a", *minutes), root)
    snapshot = warehouse.current(spark, root)
    assert views.latest(snapshot, city="Dakar").count() == 1500
    assert views.latest(snapshot, start=date(2024, 3, 1)).count() == 1500
    assert views.latest(snapshot).count() == 1000
    assert views.latest(snapshot, city="Dakar", n=7).count() == 7


def test_city_view_reads_the_newest_days_first(spark, root, land):
    texts = [record(time=f"2024-{m:02}-01 10:00") for m in range(1, 9)]
    batch.run(spark, land("a", *texts), root)
    newest = views.latest(warehouse.current(spark, root), n=2, city="Dakar")
    assert sorted(r["mois"] for r in newest.collect()) == [7, 8]
    assert not any("mois=1/" in f for f in newest.inputFiles())


def test_a_run_leaves_only_current_tables(spark, root, land):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "obstar"
    batch.run(spark, land("a", *FIRST), root)
    before = sorted(folder.glob("*")) if folder.exists() else []
    batch.run(spark, land("b", *FIRST), root)
    assert (sorted(folder.glob("*")) if folder.exists() else []) == before
    assert len(list((Path(root) / "staging").iterdir())) == 2  # the current run, and its name
    current = staging.read(spark, root)
    assert rows(current.locations, "nom") == [("Dakar",), ("Lome",), ("Thies",)]


def test_failed_transfer_is_logged_as_such(spark, root, land, monkeypatch):
    def fail(*_args):
        raise OSError("disk full")

    monkeypatch.setattr(warehouse, "publish", fail)
    with pytest.raises(OSError, match="disk full"):
        batch.run(spark, land("a", *FIRST), root)
    log = runlog.read(spark, batch.log_path(root))
    assert runlog.current_state(log, batch.TRANSFER) == "error: disk full"


def test_run_log(spark, root, land):
    log = batch.log_path(root)
    assert runlog.current_state(runlog.read(spark, log), batch.RUN) == runlog.IDLE
    batch.run(spark, land("a", *FIRST), root)
    logged = runlog.read(spark, log)
    assert rows(logged, "log_id", "process_name", "status", "rows_processed") == [
        (1, "run_etl", "running", None),
        (2, "transfer_data_to_warehouse", "success", 3),
        (3, "run_etl", "success", 3),
    ]
    assert logged.where("created_at is null").count() == 0
    assert runlog.current_state(logged, batch.RUN) == runlog.FINISHED


def test_status_follows_the_latest_row(spark, root):
    log = f"{root}/log"
    early = datetime(2024, 1, 1, tzinfo=timezone.utc)
    runlog.append(spark, log, "p", runlog.RUNNING, early)
    runlog.append(spark, log, "p", runlog.FAILED, early, error_message="boom")
    assert runlog.current_state(runlog.read(spark, log), "p") == "error: boom"
    runlog.append(spark, log, "p", runlog.RUNNING, datetime(2024, 1, 2, tzinfo=timezone.utc))
    assert runlog.current_state(runlog.read(spark, log), "p") == "running"


def test_views_read_only_the_days_they_need(spark, root, land, tmp_path):
    batch.run(spark, land("a", *FIRST), root)
    snapshot = warehouse.current(spark, root)
    assert snapshot.newest_days(1) == {(2024, 3, 9)}
    newest = views.latest(snapshot, n=2)
    assert [r["nom_ville"] for r in newest.collect()] == ["Dakar", "Thies"]
    assert [r["nom_ville"] for r in views.latest(snapshot).collect()] == ["Dakar", "Thies", "Lome"]
    assert not any("mois=2" in f for f in newest.inputFiles())
    period = views.latest(snapshot, start=date(2024, 2, 1), end=date(2024, 3, 1))
    assert [r["nom_ville"] for r in period.collect()] == ["Lome"]
    assert [r["nom_ville"] for r in views.latest(snapshot, city="Thies").collect()] == ["Thies"]
    assert [r[0] for r in views.locations(snapshot).collect()] == ["Dakar", "Lome", "Thies"]
    out = str(tmp_path / "served")
    views.write_records(views.latest_records(snapshot), out)
    assert spark.read.json(out).select("lieu.nom_ville", "temps.date", "condition.texte_condition").count() == 3


BATCHES = [
    FIRST,
    (record("Dakar", temp_c=31.0), record("Kara", "Kara", "Togo", time="2024-04-01 06:00"), "broken"),
    (record("Lome", "Maritime", "Togo", time="2024-02-28 10:00", temp_c=25.0),),
]


def test_stream_gives_what_the_batches_give(spark, root, land, tmp_path):
    for i, texts in enumerate(BATCHES):
        batch.run(spark, land(f"b{i}", *texts), root)
    streamed = str(tmp_path / "streamed")
    checkpoint = str(tmp_path / "checkpoint")
    for i, texts in enumerate(BATCHES):
        stream = land("stream", *texts, file=f"{i}.json")
        incremental.start(spark, stream, streamed, checkpoint).awaitTermination()
    by_batch, by_stream = (warehouse.current(spark, r) for r in (root, streamed))
    assert tables(by_stream) == tables(by_batch)
    assert list(by_stream.streams.values()) == [2]


def test_same_stream_is_not_started_twice(spark, root, land, tmp_path):
    path, checkpoint = land("stream", *FIRST), str(tmp_path / "checkpoint")
    every_second = {"processingTime": "1 second"}
    running = incremental.start(spark, path, root, checkpoint, trigger=every_second)
    try:
        with pytest.raises(Exception, match="(?i)another query|already active"):
            incremental.start(spark, path, root, checkpoint, trigger=every_second)
        running.processAllAvailable()
    finally:
        running.stop()
    assert warehouse.current(spark, root).number == 1


def test_replayed_stream_batch_is_skipped(spark, root, land):
    path = land("a", *FIRST)
    records = landing.read(spark, path)
    first = batch.load(spark, records, root, stream=("s", 0))
    again = batch.load(spark, records, root, stream=("s", 0))
    assert (first.status, again.status) == (runlog.SUCCESS, runlog.REPLAYED)
    assert warehouse.current(spark, root).number == 1
