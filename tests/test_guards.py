"""What keeps a warehouse right: leases, numbered records, constraints, parts, the log's files."""

import time
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from helpers import record, rows

from obstar.operators import merge, presence, quality
from obstar.plans import batch, staging, views
from obstar.session import materialize
from obstar.sources import landing, lease, numbered, runlog, warehouse

CITIES = [record(f"City {i}", "r", "Togo", time=f"2024-03-{1 + i % 3:02} 10:00") for i in range(1, 9)]


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "warehouse")


@pytest.fixture()
def land(tmp_path):
    def write(folder, *texts):
        path = tmp_path / "landing" / folder
        path.mkdir(parents=True, exist_ok=True)
        (path / "part.json").write_text("\n".join(texts) + "\n")
        return str(path)

    return write


def test_numbers_are_found_without_a_list(spark, tmp_path, monkeypatch):
    folder, schema = str(tmp_path / "numbers"), "value BIGINT, token STRING"
    assert numbered.latest(spark, folder) == 0
    for n in range(1, 24):
        numbered.append(spark, folder, n, (n, f"t{n}"), schema, f"t{n}")
    monkeypatch.setattr(numbered, "_SEEN", {})
    asked = []
    there = numbered._there
    monkeypatch.setattr(numbered, "_there", lambda spark, path: asked.append(path) or there(spark, path))
    assert numbered.latest(spark, folder) == 23 and len(asked) < 12
    asked.clear()
    assert numbered.latest(spark, folder) == 23 and len(asked) == 2
    assert numbered.read(spark, folder, 23, schema)["value"] == 23
    with pytest.raises(numbered.Taken):
        numbered.append(spark, folder, 23, (0, "x"), schema, "x")


def test_record_of_a_writer_that_died_is_written_anew(spark, tmp_path, monkeypatch):
    folder, schema = tmp_path / "numbers", "token STRING"
    (folder / "n=1").mkdir(parents=True)
    assert numbered.latest(spark, str(folder)) == 0
    numbered.append(spark, str(folder), 1, ("a",), schema, "a")
    assert numbered.latest(spark, str(folder)) == 1
    monkeypatch.setitem(numbered._SEEN, str(folder), 9)  # a hint that does not hold
    assert numbered.latest(spark, str(folder)) == 1


def test_lease(spark, root):
    first = lease.take(spark, root, "first", 60)
    with pytest.raises(lease.LeaseHeld, match="first"):
        lease.take(spark, root, "second")
    first.renew()
    assert first.number == 1  # most of its time is left
    first.expires = time.time() + 20
    first.renew()
    assert first.number == 2
    first.release()
    short = lease.take(spark, root, "second", 0.0)
    third = lease.take(spark, root, "third")  # the second one's time is over
    with pytest.raises(lease.LeaseHeld, match="taken over"):
        short.renew()
    short.release()
    third.renew()


def test_second_start_is_refused_before_it_reads(spark, root, land, monkeypatch):
    path = land("a", *CITIES)
    held = lease.take(spark, root, "other", 600)

    def no_reading(*_args):
        raise AssertionError("the landing folder was read")

    with monkeypatch.context() as patched:
        patched.setattr(landing, "read", no_reading)
        with pytest.raises(lease.LeaseHeld, match="other"):
            batch.run(spark, path, root)
    log = runlog.read(spark, batch.log_path(root))
    assert rows(log, "process_name", "status") == [(batch.RUN, runlog.REFUSED)]
    assert runlog.current_state(log, batch.RUN) == runlog.IDLE
    held.end()
    assert batch.run(spark, path, root).status == runlog.SUCCESS
    with pytest.raises(lease.LeaseHeld):
        held.renew()


def test_load_that_lost_its_lease_publishes_nothing(spark, root, land, monkeypatch):
    renew = lease.Lease.renew
    monkeypatch.setattr(lease.Lease, "renew", lambda self: (lease.take(spark, root, "next"), renew(self)))
    with pytest.raises(lease.LeaseHeld):
        batch.run(spark, land("a", *CITIES), root, lease_seconds=0.0)
    assert warehouse.current(spark, root).number == 0


def test_one_late_row_rewrites_one_part(spark, root, land):
    batch.run(spark, land("a", *CITIES), root, buckets=8)
    before = warehouse.current(spark, root)
    assert before.buckets == 8 and len(before.parts) == 8
    batch.run(spark, land("b", record("City 4", "r", "Togo", time="2024-03-02 10:30")), root)
    after = warehouse.current(spark, root)
    new = [p for p in after.parts if p not in before.parts]
    assert [(p.key, p.rows) for p in new] == [((2024, 3, 2, 4), 2)]
    written = [f for f in after.fact().inputFiles() if new[0].version in f]
    assert written and all("/jour=2/seau=4/" in f for f in written)
    city = views.latest(after, city="City 4")
    assert city.count() == 2 and {tuple(r) for r in after.presence().select("seau").collect()} == {(i,) for i in range(8)}
    fact_files = [f for f in city.inputFiles() if warehouse.FACT in f]
    assert fact_files and all("/seau=4/" in f for f in fact_files)
    assert views.parts_with(after, "City 4") == {(2024, 3, 2, 4)} and views.parts_with(after, "nowhere") == set()


def test_coverage_over_periods(spark, root, land):
    batch.run(spark, land("a", *CITIES, record("City 1", "r", "Togo", time="2024-05-01 10:00")), root)
    snapshot = warehouse.current(spark, root)
    expected = spark.createDataFrame([("City 1",), ("City 2",), ("City 3",), ("Nowhere",), ("City 1",)], "nom string")
    assert rows(views.coverage(snapshot, expected)) == [(4, 3, 1)]
    assert rows(views.coverage(snapshot, expected, ["annee", "mois"])) == [(2024, 3, 4, 3, 1), (2024, 5, 4, 1, 3)]
    one_day = views.coverage(snapshot, expected, start=date(2024, 3, 2), end=date(2024, 3, 2))
    assert rows(one_day) == [(4, 1, 3)]
    assert rows(views.coverage(warehouse.Snapshot(spark, root), expected)) == [(4, 0, 4)]


def test_presence_is_exact(spark):
    ids = [1, 7, 8, 9, 32_768, 32_769, 70_000]
    df = spark.createDataFrame([(i % 2, i) for i in ids for _ in range(3)], "g int, id long")
    maps = presence.by(df, ["g"], "id")
    assert rows(presence.counted(maps, ["g"])) == [(0, 3), (1, 4)]
    assert rows(presence.counted(maps)) == [(len(ids),)]
    asked = spark.range(1, 70_010).withColumnRenamed("id", "asked")
    assert sorted(r["asked"] for r in presence.holding(maps, asked, "asked").collect()) == ids


def test_broken_parent_publishes_nothing(spark, root, land):
    batch.run(spark, land("a", *CITIES), root, buckets=1)
    base = warehouse.current(spark, root)
    version = warehouse.new_version(base)
    warehouse.write_dim(base, "DimLieux", base.dim("DimLieux").where("id_dim_lieu > 6"), version)
    broken = warehouse.publish(warehouse.replace(base, dims={**base.dims, "DimLieux": version}), "lost rows")
    with pytest.raises(quality.ConstraintViolation, match="orphan id_dim_lieu_fk: [1-6]"):
        batch.run(spark, land("b", record("New", "r", "Togo", time="2024-03-02 11:00")), root)
    assert warehouse.current(spark, root) == broken
    log = runlog.read(spark, batch.log_path(root))
    assert runlog.current_state(log, batch.TRANSFER).startswith("error: orphan id_dim_lieu_fk")


def test_constraints(spark, root):
    df = spark.createDataFrame([(1, 5), (2, 6), (None, 5)], "id int, fk int")
    guard = quality.Guard(df, not_null=["id"], parents={"fk": (spark.createDataFrame([(5,)], "k int"), "k")})
    assert materialize(guard.rows, "guarded").count() == 3
    with pytest.raises(quality.ConstraintViolation, match="null id: 1, orphan fk: 1"):
        guard.checked()
    good = quality.Guard(df.where("id = 1"), ["id"])
    materialize(good.rows, "guarded")
    assert good.checked() == 1
    twice = spark.createDataFrame([(1, 1), (1, 2)], "id int, v int")
    once = spark.createDataFrame([(1, 3)], "id int, v int")
    with pytest.raises(quality.ConstraintViolation, match="1 twice in the batch"):
        quality.check_unique(twice, ["id"], 2, 0, 2)
    done = merge.apply(materialize(twice, "t"), materialize(once, "b"), ["id"], ["v"])
    assert (done.matched, done.did["inserted"]) == (2, 0)
    with pytest.raises(quality.ConstraintViolation, match="1 more in the table"):
        quality.check_unique(once, ["id"], 1, done.matched, 0)


def test_files_of_the_log_stay_few(spark, root):
    path, start = f"{root}/log", datetime(2024, 1, 1, tzinfo=timezone.utc)
    for i in range(1, 30):
        runlog.append(spark, path, "p", runlog.RUNNING, start, rows_processed=i)
        runlog.compact(spark, path, width=3)
        if i % 7 == 0:
            assert sorted(rows(runlog.read(spark, path), "log_id")) == [(n,) for n in range(1, i + 1)]
    folders = list(Path(path).glob("level=*/*"))
    assert len(folders) < 20
    assert sorted(rows(runlog.read(spark, path), "log_id", "rows_processed")) == [(n, n) for n in range(1, 30)]
    assert runlog.next_id(spark, path) == 30


def test_staging_of_a_load_that_died_is_not_followed(spark, root, land, monkeypatch):
    batch.run(spark, land("a", *CITIES), root)
    before = rows(staging.read(spark, root).locations, "nom")

    def die(*_args):
        raise OSError("gone")

    with monkeypatch.context() as patched:
        patched.setattr(numbered, "append", die)
        with pytest.raises(OSError, match="gone"):
            staging.replace(staging.empty(spark), root)
    assert rows(staging.read(spark, root).locations, "nom") == before
