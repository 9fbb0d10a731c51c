"""How the runs' landing files are cut."""

from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from obstar.sources import landing
from workload import runs


def _tables(spark, folder, events):
    at = datetime(2024, 1, 1)
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    spark.createDataFrame([(0, "KENYA", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(1, "Customer#1", 0)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame(
        [(e, at, 1, "view", float(e % 1000), '{"k": 50}') for e in events],
        "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    ).write.parquet(f"{folder}/events.parquet")


def test_landing_files_grow_before_their_number_does(spark, tmp_path):
    events = range(0, 1_000_000, 2500)
    _tables(spark, f"{tmp_path}/in", events)
    runs.landing_files(spark, f"{tmp_path}/in", f"{tmp_path}/landing")
    assert len(list(Path(tmp_path, "landing").glob("half=*/file=*"))) == 200
    told = []
    for half in "12":
        read = landing.read(spark, f"{tmp_path}/landing/half={half}").sort(*landing.ARRIVAL)
        told += [r[0] for r in read.select(F.get_json_object("text", "$.current.temp_c").cast("double")).collect()]
    assert told == [float(e % 1000) for e in events]


def test_events_per_file():
    assert [runs.events_per_file(n) for n in (0, 100_000, 6_000_000, 10**9)] == [500, 500, 30_000, 50_000]
