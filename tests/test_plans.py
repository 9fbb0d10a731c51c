"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from obstar.operators import facts, merge, numbering, serving
from obstar.operators.dedupe import first_per_key
from workload import mappings as M
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def physical(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_by_row_python_and_no_nested_loops(spark, capsys, name):
    plan = physical(QUERIES[name](spark, SF), capsys)
    for operator in (
        "BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "CartesianProduct",
        "BroadcastNestedLoopJoin",
    ):
        assert operator not in plan


def test_numbering_has_no_single_partition(spark, capsys, monkeypatch):
    plans = []
    write = numbering.materialize
    monkeypatch.setattr(numbering, "materialize", lambda df, label: plans.append(physical(df, capsys)) or write(df, label))
    numbered = numbering.dense_ids(M.locations(spark, SF), ["nom"], "id")
    assert "rangepartitioning" in plans[0]
    assert "SinglePartition" not in plans[0] + physical(numbered, capsys)


def test_dedupe_reduces_before_the_shuffle(spark, capsys):
    plan = physical(first_per_key(M.lines(spark, SF), M.LINE_KEY, M.LINE_ORDER), capsys)
    tree = plan.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.index("WindowGroupLimit") < tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_small_batch_does_not_shuffle_the_target(spark, capsys, tmp_path):
    target, batch = str(tmp_path / "target"), str(tmp_path / "batch")
    spark.range(1000).select("id", (F.col("id") * 2).alias("v")).write.parquet(target)
    spark.range(10).select("id", F.lit(1).cast("bigint").alias("v")).write.parquet(batch)
    stored = [spark.read.parquet(p) for p in (target, batch)]
    plan = physical(merge.upsert(*stored, ["id"], ["v"], one_per_key=True), capsys)
    assert "SortMergeJoin" not in plan
    assert "hashpartitioning" not in plan


def test_large_batch_is_not_broadcast(spark, capsys, tmp_path):
    target, batch = str(tmp_path / "target"), str(tmp_path / "batch")
    for path in (target, batch):
        spark.range(1000).select("id", (F.col("id") * 2).alias("v")).write.parquet(path)
    stored = [spark.read.parquet(p) for p in (target, batch)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = merge.upsert(*stored, ["id"], ["v"], one_per_key=True)
        assert "BroadcastHashJoin" not in physical(df, capsys)
        assert df.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_batch_shuffles_the_target_once(spark, capsys, tmp_path, monkeypatch):
    target, batch = str(tmp_path / "target"), str(tmp_path / "batch")
    spark.range(1000).select("id", (F.col("id") * 2).alias("v"), (F.col("id") + 1).alias("n")).write.parquet(target)
    spark.range(500, 1500).select("id", F.lit(1).cast("bigint").alias("v")).write.parquet(batch)
    plans, write = [], merge.materialize
    monkeypatch.setattr(merge, "materialize", lambda df, label: plans.append(physical(df, capsys)) or write(df, label))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        stored = [spark.read.parquet(p) for p in (target, batch)]
        df = merge.upsert(*stored, ["id"], ["v"], id_column="n", one_per_key=True)
        tree = plans[0].split("\n\n")[0]
        assert tree.count("Exchange") == 2 and tree.count("Scan parquet") == 2
        # what follows reads the stored join
        assert "target" not in re.sub("Location:.*merged.*", "", physical(df, capsys).split("\n\n", 1)[1])
        got = {r["id"]: (r["v"], r["n"]) for r in df.collect()}
        assert len(got) == 1500 and got[0] == (0, 1) and got[500] == (1, 501) and got[1499] == (1, 1500)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_safe_lookup_is_an_equi_join(spark, capsys):
    places = M.asia_unnamed(M.locations(spark, SF))
    dim = places.select(F.col("nom").alias("nom_ville"), "region", "pays", F.lit(1).alias("id_dim_lieu"))
    plan = physical(facts.location_keys(places, dim), capsys)
    assert re.search("BroadcastHashJoin|SortMergeJoin", plan)


def test_latest_takes_the_top_before_the_wide_joins(spark, capsys):
    star = M.star(spark, SF)
    plan = physical(serving.latest(star), capsys).split("\n\n")[0]
    assert plan.count("TakeOrderedAndProject") == 2


def test_scan_reads_only_what_is_asked(spark, capsys):
    plan = physical(QUERIES["coverage_missing"](spark, SF), capsys)
    schemas = re.findall(r"ReadSchema: (.*)", plan)
    assert sorted(schemas) == ["struct<c_custkey:bigint>", "struct<user_id:bigint>"]


def test_hot_location_is_split_where_the_join_shuffles(spark, capsys, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        place = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
        spark.range(0, 300_000, 1, 8).select(
            place.alias("id_lieu"), F.xxhash64("id").alias("t")
        ).write.parquet(str(tmp_path / "obs"))
        spark.range(500).select(
            F.col("id").alias("id_lieu"), F.col("id").cast("string").alias("nom"),
            F.lit("r").alias("region"), F.lit("p").alias("pays"),
        ).write.parquet(str(tmp_path / "lieux"))
        obs, lieux = (spark.read.parquet(str(tmp_path / n)) for n in ("obs", "lieux"))
        dim = lieux.select(F.col("id_lieu").alias("id_dim_lieu"), F.col("nom").alias("nom_ville"), "region", "pays")
        total = facts.resolve_location(obs, lieux, dim).agg(F.count("id_dim_lieu_fk"), F.bit_xor("t"))
        assert total.collect()[0][0] == 300_000
        assert "skew=true" in physical_tree(total, capsys)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def physical_tree(df, capsys):
    df.explain()
    return capsys.readouterr().out
