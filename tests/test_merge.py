"""Insert-ignore, upsert and surrogate keys."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from obstar.operators import merge
from obstar.operators.dedupe import first_per_key, last_per_key
from obstar.operators.numbering import dense_ids

DIM = "id bigint, city string, region string, country string"
BATCH = "city string, region string, country string, at int"


def dim(spark, *data):
    return spark.createDataFrame(list(data), DIM)


def batch(spark, *data):
    return spark.createDataFrame(list(data), BATCH)


def upsert(target, source, **options):
    return merge.upsert(target, source, ["city"], ["at"], id_column="id", **options)


def test_insert_ignore_first_wins_and_existing_stays(spark):
    target = dim(spark, (1, "a", "old", "x"))
    source = batch(spark, ("a", "new", "x", 1), ("b", "first", "x", 1), ("b", "second", "x", 2))
    result = merge.insert_ignore(target, source, ["city"], ["at"], id_column="id")
    assert rows(result) == [(1, "a", "old", "x"), (2, "b", "first", "x")]


def test_insert_ignore_null_matches_null_where_allowed(spark):
    target = dim(spark, (1, "a", None, "x"))
    source = batch(spark, ("a", None, "x", 1), ("a", "r", "x", 2), ("a", None, "x", 3))
    key = ["city", "region", "country"]
    result = merge.insert_ignore(target, source, key, ["at"], id_column="id", nullable=["region"])
    assert rows(result) == [(1, "a", None, "x"), (2, "a", "r", "x")]


def test_upsert_last_wins_keeps_ids_and_untouched_rows(spark):
    target = dim(spark, (1, "a", "r", "x"), (2, "b", "r", "x"))
    source = batch(spark, ("a", "s", "y", 1), ("a", "t", "z", 2), ("d", "r", "x", 1), ("c", "r", "x", 1))
    assert rows(upsert(target, source)) == [
        (1, "a", "t", "z"), (2, "b", "r", "x"), (3, "c", "r", "x"), (4, "d", "r", "x"),
    ]


def test_upsert_null_overwrites(spark):
    result = upsert(dim(spark, (1, "a", "r", "x")), batch(spark, ("a", None, "y", 1)))
    assert rows(result) == [(1, "a", None, "y")]


def test_upsert_into_nothing_and_of_nothing(spark):
    full = dim(spark, (1, "a", "r", "x"))
    assert rows(upsert(dim(spark), batch(spark, ("a", "r", "x", 1)))) == rows(full)
    assert rows(upsert(full, batch(spark))) == rows(full)
    assert rows(upsert(dim(spark), batch(spark))) == []


def test_upsert_without_ids(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert rows(merge.upsert(target, source, ["k"], ["v"])) == [("a", 1), ("b", 3), ("c", 4)]


def test_upsert_of_keys_only_adds_new_keys(spark):
    target = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    source = spark.createDataFrame([(1, 2), (2, 2), (2, 2)], "a int, b int")
    assert rows(merge.upsert(target, source, ["a", "b"], ["a"])) == [(1, 1), (1, 2), (2, 2)]


def test_actions(spark):
    target = dim(spark, (1, "a", "r", "x"), (2, "b", None, "x"), (3, "c", "r", "x")).drop("id")
    source = batch(spark, ("a", "s", "x", 1), ("b", None, "x", 1), ("d", "r", "x", 1))
    actions = merge.upsert_actions(target, source, ["city"], ["at"])
    assert rows(actions) == [("a", "updated"), ("b", "unchanged"), ("d", "inserted")]
    assert rows(merge.count_actions(actions)) == [(1, 1, 1, 3)]


def random_batches(seed):
    rng = random.Random(seed)
    return [
        [
            (f"c{rng.randrange(40)}", rng.choice(["r", "s", None]), rng.choice("xyz"), at)
            for at in range(rng.randrange(60))
        ]
        for _ in range(3)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_upsert_against_a_plain_model(spark, seed):
    target, model, ids = dim(spark), {}, {}
    for data in random_batches(seed):
        target = upsert(target, batch(spark, *data))
        fresh = sorted({c for c, *_ in data} - set(ids))
        ids |= {c: len(ids) + i for i, c in enumerate(fresh, 1)}
        model |= {c: (region, country) for c, region, country, _ in data}
        assert rows(target) == sorted(((ids[c], c, *v) for c, v in model.items()), key=repr)


def test_upsert_twice_changes_nothing(spark):
    data = batch(spark, *random_batches(9)[0])
    once = upsert(dim(spark, (7, "c1", "q", "q")), data)
    assert rows(upsert(once, data)) == rows(once)


@pytest.mark.parametrize("partitions", [1, 7])
def test_result_does_not_depend_on_partitions(spark, partitions):
    data = batch(spark, *random_batches(5)[1], ("c1", "r", "x", 5), ("c1", "s", "x", 5))
    known = dim(spark, (7, "c1", "q", "q"))
    expected = rows(upsert(known, data.coalesce(1)))
    assert rows(upsert(known.repartition(partitions), data.repartition(partitions))) == expected


def test_first_and_last_break_ties_by_the_other_columns(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 1, None)], "k string, o int, v string")
    assert rows(first_per_key(df, ["k"], ["o"])) == [("k", 1, None)]
    assert rows(last_per_key(df, ["k"], ["o"])) == [("k", 1, "b")]


def test_dense_ids_over_many_partitions(spark):
    n = 5000
    names = spark.range(n).select(F.format_string("%06d", F.pmod(F.col("id") * 7919, F.lit(n))).alias("k"))
    numbered = dense_ids(names.repartition(13), ["k"], "id", start=100)
    wrong = numbered.where(F.col("id") != F.col("k").cast("bigint") + 101)
    assert numbered.count() == n
    assert wrong.count() == 0


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.createDataFrame([], "k string"), ["k"], "id").count() == 0
