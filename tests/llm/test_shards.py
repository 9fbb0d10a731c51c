import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obstar.llm import shards


def by_hand(number, n, seed):
    """One number through the network, with Python's integers."""
    left_bits, right_bits = shards.widths(n)
    while True:
        left, right = number >> right_bits, number & (1 << right_bits) - 1
        for i, key in enumerate(shards.round_keys(seed)):
            x = left if i % 2 else right
            a, b, c = shards.PRIMES
            x = (x * a + key) % 2**32
            x = (x ^ x >> 15) * b % 2**32
            x = (x ^ x >> 13) * c % 2**32
            x ^= x >> 16
            if i % 2:
                right ^= x & (1 << right_bits) - 1
            else:
                left ^= x & (1 << left_bits) - 1
        number = left << right_bits | right
        if number < n:
            return number


@given(st.integers(1, 3000), st.integers(0, 50))
@settings(max_examples=60, deadline=None)
def test_one_to_one_and_back(n, seed):
    numbers = np.arange(n)
    found = shards.permuted(numbers, n, seed)
    assert sorted(found) == list(range(n))
    assert (shards.restored(found, n, seed) == numbers).all()
    some = [0, n // 2, n - 1]
    assert [by_hand(i, n, seed) for i in some] == found[some].tolist()


def test_numbers_beyond_32_bits():
    n = (1 << 45) + 12345
    numbers = np.random.default_rng(0).integers(0, n, 5000)
    found = shards.permuted(numbers, n, 7)
    assert (shards.restored(found, n, 7) == numbers).all()
    assert [by_hand(int(i), n, 7) for i in numbers[:20]] == found[:20].tolist()
    shard, slot = shards.places(numbers, n, 24, 7)
    back = [shards.numbers(int(k), np.array([s]), n, 24, 7)[0] for k, s in zip(shard[:50], slot[:50])]
    assert back == numbers[:50].tolist()


def test_out_of_range():
    with pytest.raises(ValueError):
        shards.permuted(np.array([5]), 5, 0)
    assert shards.permuted(np.array([], np.int64), 0, 0).size == 0


def expected(rows, k, seed=0):
    """Multiset of results for rows of (doc_id, text)."""
    described = [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows]
    return Counter(described)


def test_law_slots_and_reproducible(spark, docs):
    texts = [(i, f"text {i % 50}" * (i % 9)) for i in range(997)]
    found = shards.sharded(docs(*texts)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected(texts, 24)
    per = {}
    for r in found:
        per.setdefault(r["shard"], []).append(r["slot"])
        number = r["shard"] + 24 * r["slot"]
        assert number == by_hand(r["doc_id"], len(texts), 0)
    assert sorted(per) == list(range(24)) and max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in per.values())
    again = shards.sharded(docs(*texts[::-1]).repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, found), key=repr)


def test_nulls_ties_repeats_hot_and_clashes(spark, docs):
    rows = [(None, None), (None, "a"), (3, ""), (3, ""), (3, "x" * 300_000), (4, "é")] + [(9, "same")] * 400
    df = docs(*rows)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        found = shards.place(df, ["doc_id"], shards=5, seed=3)
    finally:
        spark.conf.unset(merging)
    out = found.collect()
    assert found.columns == ["row", "number", "shard", "slot"]
    assert sorted(r["number"] for r in out) == list(range(len(rows)))
    order = [r["row"]["doc_id"] for r in sorted(out, key=lambda r: r["number"])]
    assert order == [None, None, 3, 3, 3, 4] + [9] * 400
    assert set(out[0]["row"].asDict()) == set(df.columns)
    counts = Counter(r["shard"] for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
    # the rows of one key are numbered by more than one task
    hot = found.where("row.doc_id = 9").select(F.input_file_name().alias("f")).distinct()
    assert hot.count() > 1
    digest = shards.sharded(df)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in digest.collect()) == expected(rows, 24)


def test_empty_one_row_and_more_shards_than_rows(spark, docs):
    assert shards.sharded(docs()).collect() == []
    one = shards.sharded(docs((1, "a"))).collect()
    assert [(r["shard"], r["slot"], r["law"], r["grown_shard"]) for r in one] == [(0, 0, "rows", None)]
    three = shards.sharded(docs((1, "a"), (2, "b"), (3, "c"))).collect()
    assert sorted(r["shard"] for r in three) == [0, 1, 2] and {r["slot"] for r in three} == {0}


def test_files(spark, docs, tmp_path):
    rows = [(i, f"t{i}") for i in range(100)]
    placed = shards.place(docs(*rows), ["doc_id"], shards=4)
    shards.write(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("shard", "slot", "row.doc_id").count() == 100
    assert back.where("shard = 1").count() == 25
