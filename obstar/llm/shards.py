"""Sharding by a Feistel permutation of the global row numbers.

Every row gets its number in the order of its key: rows are range-partitioned and sorted,
and a row's number is its place in its partition and the rows of the partitions before it;
one count per partition goes through the driver. A Feistel network permutes the numbers
0 to n-1: a number is split into a left and a right part of bits, and rounds change one
part by a keyed hash of the other. The network works on a power of two of at most 2n;
results of n or more are put through it again until one is below n (cycle walking), which
keeps it one-to-one. The permuted number p gives shard p mod k and slot p div k.

So the shuffle is reproducible (n, k and the seed fix it, whatever the partitions are),
shards differ by one row at most, slots have no gaps, and any row's shard and slot, and
which row a slot has, can be computed without looking at the data (`places`, `numbers`).

Rows of one key are spread: the range partitions go by the key, then by a hash of the
row, then by the place in the input, so that a key with a third of all rows, or a third of
all rows that are the same, is cut. Memory is that of one Arrow batch.

Defined results: null keys come first; rows of one key are ordered by the hash of the row;
equal rows have any order among themselves, which no result can show; a null text has size
0 before what is added to it, and the checksum of the empty text; texts of any length are
read whole; an empty table gives an empty result; columns of the input are kept inside
`row`, so no name of theirs can clash. Columns that hold maps are not part of the hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obstar.llm.common import prepare
from obstar.operators.numbering import dense_ids, highest_id

ROUNDS = 8
# Multipliers of a well-known 32-bit hash (xxHash's primes 1 to 3).
PRIMES = (2654435761, 2246822519, 3266489917)
_LOW = np.uint64(0xFFFFFFFF)


def round_keys(seed: int) -> list[int]:
    return [zlib.crc32(f"{seed}:{i}".encode()) for i in range(ROUNDS)]


def widths(n: int) -> tuple[int, int]:
    """Bits of the left and the right part for numbers below n."""
    bits = max(2, (n - 1).bit_length())
    return bits // 2, bits - bits // 2


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed 32-bit hash of numbers below 2**32."""
    a, b, c = (np.uint64(p) for p in PRIMES)
    x = (x * a + np.uint64(key)) & _LOW
    x = ((x ^ (x >> np.uint64(15))) * b) & _LOW
    x = ((x ^ (x >> np.uint64(13))) * c) & _LOW
    return x ^ (x >> np.uint64(16))


def _network(x: np.ndarray, n: int, keys: Sequence[tuple[int, int]]) -> np.ndarray:
    """The rounds, in the order given, on numbers of the network's width."""
    left_bits, right_bits = widths(n)
    left_mask, right_mask = (np.uint64((1 << b) - 1) for b in (left_bits, right_bits))
    left, right = x >> np.uint64(right_bits), x & right_mask
    for i, key in keys:
        if i % 2:
            right = right ^ (_mixed(left, key) & right_mask)
        else:
            left = left ^ (_mixed(right, key) & left_mask)
    return left << np.uint64(right_bits) | right


def _walked(numbers: np.ndarray, n: int, keys: Sequence[tuple[int, int]]) -> np.ndarray:
    found = np.asarray(numbers, np.uint64).copy()
    if found.size and int(found.max()) >= n:
        raise ValueError("numbers go from 0 to n - 1")
    walking = np.arange(len(found))
    while walking.size:
        found[walking] = _network(found[walking], n, keys)
        walking = walking[found[walking] >= np.uint64(n)]
    return found.astype(np.int64)


def permuted(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The place of each of the numbers 0 to n-1 in the shuffle."""
    return _walked(numbers, n, list(enumerate(round_keys(seed))))


def restored(places: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The number at each place of the shuffle."""
    return _walked(places, n, list(enumerate(round_keys(seed)))[::-1])


def places(numbers: np.ndarray, n: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    at = permuted(numbers, n, seed)
    return at % shards, at // shards


def numbers(shard: int, slots: np.ndarray, n: int, shards: int, seed: int) -> np.ndarray:
    """The numbers of the rows in slots of a shard."""
    return restored(np.asarray(slots, np.int64) * shards + shard, n, seed)


def _permuted_column(number: Column, n: int, seed: int) -> Column:
    @F.arrow_udf("long")
    def feistel(given: pa.Array) -> pa.Array:
        return pa.array(permuted(given.to_numpy(zero_copy_only=False), n, seed))

    return feistel(number)


def place(rows: DataFrame, keys: Sequence[str], shards: int = 24, seed: int = 0) -> DataFrame:
    """(row, number, shard, slot): every row of the input with its place.

    `row` holds all columns of the input. Numbers go from 0 in the order of the keys.
    """
    prepare(rows.sparkSession)
    hashed = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
    whole = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    order = {f"_key{i}": F.col("row")[k] for i, k in enumerate(keys)}
    order["_hash"] = F.xxhash64(*[F.col("row")[c] for c in hashed])
    order["_place"] = F.monotonically_increasing_id()
    numbered = dense_ids(whole.select("row", *[c.alias(k) for k, c in order.items()]), list(order), "_id")
    n = highest_id(numbered, "_id")
    number = F.col("_id") - 1
    placed = numbered.select("row", number.alias("number"), _permuted_column(number, n, seed).alias("at"))
    return placed.select(
        "row",
        "number",
        (F.col("at") % shards).cast("int").alias("shard"),
        F.expr(f"at div {shards}").alias("slot"),
    )


def write(placed: DataFrame, folder: str) -> None:
    """The rows of each shard in its own folder `shard=…`, sorted by slot in every file.

    A shard's rows may be in several files of ascending slots, so no task writes a shard
    alone.
    """
    by_slot = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    by_slot.select("shard", "slot", "row").write.partitionBy("shard").parquet(folder)


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, size (bytes of the text, and 8) and text_crc32 of each document."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return documents.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def sharded(documents: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each document.

    Documents of one doc_id are ordered by a hash of doc_id, size and checksum.
    """
    found = place(sizes(documents), ["doc_id"], shards, seed)
    return found.select(
        "row.*",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
