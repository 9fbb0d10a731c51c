"""SimHash near-duplicates: fingerprints linked by pivot distance tables.

Fingerprint: words in lower case (A-Z only), shingles of three words, XXH64 of each;
a bit is set if it is set in more than half the hashes.

Linking works on distinct fingerprints, so exact copies cost one row however many there
are. Candidates come from the pigeonhole rule: 64 bits are cut into 6 blocks; 3 flipped
bits leave at least 3 blocks as they were, so two linked fingerprints share the bits of
one of the 20 triples of blocks (about 32 bits). The rows of one triple's value form a
cell. In a cell, each fingerprint has a row in a table of its Hamming distances to
`PIVOTS` reference fingerprints. By the triangle inequality two fingerprints whose rows
differ by more than 3 in any coordinate cannot be linked; only the pairs that are left
are compared bit by bit. The first reference is the cell's own smallest fingerprint: its
column gives the links to it, and orders the cell, so that each fingerprint meets only
those in a window of 3 about its own distance. A cell gives back a spanning forest of
its links (fewer rows than it has fingerprints), never all its pairs.

Cells of more than `CELL` fingerprints are cut into slices by their distance to the
cell's smallest fingerprint and by order; each pair of slices that may hold a link is a
task of its own, of at most 2 * CELL rows. No pair is dropped at any size.

Defined results: null, empty or blank text: fingerprint zero, linked like any other;
texts of any length are hashed whole, in blocks; repeated rows each get the same result;
a null doc_id is hashed and linked, and names a component only if no other document is
in it; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obstar.llm.common import prepare
from obstar.llm.components import components
from obstar.session import materialize

SEED = 42
BLOCKS, KEPT, BITS = 6, 3, 64
#: Reference fingerprints of a distance table, besides the cell's own.
PIVOTS = 24
#: Fingerprints of a cell that one task compares; larger cells are sliced.
CELL = 4096
#: Shingles whose bits are counted at a time.
_AT_ONCE = 1 << 15


def fingerprint(text: str | None, words: int = 3) -> int:
    """The fingerprint of a text, as an unsigned number."""
    data = b" ".join((text or "").encode("utf-8").lower().split())
    if not data:
        return 0
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(data)]))
    n = max(1, len(starts) - words + 1)
    first, last = starts[:n].tolist(), ends[min(words, len(ends)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, _AT_ONCE):
        found = [
            digest(data[a:b], SEED) for a, b in zip(first[at : at + _AT_ONCE], last[at : at + _AT_ONCE])
        ]
        rows = np.array(found, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprint_column(text: Column, words: int = 3) -> Column:
    """Fingerprints as signed 64-bit integers."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return simhash(text)


def hex_column(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def block_masks() -> list[int]:
    """The bits of each triple of blocks, as signed numbers."""
    edges = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, KEPT)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def pivots() -> np.ndarray:
    """Reference fingerprints: fixed, spread evenly at random."""
    names = (xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(PIVOTS))
    return np.fromiter(names, np.uint64, PIVOTS)


def distance_table(prints: np.ndarray, references: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[:, None] ^ references[None, :]).astype(np.int8)


def near_pairs(
    prints: np.ndarray, left: np.ndarray, right: np.ndarray, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of index pairs (a in left, b in right, a < b in the order) within `most` bits.

    `left` and `right` mark the rows of either slice; with one slice both mark all.
    """
    if len(prints) < 2:
        return
    own = prints.min()
    near = np.bitwise_count(prints ^ own).astype(np.int16)
    order = np.lexsort((prints, near))
    prints, near, left, right = prints[order], near[order], left[order], right[order]
    table = distance_table(prints, pivots())
    until = np.searchsorted(near, near + most, side="right")
    step = max(1, (1 << 21) // len(prints))
    for at in range(0, len(prints), step):
        rows = np.arange(at, min(at + step, len(prints)))
        high = until[rows].max()
        cols = np.arange(at + 1, high)
        if not len(cols):
            continue
        maybe = (cols[None, :] > rows[:, None]) & (cols[None, :] < until[rows][:, None])
        maybe &= (left[rows][:, None] & right[cols][None, :]) | (
            right[rows][:, None] & left[cols][None, :]
        )
        a, b = np.nonzero(maybe)
        a, b = rows[a], cols[b]
        for some in np.array_split(np.arange(table.shape[1]), 1 if len(a) < 1000 else PIVOTS):
            keep = np.abs(table[a][:, some] - table[b][:, some]).max(axis=1, initial=0) <= most
            a, b = a[keep], b[keep]
        keep = np.bitwise_count(prints[a] ^ prints[b]) <= most
        yield order[a[keep]], order[b[keep]]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Links that join what the pairs join, one less than its nodes for each tree."""
    parent = list(range(n))
    kept = []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for left, right in pairs:
        for a, b in zip(left.tolist(), right.tolist()):
            x, y = top(a), top(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                kept.append((a, b))
    return kept


def _cell_links(most: int):
    """Links of cells that arrive one after the other, sorted."""
    keys = ("triple", "bits", "low", "high")

    def of_cell(fp: np.ndarray, slices: np.ndarray, low: int, high: int) -> np.ndarray:
        pairs = near_pairs(fp.view(np.uint64), slices == low, slices == high, most)
        return fp[np.array(forest(len(fp), pairs), np.int64).reshape(-1, 2)]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in (*keys, "fp", "slice")])
            rows = rows if held is None else np.concatenate((held, rows), axis=1)
            cuts = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
            starts = np.concatenate(([0], cuts))
            held = rows[:, starts[-1] :]  # its cell may go on in the next batch
            found = [
                of_cell(rows[4, a:b], rows[5, a:b], rows[2, a], rows[3, a])
                for a, b in zip(starts[:-1], cuts)
                if b - a > 1
            ]
            yield as_batch(found)
        if held is not None:
            yield as_batch([of_cell(held[4], held[5], held[2, 0], held[3, 0])])

    def as_batch(found: list[np.ndarray]) -> pa.RecordBatch:
        u, v = np.concatenate([np.empty((0, 2), np.int64), *found]).T
        return pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

    return links


def fingerprint_links(prints: DataFrame, most: int = 3, cell: int = CELL) -> DataFrame:
    """(u, v): links that join distinct fingerprints `fp` within `most` bits of each other.

    A spanning forest of each cell: the components are those of all links.
    """
    if most > BLOCKS - KEPT:
        raise ValueError(f"at most {BLOCKS - KEPT} bits")
    cells = prints.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in block_masks()])).alias(
            "triple", "bits"
        ),
    )
    sizes = (
        cells.groupBy("triple", "bits")
        .agg(F.count("*").alias("n"), F.min("fp").alias("own"))
        .where("n > 1")
    )
    shared = cells.join(sizes, ["triple", "bits"])
    # slices of a large cell: by distance to its smallest fingerprint, then by a hash
    parts = F.ceil(F.col("n") / F.lit(cell)).cast("int")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("own"))).cast("int")
    part = F.when(F.col("n") <= cell, F.lit(0)).otherwise(F.pmod(F.xxhash64("fp"), parts).cast("int"))
    band = F.when(F.col("n") <= cell, F.lit(0)).otherwise(F.floor(near / (most + 1)).cast("int"))
    sliced = shared.select(
        "triple", "bits", "fp", "n", band.alias("band"), part.alias("part"), parts.alias("parts")
    )
    # a slice meets those of its own band and of the next ones on either side
    last = F.when(F.col("n") <= cell, F.col("parts") * 0 + 1).otherwise(F.col("parts"))
    meets = F.flatten(
        F.transform(
            F.when(F.col("n") <= cell, F.array(F.lit(0))).otherwise(
                F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)
            ),
            lambda b: F.transform(
                F.sequence(F.lit(0), last - 1), lambda p: b * F.lit(1 << 24) + p
            ),
        )
    )
    code = F.col("band") * F.lit(1 << 24) + F.col("part")
    dealt = sliced.select(
        "triple", "bits", "fp", code.alias("slice"), F.explode(meets).alias("other")
    ).select(
        "triple",
        "bits",
        "fp",
        "slice",
        F.least("slice", "other").alias("low"),
        F.greatest("slice", "other").alias("high"),
    )
    keys = ["triple", "bits", "low", "high"]
    sorted_cells = (
        dealt.select(*[F.col(c).cast("long") for c in (*keys, "fp", "slice")])
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )
    return sorted_cells.mapInArrow(_cell_links(most), "u long, v long").distinct()


def near_duplicates(documents: DataFrame, words: int = 3, most: int = 3) -> DataFrame:
    """doc_id, fp (signed), component_id of every row of `documents`."""
    prepare(documents.sparkSession)
    hashed = materialize(
        documents.select("doc_id", fingerprint_column(F.col("text"), words).alias("fp")), "simhash"
    )
    prints = materialize(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    joined = components(fingerprint_links(prints.select("fp"), most))
    # a component is named by its smallest document, not by its smallest fingerprint
    member = prints.join(joined, prints["fp"] == joined["node"], "left").select(
        prints["fp"], "first", F.coalesce("component", prints["fp"]).alias("component")
    )
    named = member.groupBy("component").agg(F.min("first").alias("component_id"))
    names = member.join(named, "component").select("fp", "component_id")
    return hashed.join(names, "fp").select("doc_id", "fp", "component_id")


def representatives(documents: DataFrame, words: int = 3, most: int = 3) -> DataFrame:
    """doc_id of the one document of each group that stays, the smallest."""
    found = near_duplicates(documents, words, most)
    return found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
