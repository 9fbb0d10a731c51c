"""Connected components of rows that share keys.

Rows have a unique number. Two rows that share a key belong together, and so do those that
a third one connects. Each key hangs its rows on its first row, so a key with many rows
gives a link a row and never pairs. Links are then shortened by alternating the large-star
and small-star steps (Kiveris and others, Connected components in MapReduce and beyond,
SoCC 2014) until every row hangs on the first of its component; rounds grow with the
logarithm of the rows, and a chain of them is no worse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from obstar.session import materialize

_HIGH, _LOW, _FIRST = "_high", "_low", "_first"


def _hung_on_first(rows: DataFrame, number: str, keys: Sequence[str]) -> DataFrame:
    first = rows.groupBy(*keys).agg(F.min(number).alias(_LOW))
    linked = rows.select(F.col(number).alias(_HIGH), *keys).join(first, list(keys))
    return linked.where(F.col(_HIGH) > F.col(_LOW)).select(_HIGH, _LOW)


def _large_star(links: DataFrame) -> DataFrame:
    """Each row's later neighbours are hung on its first neighbour."""
    turned = links.select(F.col(_LOW).alias(_HIGH), F.col(_HIGH).alias(_LOW))
    around = links.unionByName(turned)
    first = around.groupBy(_HIGH).agg(F.least(F.min(_LOW), F.col(_HIGH)).alias(_FIRST))
    later = around.where(F.col(_LOW) > F.col(_HIGH)).join(first, _HIGH)
    return later.select(F.col(_LOW).alias(_HIGH), F.col(_FIRST).alias(_LOW))


def _small_star(links: DataFrame) -> DataFrame:
    """Each row and its earlier neighbours are hung on the first of them."""
    first = links.groupBy(_HIGH).agg(F.min(_LOW).alias(_FIRST))
    earlier = links.join(first, _HIGH).where(F.col(_LOW) > F.col(_FIRST))
    return earlier.select(F.col(_LOW).alias(_HIGH), F.col(_FIRST).alias(_LOW)).unionByName(
        first.select(_HIGH, F.col(_FIRST).alias(_LOW))
    )


def of_rows(rows: DataFrame, number: str, unique_keys: Sequence[Sequence[str]], component: str) -> DataFrame:
    """(number, component) of the rows that share a key with another; component is the
    smallest number of it."""
    links = None
    for keys in unique_keys:
        more = _hung_on_first(rows, number, keys)
        links = more if links is None else links.unionByName(more)
    before = None
    while True:
        seen = Observation()
        marks = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(_HIGH, _LOW)).alias("hash")
        links = materialize(links.distinct().observe(seen, *marks), "links")
        mark = (seen.get["n"], seen.get["hash"])
        if mark == before or not mark[0]:
            break
        before, links = mark, _small_star(_large_star(links).distinct())
    firsts = links.select(F.col(_LOW).alias(_HIGH), _LOW).distinct()
    return links.unionByName(firsts).select(F.col(_HIGH).alias(number), F.col(_LOW).alias(component))
