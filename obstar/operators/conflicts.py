"""Insert-ignore into a table with several unique keys.

Rows are offered one after the other in a stated order; a row is kept if none of
its keys has been taken. Deduplicating by one key and then by the other gives a
different answer: of (1,A), (2,A), (2,B) the first and the last are kept.

A round accepts the rows that come first under every one of their keys and
drops the rows that share a key with an accepted row. This gives the sequential
answer (see Blelloch, Fineman, Shun: Greedy sequential maximal independent set
and matching are parallel on average, SPAA 2012), usually in a few rounds, each of which
settles a good part of what is left.

Where conflicts form chains, each row in the way of the next, a round settles a link. A
round that settles less than a tenth of the rows is therefore followed by one that follows
chains: a row with a single row before it that shares a key with it is kept if that one is
not. Such rows hang on each other as trees, so whether a row is kept or not is told by the
root of its tree and the number of steps to it. Ways to the roots are shortened within
`GROUP` rows that follow each other first, and then doubled, so the steps grow with the
logarithm of the longest chain. Rows below a root that has nothing before it are settled.

If that settles less than a tenth as well, chains run together all over: the components of
the conflicts are found, and the first rows of each, in the stated order and at most `GROUP`
of them, are settled one after the other in a task of their own. Rows depend on earlier rows
of their component only, so this is exact; a component of more rows is settled `GROUP` rows
at a time, with a round that follows chains after each. A task never holds more than that.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from obstar.operators import components
from obstar.operators.dedupe import first_per_key, total_order
from obstar.operators.keys import absent_from
from obstar.operators.merge import fresh_rows
from obstar.operators.numbering import dense_ids
from obstar.session import materialize

#: Rows of a component that one task settles at a time.
GROUP = 100_000
#: Share of the undecided rows that a round must settle to be followed by another one.
LEAST = 0.1
_RANK, _COMPONENT, _PLACE = "_rank", "_component", "_place"
_UP, _ODD, _CHUNK, _NEXT, _TURN = "_up", "_odd", "_chunk", "_next", "_turn"
_ROUND, _CHAINS, _COMPONENTS = "round", "chains", "components"
_LINK = f"{_RANK} bigint, {_UP} bigint, {_ODD} boolean"


class TooManyRounds(RuntimeError):
    """Rows were still undecided after the last round that was allowed."""


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """A frame as stored, and the number of its rows."""
    seen = Observation()
    stored = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return stored, seen.get["n"]


def _first_under_all(left: DataFrame, unique_keys: Sequence[Sequence[str]]) -> DataFrame:
    """Rows that come first under every key: their number is the least of each."""
    winners = None
    for key in unique_keys:
        first = left.groupBy(*key).agg(F.min(_RANK).alias(_RANK)).select(_RANK)
        winners = first if winners is None else winners.join(first, _RANK, "left_semi")
    return left.join(winners, _RANK, "left_semi")


def _hindered(left: DataFrame, unique_keys: Sequence[Sequence[str]]) -> DataFrame:
    """(rank, up): the rows that come before no more than one other row shares a key with.

    `up` is that row; NULL if there is none. Rows with more of them are left out.
    """
    places = None
    for key in unique_keys:
        first = left.groupBy(*key).agg(F.min(_RANK).alias(_UP))
        rest = left.join(first.select(F.col(_UP).alias(_RANK)), _RANK, "left_anti")
        second = rest.groupBy(*key).agg(F.min(_RANK).alias(_RANK)).join(first, list(key)).select(_RANK, _UP)
        here = first.select(F.col(_UP).alias(_RANK), F.lit(None).cast("bigint").alias(_UP)).unionByName(second)
        places = here if places is None else places.unionByName(here)
    met = places.groupBy(_RANK).agg(F.count("*").alias("n"), F.min(_UP).alias(_UP), F.max(_UP).alias("top"))
    alike = F.col(_UP).isNull() | (F.col(_UP) == F.col("top"))
    return met.where((F.col("n") == len(unique_keys)) & alike).select(_RANK, _UP)


def _shortened():
    """Links of neighbouring ranks to the same links, each led on to where it leaves them."""

    def shorten(links: pd.DataFrame) -> pd.DataFrame:
        ordered = links.sort_values(_RANK)
        ranks, up = ordered[_RANK].to_numpy(), ordered[_UP].to_numpy()
        odd = ordered[_ODD].to_numpy(dtype=bool)
        while True:
            at = np.minimum(np.searchsorted(ranks, up), len(ranks) - 1)
            inside = ranks[at] == up
            if not inside.any():
                return pd.DataFrame({_RANK: ranks, _UP: up, _ODD: odd})
            up, odd = np.where(inside, up[at], up), np.where(inside, odd ^ odd[at], odd)

    return shorten


def _led_on(links: DataFrame, ways: DataFrame) -> DataFrame:
    """Links with the way from their upper end, where that has one, added."""
    further = ways.select(F.col(_RANK).alias(_UP), F.col(_UP).alias(_NEXT), F.col(_ODD).alias(_TURN))
    return links.join(further, _UP, "left").select(
        _RANK,
        F.coalesce(_NEXT, _UP).alias(_UP),
        (F.col(_ODD) != F.coalesce(_TURN, F.lit(False))).alias(_ODD),
        F.col(_NEXT).isNotNull().alias(_TURN),
    )


def _kept_by_chains(left: DataFrame, unique_keys: Sequence[Sequence[str]], group: int) -> DataFrame:
    """The ranks of rows that are kept: those that nothing is before, and those at an even
    number of steps below one in a chain of single links."""
    hindered = materialize(_hindered(left, unique_keys), "hindered")
    free = hindered.where(F.col(_UP).isNull()).select(_RANK)
    links = hindered.where(F.col(_UP).isNotNull()).withColumn(_ODD, F.lit(True))
    chunk = F.floor(F.col(_RANK) / group).alias(_CHUNK)
    links = materialize(links.groupBy(chunk).applyInPandas(_shortened(), _LINK), "links")
    # only rows that others hang on are led to their roots step by step
    ways = links.join(links.select(F.col(_UP).alias(_RANK)).distinct(), _RANK, "left_semi")
    while True:
        seen = Observation()
        led = _led_on(ways, ways).observe(seen, F.count_if(_TURN).alias("n"))
        ways = materialize(led.drop(_TURN), "ways")
        if not seen.get["n"]:
            break
    below = _led_on(links, ways).where(~F.col(_ODD))
    return below.join(free.select(F.col(_RANK).alias(_UP)), _UP, "left_semi").select(_RANK).unionByName(free)


def _settled(unique_keys: Sequence[Sequence[str]]):
    """Rows of one component to the ranks of those that are kept, one after the other."""

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        ordered = rows.sort_values(_RANK)
        taken: list[set] = [set() for _ in unique_keys]
        kept = []
        offered: Iterator = zip(ordered[_RANK], *[zip(*[ordered[c] for c in key]) for key in unique_keys])
        for rank, *values in offered:
            if any(v in seen for v, seen in zip(values, taken)):
                continue
            kept.append(rank)
            for v, seen in zip(values, taken):
                seen.add(v)
        return pd.DataFrame({_RANK: pd.Series(kept, dtype="int64")})

    return settle


def _first_of_components(left: DataFrame, unique_keys: Sequence[Sequence[str]], group: int) -> tuple[DataFrame, DataFrame]:
    """The first rows of each component, and the ranks of those that are kept.

    Rows that share no key with another are in no component: they are kept.
    """
    identity = list(dict.fromkeys(c for key in unique_keys for c in key))
    found = components.of_rows(left, _RANK, unique_keys, _COMPONENT)
    in_order = Window.partitionBy(_COMPONENT).orderBy(_RANK)
    # only the first rows of a component leave the tasks that read it
    placed = found.withColumn(_PLACE, F.row_number().over(in_order)).where(F.col(_PLACE) <= group)
    first = materialize(left.select(_RANK, *identity).join(placed.drop(_PLACE), _RANK), "first-of-components")
    kept = first.groupBy(_COMPONENT).applyInPandas(_settled(unique_keys), f"{_RANK} bigint")
    alone = left.select(_RANK).join(found.select(_RANK), _RANK, "left_anti")
    return first, kept.unionByName(alone)


def insert_ignore_all(
    target: DataFrame,
    source: DataFrame,
    unique_keys: Sequence[Sequence[str]],
    order_by: Sequence[str],
    max_rounds: int | None = None,
    group: int = GROUP,
) -> DataFrame:
    """Add the rows of `source` that conflict with nothing before them.

    `unique_keys` lists the column sets that must be unique, each NOT NULL. No row
    is ever left undecided: beyond `max_rounds`, if given, the call fails.
    """
    identity = list(dict.fromkeys(c for key in unique_keys for c in key))
    order = total_order(source, (), order_by)
    left = first_per_key(source, identity, order)
    for key in unique_keys:
        left = fresh_rows(target, left, key)
    left, remaining = _stored(dense_ids(left, order, _RANK), "unsettled")

    accepted: list[DataFrame] = []
    step = _ROUND
    while remaining:
        if max_rounds is not None and len(accepted) >= max_rounds:
            raise TooManyRounds(f"{remaining} rows undecided after {max_rounds} rounds")
        if step == _COMPONENTS:
            first, kept = _first_of_components(left, unique_keys, group)
            winners = materialize(left.join(kept, _RANK, "left_semi"), "accepted")
            # those of the first that were not kept share a key with one that was
            left = left.join(first.select(_RANK), _RANK, "left_anti")
        elif step == _CHAINS:
            kept = _kept_by_chains(left, unique_keys, group)
            winners = materialize(left.join(kept, _RANK, "left_semi"), "accepted")
        else:
            winners = materialize(_first_under_all(left, unique_keys), "accepted")
        accepted.append(winners)
        for key in unique_keys:
            left = absent_from(left, winners, key)
        before = remaining
        left, remaining = _stored(left, "unsettled")
        if before - remaining >= before * LEAST:
            step = _ROUND
        else:
            step = _COMPONENTS if step == _CHAINS else _CHAINS

    result = target
    for rows in accepted:
        result = result.unionByName(rows.select(*target.columns))
    return result
