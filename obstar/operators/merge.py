"""Insert-ignore and upsert against a target table.

Both return the target's new content. The batch is reduced to one row per key
first; the target must be unique by key already. The target is only ever the
streamed side of a join with the batch, so a batch below the broadcast limit
never makes Spark shuffle the target.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from obstar.operators.dedupe import first_per_key, last_per_key
from obstar.operators.keys import absent_from, matches, prefixed, present_in
from obstar.operators.numbering import dense_ids, highest_id
from obstar.session import materialize

INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"
_ACTION = "_action"


def fresh_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    nullable: Collection[str] = (),
    one_per_key: bool = False,
) -> DataFrame:
    """Rows of the batch whose key the target does not have.

    The target's keys are cut down to those in the batch before they are
    compared: that join can broadcast the batch, where a plain anti-join of the
    batch with the target could only broadcast the target. A key the batch has many
    times stands once on the right side, which Spark does not split; `one_per_key`
    says that it has none.
    """
    offered = batch.select(*keys)
    offered = offered if one_per_key else offered.distinct()
    known = present_in(target.select(*keys), offered, keys, nullable)
    return absent_from(batch, known, keys, nullable)


def _with_ids(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], id_column: str | None
) -> DataFrame:
    if id_column is None:
        return rows
    return dense_ids(rows, keys, id_column, start=highest_id(target, id_column))


def _like(target: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in rows.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def insert_ignore(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    id_column: str | None = None,
    nullable: Collection[str] = (),
) -> DataFrame:
    """Add rows with new keys; the first row of a key wins, existing rows stay."""
    batch = first_per_key(source, keys, order_by)
    fresh = fresh_rows(target, batch, keys, nullable, one_per_key=True)
    fresh = _with_ids(target, fresh, keys, id_column)
    return target.unionByName(_like(target, fresh))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    id_column: str | None = None,
    nullable: Collection[str] = (),
    id_start: int | None = None,
    one_per_key: bool = False,
) -> DataFrame:
    """Overwrite the non-key columns of known keys and add rows with new keys.

    The last row of a key wins. Ids of known keys never change. A NULL in the
    batch overwrites. With nothing but key columns this is insert-ignore.
    `id_start` is the highest id in use where the target given here is only the
    part of the table the batch can touch. `one_per_key` says that the source is
    a stored table with one row per key, so nothing is left to reduce.
    """
    values = [c for c in target.columns if c in source.columns and c not in keys and c != id_column]
    if not values:
        return insert_ignore(target, source, keys, order_by, id_column, nullable)

    batch = source if one_per_key else last_per_key(source, keys, order_by)
    if not one_per_key:
        batch = materialize(batch, "batch")
    if id_column is not None and id_start is None:
        id_start = highest_id(target, id_column)
    done = apply(target, batch, keys, values, nullable)
    fresh = done.fresh
    if id_column is not None:
        fresh = dense_ids(fresh, keys, id_column, start=id_start)
    return done.kept.unionByName(_like(target, fresh))


@dataclass(frozen=True)
class Applied:
    """A target with the changes of a batch, the batch's new rows, and what was done.

    Both frames are stored. `did` has the counts by action and the affected rows as an
    upserting database reports them: 1 for an insert, 2 for an update, 0 for a row that
    stays as it is. `matched` counts the rows of the target that the batch met.
    """

    kept: DataFrame
    fresh: DataFrame
    did: dict[str, int]
    matched: int


def apply(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    nullable: Collection[str] = (),
) -> Applied:
    """Merge a stored batch with one row per key into a target.

    The target is read once, for one join whose result is stored: changed rows, what the
    batch met, and the counts all come from it, the counts as it is written. New rows are
    what is left of the batch without the keys that were met.
    """
    old = F.struct(*[F.col(c) for c in values])
    new = F.struct(*[F.col("_new")[c].cast(target.schema[c].dataType).alias(c) for c in values])
    action = F.when(F.col("_new").isNotNull(), F.when(old.eqNullSafe(new), UNCHANGED).otherwise(UPDATED))
    joined = target.join(_changes(batch, keys, values), matches(keys, nullable), "left")
    changed = joined.withColumn(_ACTION, action).select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[f.name])
            .otherwise(F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            if f.name in values
            else F.col(f.name)
            for f in target.schema.fields
        ],
        _ACTION,
    )
    seen, added = Observation(), Observation()
    counts = [F.count_if(F.col(_ACTION) == a).alias(a) for a in (UPDATED, UNCHANGED)]
    stored = materialize(changed.observe(seen, *counts), "merged")
    met = stored.where(F.col(_ACTION).isNotNull()).select(*keys)
    fresh = absent_from(batch, met, keys, nullable).observe(added, F.count(F.lit(1)).alias(INSERTED))
    fresh = materialize(fresh, "fresh")
    did = {INSERTED: added.get[INSERTED], **{a: seen.get[a] for a in (UPDATED, UNCHANGED)}}
    matched = did[UPDATED] + did[UNCHANGED]
    did["affected"] = did[INSERTED] + 2 * did[UPDATED]
    return Applied(stored.drop(_ACTION), fresh, did, matched)


def numbered(done: Applied, target: DataFrame, keys: Sequence[str], id_column: str, start: int) -> DataFrame:
    """The target's new content, its new rows with ids after `start`."""
    return done.kept.unionByName(_like(target, dense_ids(done.fresh, keys, id_column, start=start)))


def _changes(batch: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return prefixed(batch, keys, [F.struct(*values).alias("_new")])


def upsert_actions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    nullable: Collection[str] = (),
    one_per_key: bool = False,
) -> DataFrame:
    """One row per key of the batch with what an upsert would do to it."""
    values = [c for c in target.columns if c in source.columns and c not in keys]
    batch = source if one_per_key else last_per_key(source, keys, order_by)
    known = present_in(target, batch, keys, nullable)
    # without values there is nothing to change: a known key is unchanged
    old = prefixed(known, keys, [F.struct(*values).alias("_old")])
    new = F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in values])
    action = (
        F.when(F.col("_old").isNull(), INSERTED)
        .when(F.col("_old").eqNullSafe(new), UNCHANGED)
        .otherwise(UPDATED)
    )
    joined = batch.join(old, matches(keys, nullable), "left")
    return joined.select(*keys, action.alias("action"))


def count_actions(actions: DataFrame) -> DataFrame:
    """Counts by action, and the affected rows as an upserting database reports
    them: 1 for an insert, 2 for an update, 0 for a row that stays as it is."""
    inserted, updated, unchanged = (
        F.count_if(F.col("action") == a) for a in (INSERTED, UPDATED, UNCHANGED)
    )
    return actions.agg(
        inserted.alias("inserted"),
        updated.alias("updated"),
        unchanged.alias("unchanged"),
        (inserted + 2 * updated).alias("affected"),
    )
