"""Versioned tables under one root, published together.

A load writes new files beside the old ones and then one small commit record that
names the files of every table. Readers follow the commit record with the highest
number, so they see all tables of a load or none, and a load that fails before
its record leaves everything as it was.

    <root>/commits/n=<number>/…json              the commit records
    <root>/<dimension>/<version>/…parquet        a dimension, whole
    <root>/FaitDonneesMeteo/version=<version>/annee=/mois=/jour=/seau=/…parquet
    <root>/presence/version=<version>/…parquet   the locations of each part, as bitmaps

Each load writes to folders of its own name, so two loads never share an output
folder. The fact is kept in parts, by day and by bucket of the location's key. A commit
record lists the version of each part: a load rewrites the parts its keys fall into and
carries the others over by name. Keys are dense, so buckets are alike in size; a location
that holds much of a day is written as several files of its part.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obstar.operators import presence
from obstar.schemas import FAIT, WAREHOUSE
from obstar.sources import numbered

FACT = "FaitDonneesMeteo"
DAY = ["annee", "mois", "jour"]
BUCKET = "seau"
PART = [*DAY, BUCKET]
LOCATION = "id_dim_lieu_fk"
#: Buckets of a new warehouse, unless its first load says otherwise; its commits keep the number.
BUCKETS = 4
FACT_STORED = T.StructType([*FAIT.fields, *[T.StructField(c, T.IntegerType()) for c in PART]])
PRESENCE_STORED = T.StructType(
    [
        *[T.StructField(c, T.IntegerType()) for c in PART],
        T.StructField(presence.BLOCK, T.LongType()),
        T.StructField(presence.BITS, T.BinaryType()),
        T.StructField("rows", T.LongType()),
    ]
)

_RECORD = (
    "batch STRING, dims MAP<STRING, STRING>, "
    "parts ARRAY<STRUCT<annee: INT, mois: INT, jour: INT, seau: INT, version: STRING, rows: BIGINT>>, "
    "buckets INT, top_fact_id BIGINT, streams MAP<STRING, BIGINT>, counts MAP<STRING, BIGINT>, token STRING"
)


DayKey = tuple[int, int, int]
PartKey = tuple[int, int, int, int]


class ConcurrentLoad(RuntimeError):
    """Another load published first, or two published at once."""


@dataclass(frozen=True)
class Part:
    annee: int
    mois: int
    jour: int
    seau: int
    version: str
    rows: int

    @property
    def key(self) -> PartKey:
        return self.annee, self.mois, self.jour, self.seau

    @property
    def day(self) -> DayKey:
        return self.annee, self.mois, self.jour


@dataclass(frozen=True)
class Snapshot:
    """The tables of one commit."""

    spark: SparkSession
    root: str
    number: int = 0
    batch: str | None = None
    dims: dict[str, str] = field(default_factory=dict)
    parts: tuple[Part, ...] = ()
    buckets: int = BUCKETS
    top_fact_id: int = 0
    streams: dict[str, int] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)

    @property
    def days(self) -> set[DayKey]:
        return {p.day for p in self.parts}

    def bucket_of(self, location: Column) -> Column:
        """The bucket of a location's key."""
        return F.pmod(location, F.lit(self.buckets)).cast("int")

    def dim(self, name: str) -> DataFrame:
        schema = WAREHOUSE[name]
        if name not in self.dims:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{self.dims[name]}")

    def fact(self, parts: Collection[PartKey] | None = None) -> DataFrame:
        """The fact with its storage columns, of the given parts or of all."""
        kept = [p for p in self.parts if parts is None or p.key in parts]
        if not kept:
            return self.spark.createDataFrame([], FACT_STORED)
        base = f"{self.root}/{FACT}"
        paths = [
            f"{base}/version={p.version}/annee={p.annee}/mois={p.mois}/jour={p.jour}/seau={p.seau}"
            for p in kept
        ]
        stored = self.spark.read.schema(FACT_STORED).option("basePath", base).parquet(*paths)
        return stored.select(*FACT_STORED.names)

    def parts_of(self, days: Collection[DayKey]) -> set[PartKey]:
        return {p.key for p in self.parts if p.day in days}

    def presence(self, days: Collection[DayKey] | None = None) -> DataFrame:
        """The bitmaps of the locations that have facts, by part."""
        kept = [p for p in self.parts if days is None or p.day in days]
        if not kept:
            return self.spark.createDataFrame([], PRESENCE_STORED)
        base = f"{self.root}/presence"
        paths = sorted({f"{base}/version={p.version}" for p in kept})
        version = T.StructType([*PRESENCE_STORED.fields, T.StructField("version", T.StringType())])
        stored = self.spark.read.schema(version).option("basePath", base).parquet(*paths)
        # a version has parts that later ones replaced
        names = self.spark.createDataFrame([(*p.key, p.version) for p in kept], ", ".join(f"{c} int" for c in PART) + ", version string")
        return stored.join(names, [*PART, "version"], "left_semi").select(*PRESENCE_STORED.names)

    def newest_days(self, n: int) -> set[DayKey]:
        """The latest days that together hold at least n facts."""
        rows: dict[DayKey, int] = {}
        for part in self.parts:
            rows[part.day] = rows.get(part.day, 0) + part.rows
        wanted: set[DayKey] = set()
        found = 0
        for day in sorted(rows, reverse=True):
            if found >= n:
                break
            wanted.add(day)
            found += rows[day]
        return wanted


def _folder(root: str) -> str:
    return f"{root}/commits"


def current(spark: SparkSession, root: str) -> Snapshot:
    """The latest published snapshot; empty before the first one."""
    latest = numbered.latest(spark, _folder(root))
    if not latest:
        return Snapshot(spark, root)
    row = numbered.read(spark, _folder(root), latest, _RECORD)
    if row is None:
        raise ConcurrentLoad(f"commit {latest} of {root} does not have one record")
    return Snapshot(
        spark,
        root,
        latest,
        row["batch"],
        dict(row["dims"] or {}),
        tuple(Part(**p.asDict()) for p in row["parts"] or []),
        row["buckets"],
        row["top_fact_id"],
        dict(row["streams"] or {}),
        dict(row["counts"] or {}),
    )


def history(spark: SparkSession, root: str) -> DataFrame:
    """The commits: number, batch, and the counts of each load."""
    number = F.regexp_extract("_metadata.file_path", r"/commits/n=(\d+)/[^/]*$", 1).cast("bigint")
    stored = spark.read.schema(_RECORD).option("recursiveFileLookup", "true").json(f"{root}/commits")
    return stored.select(number.alias("number"), "batch", "counts")


def new_version(base: Snapshot) -> str:
    """A name no other attempt at the next commit uses."""
    return f"{base.number + 1}-{uuid.uuid4().hex[:12]}"


def write_dim(base: Snapshot, name: str, rows: DataFrame, version: str) -> DataFrame:
    """Store the whole content of a dimension; returns it as stored."""
    schema = WAREHOUSE[name]
    path = f"{base.root}/{name}/{version}"
    rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.parquet(path)
    return base.spark.read.schema(schema).parquet(path)


def write_parts(
    base: Snapshot, rows: DataFrame, version: str, touched: Collection[PartKey]
) -> list[Part]:
    """Store the whole content of the touched parts, and which locations they have."""
    if not touched:
        return []
    stored = rows.select(*FACT_STORED.names)
    if len(touched) > 1:
        # files of a reasonable size per part; large parts are split
        stored = stored.hint("rebalance", *PART)
    stored.write.partitionBy(*PART).parquet(f"{base.root}/{FACT}/version={version}")
    written = replace(base, parts=tuple(Part(*key, version, 0) for key in touched))
    # of what was written, one column is read again
    presence.by(written.fact(), PART, LOCATION).select(*PRESENCE_STORED.names).write.parquet(
        f"{base.root}/presence/version={version}"
    )
    counted = written.presence().groupBy(*PART).agg(F.sum("rows").alias("rows")).collect()
    return [Part(*(r[c] for c in PART), version, r["rows"]) for r in counted]


def publish(after: Snapshot, batch: str) -> Snapshot:
    """Make `after` the next commit; its number is the one it was built on."""
    number = after.number + 1
    token = uuid.uuid4().hex
    record = (
        batch,
        after.dims,
        [(*p.key, p.version, p.rows) for p in after.parts],
        after.buckets,
        after.top_fact_id,
        after.streams,
        after.counts,
        token,
    )
    try:
        numbered.append(after.spark, _folder(after.root), number, record, _RECORD, token)
    except numbered.Taken as taken:
        raise ConcurrentLoad(f"commit {number} was published by another load") from taken
    return replace(after, number=number, batch=batch)


def reset(spark: SparkSession, root: str) -> Snapshot:
    """Publish a warehouse without rows; earlier versions stay on disk.

    Progress of streams goes, too: a batch that is sent again is loaded again.
    """
    base = current(spark, root)
    return publish(replace(Snapshot(spark, root), number=base.number, buckets=base.buckets), "reset")
