"""Line dedup over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z in lower case. Keys of at
least `min_chars` code points found in at least `min_docs` documents lose all their
lines except in the largest doc_id that holds them.

The store is a set of runs: tables bucketed and sorted by a 128-bit hash of the key, each
row with the number of documents and the largest doc_id seen. Documents come in batches
by doc_id, the largest first. A batch is reduced to one row per key (map-side first, so a
line in a third of all documents is one row per task), anti-joined by merge with every
run against keys that are settled there (in enough documents, with a keeper not smaller),
and what is left becomes a new run at level 0. `fan_in` runs of a level are compacted
into one of the next. Runs share their bucketing, so neither the merge joins nor the
compactions shuffle a run. The rule does not depend on the order or number of batches,
only the work does.

The lines' hashes are written once, by batch, so texts are read twice in all: for the
hashes, and for the result. The lines are then joined with the repeated keys (a join that
the planner splits at hot keys), and each text with the numbers of its dropped lines.

Defined results: a null or empty text is one empty line; a null doc_id counts as one
document, smaller than all others; rows that repeat a doc_id belong to one document, and
each is treated by its own text; texts of any length are cut into all their lines; an
empty table gives an empty result; columns that are not carried are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obstar.llm.common import SPACES, ascii_lower, prepare, scratch
from obstar.session import materialize

HASH = ["h1", "h2"]
_NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Levelled sorted runs of line hashes: (h1, h2, n documents, last doc_id)."""

    def __init__(self, spark: SparkSession, min_docs: int = 3, fan_in: int = 2):
        self.spark, self.min_docs, self.fan_in = spark, min_docs, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder = scratch(spark, "runs")
        self.levels: list[list[DataFrame]] = [[]]
        self.names: list[str] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _stored(self, rows: DataFrame) -> DataFrame:
        """One sorted file per bucket, read back with its bucketing known."""
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.write.bucketBy(self.buckets, *HASH)
            .sortBy(*HASH)
            .option("path", f"{self.folder}/{name}")
            .saveAsTable(name)
        )
        self.names.append(name)
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> None:
        """Take a batch of (h1, h2, doc); a document must be whole in one batch."""
        fresh = lines.groupBy(*HASH).agg(
            F.count_distinct("doc").alias("n"), F.max("doc").alias("last")
        )
        for run in self.runs():
            settled = run.where(F.col("n") >= self.min_docs).select(
                *HASH, F.col("last").alias("kept_by")
            )
            fresh = (
                fresh.alias("f")
                .join(
                    settled.hint("merge").alias("s"),
                    (F.col("f.h1") == F.col("s.h1"))
                    & (F.col("f.h2") == F.col("s.h2"))
                    & (F.col("kept_by") >= F.col("last")),
                    "left_anti",
                )
            )
        self.levels[0].append(self._stored(fresh))
        self._compact()

    def _compact(self) -> None:
        for at, level in enumerate(self.levels):
            if len(level) < self.fan_in:
                return
            if at + 1 == len(self.levels):
                self.levels.append([])
            self.levels[at + 1].append(self._stored(self._merged(level)))
            level.clear()

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        merged, *others = runs
        for run in others:
            other = run.select(*HASH, F.col("n").alias("n2"), F.col("last").alias("last2"))
            merged = merged.join(other.hint("merge"), HASH, "full").select(
                *HASH,
                (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"),
                F.greatest("last", "last2").alias("last"),
            )
        return merged

    def repeated(self) -> DataFrame:
        """(h1, h2, last) of the keys found in enough documents."""
        return self._merged(self.runs()).where(F.col("n") >= self.min_docs).select(*HASH, "last")

    def forget(self) -> None:
        """Take the runs' names out of the catalog; their files stay for frames that read them."""
        while self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.names.pop()}")


def hashed_lines(documents: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, row, pos) of the lines long enough to count."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    keys = F.transform(text_lines(F.col("text")), line_key)
    return (
        documents.select(
            doc.alias("doc"), F.xxhash64("text").alias("row"), F.posexplode_outer(keys).alias("pos", "key")
        )
        .where(F.length("key") >= min_chars)
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
            "doc",
            "row",
            "pos",
        )
    )


def dedup_lines(
    documents: DataFrame,
    carry: Sequence[str],
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fan_in: int = 2,
) -> DataFrame:
    """`row` (a struct of the carried columns), n_lines, n_dropped, kept: a row per row."""
    spark = prepare(documents.sparkSession)
    shares = [1 - i / batches for i in range(1, batches)]
    bounds = documents.agg(
        F.percentile_approx(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), shares).alias("b")
    ).first()["b"]
    batch = F.lit(0)
    for bound in bounds or []:
        batch = batch + F.when(F.col("doc") <= bound, 1).otherwise(0)

    path = scratch(spark, "lines")
    found = hashed_lines(documents, min_chars).withColumn("batch", batch)
    found.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(found.schema).parquet(path)

    store = LineRuns(spark, min_docs, fan_in)
    for i in range(batches):
        store.add(lines.where(F.col("batch") == i).select(*HASH, "doc"))
    # read back without its bucketing: a join that shuffles both sides can split a hot line
    repeated = materialize(store.repeated(), "repeated", spark)
    store.forget()
    dropped = (
        lines.join(repeated, HASH)
        .where("doc <> last")
        .groupBy("doc", "row")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )
    return without_lines(documents, dropped, carry)


def without_lines(documents: DataFrame, dropped: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Texts without the lines of the given numbers."""
    held = documents.select(
        F.struct(*carry).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_doc"),
        F.xxhash64("text").alias("_text_hash"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    same = (F.col("_doc") == F.col("doc")) & (F.col("_text_hash") == F.col("_row"))
    drops = dropped.select("doc", F.col("row").alias("_row"), "dropped")
    cut = held.join(drops.hint("shuffle_hash"), same, "left").select(
        "row", "_text", "dropped", text_lines(F.col("_text")).alias("_lines")
    )
    first = F.concat(F.array(F.lit(0)), F.transform("dropped", lambda p: p + 1))
    last = F.concat(F.col("dropped"), F.array(F.size("_lines")))
    between = F.zip_with(first, last, lambda a, b: F.slice("_lines", a + 1, b - a))
    return cut.select(
        "row",
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias(
            "n_dropped"
        ),
        F.when(F.col("dropped").isNull(), F.col("_text"))
        .otherwise(F.array_join(F.flatten(between), "\n"))
        .alias("kept"),
    )
