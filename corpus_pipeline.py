"""From documents to token ids: the stages that a training corpus goes through.

Each stage works on all that the one before it kept, and is written and read again as
Parquet in the shared folder before the next. All stages but the last return the columns
of documents.

A document is known by its doc_id: rows that repeat one stay or go together, and a null
doc_id is a value like any other. Texts of any length go through whole. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obstar.llm import bpe, decontaminate, language, lines, simhash
from obstar.llm.common import prepare, table
from obstar.llm.queries import VOCABULARY
from obstar.session import materialize


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or letters go, each row by its own text; equal rows alike."""
    return language.known_language(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more that three documents share stay in the last one only.

    The text loses the lines, n_chars is that of the text that is left; a document that
    loses all its lines stays, with an empty text. A null text becomes an empty one; rows that
    repeat a doc_id are one document in the count, and each keeps its own lines.
    """
    found = lines.dedup_lines(docs, docs.columns)
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the document with the smallest doc_id stays.

    All rows of that doc_id stay, also where their texts differ; rows without a doc_id stay
    if no document of their group has one. Of equal texts there are no ties, as doc_ids
    are compared.
    """
    stay = simhash.representatives(docs).select(F.col("doc_id").alias("_stay")).distinct()
    return docs.join(stay, docs["doc_id"].eqNullSafe(F.col("_stay")), "left_semi")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go, with all rows of their doc_id, null
    included; empty texts hold none."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of their decoded text; a row for
    each row, empty texts have no tokens."""
    return bpe.digests(bpe.encoded_documents(docs, VOCABULARY))


STAGES = [
    ("language_id", known_languages),
    ("line_dedup", without_repeated_lines),
    ("simhash", one_of_each_group),
    ("decontamination", without_benchmark),
    ("bpe", token_ids),
]

#: Language models, fingerprints and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name, spark)
    return STAGES[-1][1](spark, docs, sf_dir)
