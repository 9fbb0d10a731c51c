"""The registered queries of the text operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obstar.llm import (
    align,
    bpe,
    decontaminate,
    html,
    language,
    licenses,
    lines,
    quality,
    shards,
    simhash,
    tokenfile,
    trie,
    warc,
)
from obstar.llm.common import table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that other documents repeat."""
    found = lines.dedup_lines(table(spark, sf_dir, "documents"), ["doc_id"], min_chars=20, min_docs=3)
    return found.select(
        "row.doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses that documents state."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.notices(spark))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(bpe.encoded_documents(table(spark, sf_dir, "documents"), VOCABULARY))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, most=3)
    return found.select(
        "doc_id", simhash.hex_column(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures and the verdict of every document."""
    return quality.judged(table(spark, sf_dir, "documents"))


def op6_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from the files."""
    found = tokenfile.written(table(spark, sf_dir, "documents"), VOCABULARY, end_id=2)
    return tokenfile.checksums(found)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The not-modified answers among the captures of all pages, with what they stand for."""
    found = warc.resolve(warc.captures(table(spark, sf_dir, "pages")))
    return found.select(
        F.col("record_id").alias("revisit_id"),
        "url_key",
        "response_id",
        "resolution",
        warc.headers_text(F.col("headers")).alias("headers"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold an item of the benchmark, with the item."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.predictions(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every document."""
    return align.align(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return shards.sharded(table(spark, sf_dir, "documents"), shards=24)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of the rebuilt conversations."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lines": op1_lines,
    "op2_licenses": op2_licenses,
    "op3_bpe": op3_bpe,
    "op4_simhash": op4_simhash,
    "op5_quality": op5_quality,
    "op6_tokenfile": op6_tokenfile,
    "op7_warc": op7_warc,
    "op8_decontaminate": op8_decontaminate,
    "op9_language": op9_language,
    "op10_html": op10_html,
    "op11_align": op11_align,
    "op12_shards": op12_shards,
    "op13_trie": op13_trie,
}
