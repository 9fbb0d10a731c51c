"""Quality rules as a short-circuit cascade.

The base figures of a text are worked out for every document. The rules are conditions on
them or on the text itself. Each rule's cost and selectivity are estimated on a sample:
cost is the time a scan of the sample with only that rule takes beyond a scan with none,
selectivity the share of documents it rejects. Rules run by rejections per cost, the best
first, as branches of one CASE: a document that a rule has rejected is not looked at by
those after it, nor is one that failed the base figures looked at by any. The order
changes the work, never the verdict, as a document is kept only if no rule rejects it.

All of it is built-in functions on one row at a time: one scan, no shuffle. A repeated
3-word window is found by sorting the hashes of a text's windows, so a long text costs
n log n. The sample is taken by a hash of doc_id; its size is bounded by `sample_rows`.

Defined results: a null or blank text has no words and fails the base; texts count whole;
repeated rows get the same verdict; a null doc_id is a document like any other, never
sampled; empty tables give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obstar.llm.common import SPACES, let, prepare, words
from obstar.session import materialize

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT = 50, 50


def repeated_words(all_words: Column) -> Column:
    """Words within 3-word windows that the text has twice or more, the first included."""

    def covered(places: Column) -> Column:
        # windows in order of place: each adds its words beyond those of the one before
        new = F.zip_with(
            places,
            F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))),
            lambda a, b: F.when(b.isNull(), 3).otherwise(F.least(b - a, F.lit(3))),
        )
        return F.aggregate(new, F.lit(0), lambda total, n: total + n)

    def places(ordered: Column) -> Column:
        same = F.transform(
            ordered,
            lambda w, i: F.when(
                (F.get(ordered, i - 1)["h"] == w["h"]) | (F.get(ordered, i + 1)["h"] == w["h"]), w["at"]
            ),
        )
        return F.sort_array(F.array_compact(same))

    def windows(held: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(held) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(held, i), F.get(held, i + 1), F.get(held, i + 2)).alias("h"),
                i.alias("at"),
            ),
        )

    def counted(found: Column) -> Column:
        hashes = F.transform(found, lambda w: w["h"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(found), 0).otherwise(
            let(F.sort_array(found), lambda ordered: let(places(ordered), covered))
        )

    # the array is bound by a lambda: filters that the optimizer moves work it out once, too
    return let(
        all_words,
        lambda held: F.when(F.size(held) < 3, 0).otherwise(let(windows(held), counted)),
    ).cast("long")


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def base_figures(documents: DataFrame) -> DataFrame:
    """doc_id, text and the base figures, base_failed among them."""
    held = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), words(F.col("text")).alias("words"))
    figures = held.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")
    )
    return figures.withColumn("base_failed", failed)


def rules() -> dict[str, Column]:
    """What rejects a text, by name; each is false for a text it has nothing against."""
    n, text = F.col("n_words"), F.col("text")
    n_lines = F.regexp_count(text, F.lit("\n")) + 1
    return {
        # more than one symbol to ten words
        "symbols": 10 * F.col("n_symbols") > n,
        # words of 2 to 15 letters on average
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        # half of the lines are there already
        "repeated_lines": 2 * F.col("n_dup_lines") > n_lines,
        # more capitals than small letters
        "capitals": F.regexp_count(text, F.lit("\\p{Lu}")) > F.regexp_count(text, F.lit("\\p{Ll}")),
        # an exclamation to five words
        "exclamations": 5 * F.regexp_count(text, F.lit("!")) > n,
        # four fifths of the words have a letter
        "letters": 5 * F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]*\\p{L}[^\\x20\\x09-\\x0D]*"))
        < 4 * n,
    }


def measured_order(sample: DataFrame, checks: Mapping[str, Column]) -> list[str]:
    """The rules by rejections per second on a stored sample, the best first."""

    def seconds(condition: Column) -> tuple[float, int]:
        started = time.perf_counter()
        rejected = sample.agg(F.count_if(condition).alias("n")).first()["n"]
        return time.perf_counter() - started, rejected

    seconds(F.lit(False))
    bare = seconds(F.lit(False))[0]
    gain = {}
    for name, check in checks.items():
        took, rejected = seconds(check)
        gain[name] = rejected / max(took - bare, 1e-3)
    return sorted(checks, key=lambda name: (-gain[name], name))


def cascade(checks: Mapping[str, Column], order: list[str]) -> Column:
    """The first rule that rejects, null for none; later rules are not worked out."""
    first, *others = order
    verdict = F.when(checks[first], first)
    for name in others:
        verdict = verdict.when(checks[name], name)
    return verdict


def judged(documents: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """doc_id, the base figures, base_failed, kept, and the rule that rejects."""
    spark = prepare(documents.sparkSession)
    checks, figures = rules(), base_figures(documents)
    count = documents.count()
    share = F.lit(min(1.0, sample_rows / max(count, 1)) * (1 << 20))
    drawn = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share)
    sample = materialize(base_figures(drawn), "quality", spark).where("NOT base_failed")
    rejected = F.when(~F.col("base_failed"), cascade(checks, measured_order(sample, checks)))
    return figures.withColumn("rejected_by", rejected).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"),
        "rejected_by",
    )
