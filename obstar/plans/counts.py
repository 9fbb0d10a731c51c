"""Counts of one load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.operators.facts import FOREIGN_KEYS
from obstar.schemas import FACT_KEY


def load_counts(keyed: DataFrame) -> DataFrame:
    """Observations read, dropped for lack of a key, prepared, and facts they give.

    Two levels: pre-aggregated by fact key, so that a key with many copies is
    reduced before the shuffle.
    """
    complete = F.lit(True)
    for key in FOREIGN_KEYS:
        complete = complete & F.col(key).isNotNull()
    by_key = keyed.groupBy(*FACT_KEY).agg(
        F.count("*").alias("rows"), F.count_if(complete).alias("complete")
    )
    return by_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("read"),
        F.coalesce(F.sum(F.col("rows") - F.col("complete")), F.lit(0)).alias("dropped"),
        F.coalesce(F.sum("complete"), F.lit(0)).alias("prepared"),
        F.count_if(F.col("complete") > 0).alias("facts"),
    )
