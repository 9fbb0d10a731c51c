"""From JSON text to checked records, and from records to three relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obstar.functions import contract as C
from obstar.functions import times
from obstar.functions.contract import ERRORS
from obstar.schemas import OBSERVATION, Field

_DOCUMENT, _PLAIN = "_document", "_plain"


def parse_records(
    df: DataFrame,
    text: str,
    contract: Sequence[Field] = OBSERVATION,
    on_overflow: str = "reject",
    keep_rejected: bool = False,
) -> DataFrame:
    """Replace the JSON text by the contract's fields and an `errors` array.

    Other columns of `df` are carried along. `on_overflow` says what happens to
    values their staging column cannot hold: "reject" the record, or "clamp" the
    value when it is staged. `keep_rejected` keeps the text of rejected records
    (of the others it is NULL).

    Text is parsed and judged inside generators of one row: a plain projection
    would be copied into every use of its columns, and a filter on the errors
    would parse each record a hundred times.
    """
    if on_overflow == "clamp":
        contract = C.widened(contract)
    carried = [c for c in df.columns if keep_rejected or c != text]
    read = F.struct(C.read_document(text).alias(_DOCUMENT), C.read_plain(text, contract).alias(_PLAIN))
    opened = df.select(*carried, F.inline(F.array(read)))
    parsed = opened.select(*carried, F.inline(F.array(C.judged(_DOCUMENT, _PLAIN, contract, on_overflow))))
    if keep_rejected:
        parsed = parsed.withColumn(text, F.when(F.size(ERRORS) > 0, F.col(text)))
    return parsed


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.size(ERRORS) == 0).drop(ERRORS)


def rejects(parsed: DataFrame, carried: Sequence[str]) -> DataFrame:
    """One row per unacceptable field of a rejected record."""
    return parsed.select(*carried, F.explode(ERRORS).alias("_e")).select(*carried, "_e.field", "_e.reason")


def flatten(
    records: DataFrame,
    carried: Sequence[str] = (),
    contract: Sequence[Field] = OBSERVATION,
    on_overflow: str = "reject",
) -> DataFrame:
    """Valid records under staging names and types; the time stays text."""
    return records.select(*carried, *[C.staged(f, on_overflow) for f in contract])


def locations_of(flat: DataFrame) -> DataFrame:
    return flat.select("nom", "region", "pays").distinct()


def conditions_of(flat: DataFrame) -> DataFrame:
    return flat.select("code_condition", "texte_condition").distinct()


def coerce_time(df: DataFrame, text: str, column: str) -> DataFrame:
    """Add the parsed time; text that cannot be parsed gives NULL."""
    return df.withColumn(column, times.parse_lenient(F.col(text)))


def coercion_counts(df: DataFrame, text: str, column: str) -> DataFrame:
    """Rows in total, rows whose text could not be parsed, rows kept."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(text).isNotNull() & F.col(column).isNull()).alias("coerced"),
        F.count_if(F.col(column).isNotNull()).alias("kept"),
    )
