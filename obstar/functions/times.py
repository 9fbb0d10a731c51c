"""Parsing observation times and taking them apart into calendar columns.

Times are naive (as the place itself reports them) and stay TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: input formats; one-digit month, day, hour and minute are accepted
MINUTE_FORMAT = "yyyy-M-d H:m"
_SECOND_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"

# A part of a time may be written with one digit; the cast wants two.
_ONE_DIGIT = r"(?<!\d)(\d)(?!\d)"


def parse_strict(text: Column) -> Column:
    """Minute-resolution text to time; a bad value fails the job."""
    return F.to_timestamp_ntz(text, F.lit(MINUTE_FORMAT))


def is_minute(text: Column) -> Column:
    """Whether the strict parser reads the text."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(MINUTE_FORMAT)).isNotNull(), F.lit(False))


def _lenient(text: Column, shape: str) -> Column:
    padded = F.regexp_replace(text, _ONE_DIGIT, "0$1")
    return F.when(text.rlike(shape), padded.try_cast("timestamp_ntz"))


def parse_lenient(text: Column) -> Column:
    """Second-resolution text to time; a bad value becomes NULL."""
    return _lenient(text, _SECOND_SHAPE)


def calendar(ts: Column) -> dict[str, Column]:
    """The eight descriptive columns of the time dimension."""
    day = ts.cast("date")
    return {
        "date": day,
        "annee": F.year(day),
        "mois": F.month(day),
        "jour": F.dayofmonth(day),
        "heure": F.hour(ts),
        "minute": F.minute(ts),
        "jour_semaine": F.date_format(day, "EEEE"),
        "nom_mois": F.date_format(day, "MMMM"),
    }


def time_key(ts: Column) -> dict[str, Column]:
    """The columns that identify a row of the time dimension."""
    return {"date": ts.cast("date"), "heure": F.hour(ts), "minute": F.minute(ts)}
