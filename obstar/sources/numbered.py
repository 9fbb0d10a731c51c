"""Small records that follow each other under one folder: n=1, n=2, …

A record is one row in a folder of its own, written once and never changed. The latest is
found by asking for single numbers: from the last one this session saw, or from the start,
in steps that double and then halve. So the cost grows with the logarithm of what is new,
and no folder is ever listed. Numbers have no gaps.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession

from obstar.session import listed, remove


class Taken(RuntimeError):
    """Another writer has the number."""


#: Where to begin to look, by folder: only ever a hint.
_SEEN: dict[str, int] = {}


def _path(folder: str, number: int) -> str:
    return f"{folder}/n={number}"


def _there(spark: SparkSession, path: str) -> bool | None:
    """Whether a record is there; None for a folder that a writer left without one."""
    names = listed(spark, path)
    if names is None:
        return False
    return any(n.endswith(".json") for n in names) or None


def latest(spark: SparkSession, folder: str) -> int:
    """The highest number that has a record, 0 before the first one."""

    def known(number: int) -> bool:
        return number == 0 or bool(_there(spark, _path(folder, number)))

    low = _SEEN.get(folder, 0)
    if not known(low):
        low = 0  # the folder is another one now
    step = 1
    while known(low + step):
        low, step = low + step, step * 2
    high = low + step  # has none
    while high - low > 1:
        middle = (low + high) // 2
        if known(middle):
            low = middle
        else:
            high = middle
    _SEEN[folder] = low
    return low


def read(spark: SparkSession, folder: str, number: int, schema: str) -> Row | None:
    """The record of a number. Two writers may have written one each where the file system
    does not refuse the second: None then, neither counts."""
    found = spark.read.schema(schema).json(_path(folder, number)).take(2)
    return found[0] if len(found) == 1 else None


def append(spark: SparkSession, folder: str, number: int, record: tuple, schema: str, token: str) -> None:
    """Write the record of the next number; `token`, a column of it, tells it from others'.

    Raises Taken if another record is there first.
    """
    path = _path(folder, number)
    if _there(spark, path) is None:
        remove(spark, path)  # its writer died before the record was there
    row = spark.createDataFrame([record], schema).coalesce(1)
    try:
        row.write.mode("errorifexists").json(path)
    except (AnalysisException, Py4JJavaError) as error:
        # however the file system says so: a record is there and it is not this one
        if not _there(spark, path):
            raise
        raise Taken(f"record {number} of {folder} was written by another") from error
    own = read(spark, folder, number, schema)
    if own is None or own["token"] != token:
        raise Taken(f"record {number} of {folder} was written by another")
    _SEEN[folder] = number
