"""What the text operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obstar.session import scratch_root

#: The white space that separates words: space, and the characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
#: Rows per Arrow batch; texts may be long, so batches are small.
BATCH_ROWS = 256
#: Hashes of words and windows are sums of their elements times powers of this odd number.
BASE = np.uint64(0x9E3779B97F4A7C15)


#: Hot keys are split at run time, also where that costs a shuffle. What is broadcast
#: automatically is left to the session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the text operators rely on to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that all executors share."""
    return f"{scratch_root(spark)}/obstar/{label}-{uuid.uuid4().hex}"


def words(text: Column) -> Column:
    """The words of a text, in order; none for a null or blank text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, SPACE_CLASS + "+", -1)
    )


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, upper, lower)
    )


class Remembered(dict):
    """key -> make(key), for the keys used of late: at most twice `limit` of them.

    Keys move from the older half to the newer when they are used; when the newer half is
    full it becomes the older one, and what was there is forgotten.
    """

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 100:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Known:
    """key -> value, for the keys asked for of late: at most `limit` and those of one call,
    twice. What is not known is asked for in `make`, the keys of a call together."""

    def __init__(self, make: Callable[[list[str]], list[bytes]], limit: int):
        self.make, self.limit = make, limit
        self.values: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def of(self, wanted: set[str]) -> Callable[[str], bytes]:
        """The look-up of the values of some keys."""
        new = wanted.difference(self.values)
        if new and len(self.values) >= self.limit:
            self.older, self.values, new = self.values, {}, wanted
        if new and self.older:
            again = [k for k in new if k in self.older]
            self.values.update(zip(again, map(self.older.__getitem__, again)))
            new = new.difference(again)
        asked = list(new)
        self.values.update(zip(asked, self.make(asked) if asked else ()))
        return self.values.__getitem__

    def all(self, wanted: list[str]) -> list[bytes]:
        """The values of different keys; those that are known are looked up once."""
        found = list(map(self.values.get, wanted))
        new = [i for i, value in enumerate(found) if value is None]
        if new:
            get = self.of({wanted[i] for i in new})
            for i in new:
                found[i] = get(wanted[i])
        return found


_HELD: dict = {}


def only(key: tuple, make: Callable[[], Any]) -> Any:
    """What `make` gives, kept in the worker until another operator keeps something.

    Workers serve one stage after the other; a stage needs no dictionaries but its own.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """At least n powers of BASE, and of its inverse, modulo 2^64."""
    size = len(_POWERS[0])
    if size < n:
        # those of a text of a usual size are kept, of longer ones not
        grown = []
        for base in (int(BASE), pow(int(BASE), -1, 1 << 64)):
            one = np.full(max(n, 1 << 14), base, np.uint64)
            one[0] = 1
            with np.errstate(over="ignore"):
                grown.append(np.cumprod(one))
        if n > 1 << 20:
            return grown
        _POWERS[:] = grown
    return _POWERS


def let(value: Column, use) -> Column:
    """`use(value)` with the value worked out once per row."""
    return F.transform(F.array(value), use)[0]
