"""Times and decimal measures."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obstar.functions import measures, times
from obstar.operators import dims, ingest


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "text string")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024-12-01 07:30:05", datetime(2024, 12, 1, 7, 30, 5)),
        ("2024-12-1 7:3:5", datetime(2024, 12, 1, 7, 3, 5)),
        ("2024-13-01 00:00:00", None),
        ("2024-02-30 00:00:00", None),
        ("2024-12-01 07:30", None),
        ("2024-12-01T07:30:05", None),
        ("2024-12-01 07:30:05Z", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_parse(spark, text, want):
    assert texts(spark, text).select(times.parse_lenient(F.col("text"))).first()[0] == want


def test_lenient_parse_does_not_depend_on_the_zone(spark):
    df = texts(spark, "2024-03-10 02:30:00").select(times.parse_lenient(F.col("text")))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.first()[0] == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_strict_parse(spark):
    df = texts(spark, "2024-12-01 7:30").select(times.parse_strict(F.col("text")))
    assert df.first()[0] == datetime(2024, 12, 1, 7, 30)


@pytest.mark.parametrize("text", ["2024-13-01 00:00", "2024-12-01 07:30:05", "soon"])
def test_strict_parse_fails(spark, text):
    with pytest.raises(PySparkException):
        texts(spark, text).select(times.parse_strict(F.col("text"))).collect()


def test_coercion_counts(spark):
    df = texts(spark, "2024-12-01 07:30:05", "2024-13-01 00:00:00", None)
    parsed = ingest.coerce_time(df, "text", "ts")
    assert rows(ingest.coercion_counts(parsed, "text", "ts")) == [(3, 1, 1)]


def test_time_dimension_has_one_row_per_minute(spark):
    stamps = [
        datetime(2024, 2, 29, 13, 5, 7), datetime(2024, 2, 29, 13, 5, 40),
        datetime(2024, 2, 29, 13, 6), None,
    ]
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    assert rows(dims.dim_time(df, "ts")) == [
        (1, date(2024, 2, 29), 2024, 2, 29, 13, 5, "Thursday", "February"),
        (2, date(2024, 2, 29), 2024, 2, 29, 13, 6, "Thursday", "February"),
    ]


@pytest.mark.parametrize(
    ("value", "fits", "clamped"),
    [
        (12.345, True, "12.35"), (-12.345, True, "-12.35"), (999.99, True, "999.99"),
        (999.994, True, "999.99"), (999.995, False, "999.99"), (-1000.0, False, "-999.99"),
        (1e300, False, "999.99"), (-0.0, True, "0.00"),
    ],
)
def test_decimal_range(spark, value, fits, clamped):
    df = spark.createDataFrame([(value,)], "x double")
    row = df.select(
        measures.fits(F.col("x"), "decimal(5,2)"), measures.clamp(F.col("x"), "decimal(5,2)")
    ).first()
    assert tuple(row) == (fits, Decimal(clamped))


def test_fits_agrees_with_the_cast(spark):
    df = spark.range(0, 4000).select((F.col("id") / 1000 + 997).alias("x"))
    for sql_type in ("decimal(5,2)", "decimal(4,1)"):
        odd = df.where(measures.fits(F.col("x"), sql_type) != F.col("x").try_cast(sql_type).isNotNull())
        assert odd.count() == 0


def test_clamp_int(spark):
    df = spark.createDataFrame([(2**40,), (-(2**40),), (7,)], "x bigint")
    assert rows(df.select(measures.clamp_int(F.col("x")))) == sorted(
        [(2**31 - 1,), (-(2**31),), (7,)], key=repr
    )
