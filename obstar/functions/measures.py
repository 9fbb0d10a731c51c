"""Storing floating-point measures as DECIMAL columns."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decimal_range(sql_type: str) -> tuple[Decimal, Decimal]:
    """The highest value of the type, and the first value that rounds beyond it."""
    precision, scale = map(int, re.fullmatch(r"decimal\((\d+),\s*(\d+)\)", sql_type).groups())
    step = Decimal(1).scaleb(-scale)
    top = Decimal(10) ** (precision - scale) - step
    return top, top + step / 2


def fits(col: Column, sql_type: str) -> Column:
    """True where the value, once rounded half up, is in the range of the type."""
    return F.abs(col) < float(decimal_range(sql_type)[1])


def clamp(col: Column, sql_type: str) -> Column:
    """Round half up to the type, moving values beyond its range to its ends."""
    top, _ = decimal_range(sql_type)
    return (
        F.when(col.isNull(), F.lit(None))
        .when(col >= F.lit(float(top)), F.lit(top))
        .when(col <= F.lit(-float(top)), F.lit(-top))
        .otherwise(col.try_cast(sql_type))
        .cast(sql_type)
    )


def clamp_int(col: Column) -> Column:
    """Move whole numbers beyond the INT range to its ends."""
    low, high = -(2**31), 2**31 - 1
    return F.least(F.greatest(col.cast("bigint"), F.lit(low)), F.lit(high)).cast("int")


def decimals_as_double(df: DataFrame) -> DataFrame:
    """The frame with its DECIMAL columns as DOUBLE, as the served record has them."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
