"""Exact percentages and means.

Measures stay DECIMAL through every mart, so results do not depend on the order in which
partitions are added up; DOUBLE appears only in the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def as_decimal(value: Column | str, precision: int, scale: int) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.cast(T.DecimalType(precision, scale))


def pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part / whole * 100`` of two counts or sums, rounded half up; null when whole is 0."""
    hundredfold = as_decimal(part, 24, 4) * F.lit(100)
    return (hundredfold / F.nullif(as_decimal(whole, 24, 4), F.lit(0))).cast(T.DecimalType(12, scale))


def mean(value: Column | str, scale: int) -> Column:
    """Average of an exact column, rounded half up once."""
    value = F.col(value) if isinstance(value, str) else value
    return (F.sum(value) / F.nullif(F.count(value), F.lit(0))).cast(T.DecimalType(18, scale))


def ratio(top: Column, bottom: Column, digits: int = 6) -> Column:
    """Rounded DOUBLE quotient; null when bottom is 0."""
    top, bottom = top.cast("double"), bottom.cast("double")
    return F.round(top / F.nullif(bottom, F.lit(0.0)), digits)


def to_report_types(df: DataFrame) -> DataFrame:
    """Final projection of a report: DECIMAL to DOUBLE, small integers to BIGINT."""

    def column(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select([column(f) for f in df.schema.fields])
