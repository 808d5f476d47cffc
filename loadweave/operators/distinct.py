"""Distinct counts that add up: bitmaps of dense numbers.

A bitmap holds which of 32,768 consecutive numbers occur, so a group has one row for each such bucket it touches. Bitmaps
of days, territories or any other keys are merged by OR, and their bits counted, without the rows they were made of.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def bitmaps(rows: DataFrame, keys: Sequence[str], number: Column | str) -> DataFrame:
    """``bucket`` and ``members`` of each group; numbers are positive whole numbers, as dense as can be."""
    number = F.col(number) if isinstance(number, str) else number
    numbered = rows.select(*keys, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))
    return numbered.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("members"))


def merged(maps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same by fewer keys."""
    return maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def counted(maps: DataFrame, keys: Sequence[str], name: str = "members") -> DataFrame:
    """The number of distinct members of each group."""
    sizes = merged(maps, keys).select(*keys, F.bitmap_count("members").alias("size"))
    return sizes.groupBy(*keys).agg(F.sum("size").alias(name))


def rolling(maps: DataFrame, date: str, keys: Sequence[str], days: int, name: str = "members") -> DataFrame:
    """Distinct members of the ``days`` days up to each date that occurs; keys are those beside the date."""
    each = maps.select(date).distinct()
    ahead = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    spread = maps.withColumn("_ahead", ahead).withColumn(date, F.date_add(date, F.col("_ahead"))).drop("_ahead")
    return counted(spread.join(each, date, "left_semi"), [date, *keys], name)
