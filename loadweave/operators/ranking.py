"""Complete ranks over any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loadweave.sources.tables import snapshot


def global_rank(rows: DataFrame, order: list[Column], path: str, name: str = "rank") -> DataFrame:
    """All rows with their place in a total order, without one window over all of them.

    Rows are written first, as finding the ranges of the order reads them, then dealt to the ranges and written to
    ``path`` (so that both uses below see the same ranges), numbered inside their range, and moved up by the number of rows
    in the ranges before it.
    """
    part, place = "range_no", "place_in_range"
    inside = Window.partitionBy(part).orderBy(*order)
    dealt = snapshot(rows, f"{path}-rows").repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    placed = snapshot(dealt, path).withColumn(place, F.row_number().over(inside))
    sizes = snapshot(dealt.sparkSession.read.parquet(path).groupBy(part).agg(F.count(F.lit(1)).alias("n")), f"{path}-sizes")
    before = F.coalesce(F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(part, before.alias("before"))
    return placed.join(offsets, part).withColumn(name, F.col("before") + F.col(place)).drop(part, place, "before")
