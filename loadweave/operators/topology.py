"""Meter to service point to transformer to feeder to substation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from loadweave.functions import hour_floor, pct, ratio


def meter_topology(
    meters: DataFrame, service_points: DataFrame, transformers: DataFrame, feeders: DataFrame,
    substations: DataFrame,
) -> DataFrame:
    """The whole chain per meter, joined once."""
    return (
        meters.select("meter_id", "service_point_id", "meter_type", "has_der")
        .join(service_points.select("service_point_id", "feeder_id", "transformer_id", "premise_type",
                                    "utility_territory", "lat", "lon"), "service_point_id")
        .join(transformers.select("transformer_id", "kva_rating", "phase"), "transformer_id")
        .join(feeders.select("feeder_id", "substation_id", "voltage_kv"), "feeder_id")
        .join(substations.select("substation_id", "substation_name"), "substation_id")
    )


def feeder_of(meters: DataFrame, service_points: DataFrame) -> DataFrame:
    return meters.select("meter_id", "service_point_id").join(
        service_points.select("service_point_id", "feeder_id", "transformer_id", "lat", "lon"),
        "service_point_id",
    )


def feeder_load(reads: DataFrame, placed: DataFrame) -> DataFrame:
    """kWh per feeder and hour.

    Reads are first summed per meter and hour, so the topology join and the second shuffle carry
    hours; a feeder with a third of all meters is only ever a sum of partial sums.
    """
    per_meter = reads.groupBy("meter_id", hour_floor("read_ts").alias("ts")).agg(
        F.sum("kwh_delivered").alias("kwh")
    )
    return (
        per_meter.join(placed.select("meter_id", "feeder_id"), "meter_id")
        .groupBy("feeder_id", "ts")
        .agg(F.sum("kwh").cast("decimal(18,4)").alias("kwh"))
    )


def transformer_load(days: DataFrame, placed: DataFrame, transformers: DataFrame) -> DataFrame:
    """Load of each transformer over the given daily rollups."""
    per_meter = days.groupBy("meter_id").agg(
        F.sum("kwh_delivered").alias("kwh"), F.max("max_demand_kw").alias("peak")
    )
    peak = F.max("peak")
    return (
        per_meter.join(placed.select("meter_id", "service_point_id", "transformer_id"), "meter_id")
        .join(transformers, "transformer_id")
        .groupBy("transformer_id", "feeder_id", "kva_rating")
        .agg(
            F.countDistinct("service_point_id").alias("meters"),
            F.sum("kwh").alias("kwh_30d"),
            peak.alias("peak_kw"),
        )
        .withColumn("load_factor_pct", pct(F.col("peak_kw"), F.col("kva_rating"), 1))
    )


def transformer_hours(hours: DataFrame, placed: DataFrame) -> DataFrame:
    """Transformer-hour kWh and its deviation from the transformer's mean for that hour of day."""
    load = (
        hours.join(placed.select("meter_id", "transformer_id", "feeder_id"), "meter_id")
        .groupBy("transformer_id", "feeder_id", F.col("rollup_ts").alias("ts"))
        .agg(F.sum("kwh_delivered").alias("kwh"))
        .withColumn("hour", F.hour("ts"))
    )
    # One row per day in each window.
    same_hour = Window.partitionBy("transformer_id", "hour")
    usual = (F.sum("kwh").over(same_hour) / F.count("kwh").over(same_hour)).cast("decimal(18,6)")
    return load.withColumn("usual_kwh", usual).select(
        "transformer_id", "feeder_id", "ts", "kwh", "usual_kwh",
        (F.col("kwh") - F.col("usual_kwh")).alias("deviation_kwh"),
        ratio(F.col("kwh") - F.col("usual_kwh"), F.col("usual_kwh")).alias("deviation_ratio"),
    )


def feeder_completeness(
    reads: DataFrame, placed: DataFrame, expected_per_day: int = 96, days: int = 7
) -> DataFrame:
    """Reads against the reads expected of each feeder's reporting meters, with its position.

    Counting per meter first makes the distinct count a plain count and the position a weighted sum.
    """
    per_meter = reads.groupBy("meter_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.sum("n")
    expected = F.lit(expected_per_day * days) * F.count(F.lit(1))

    def position(name: str):
        return (F.sum(F.col(name) * F.col("n")) / n).cast("decimal(9,6)").alias(name)

    return (
        per_meter.join(placed.select("meter_id", "feeder_id", "lat", "lon"), "meter_id")
        .groupBy("feeder_id")
        .agg(
            F.count(F.lit(1)).alias("meters"), n.alias("reads"), position("lat"), position("lon"),
            pct(n, expected).alias("completeness_pct"),
        )
    )


def substation_feeders(substations: DataFrame, feeders: DataFrame) -> DataFrame:
    counted = feeders.groupBy("substation_id").agg(F.count(F.lit(1)).alias("n"))
    return substations.join(counted, "substation_id", "left").select(
        "substation_id", "utility_territory", "lat", "lon",
        F.coalesce("n", F.lit(0)).alias("feeder_count"),
    )
