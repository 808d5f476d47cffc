"""Hour, day and month per meter; each level is built on the one below and keeps its rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loadweave.functions import day_floor, hour_floor, mean, month_floor, pct


def hourly(reads: DataFrame, expected: int = 4) -> DataFrame:
    n = F.count(F.lit(1))
    return (
        reads.withColumn("rollup_ts", hour_floor("read_ts"))
        .groupBy("meter_id", "rollup_ts", "utility_territory")
        .agg(
            F.lit("HOUR").alias("rollup_grain"),
            F.sum("kwh_delivered").alias("kwh_delivered"),
            F.sum("kwh_received").alias("kwh_received"),
            # A read with either side missing counts for neither.
            F.sum(F.col("kwh_delivered") - F.col("kwh_received")).alias("kwh_net"),
            F.max("demand_kw").alias("max_demand_kw"),
            F.min("voltage_v").alias("min_voltage"),
            F.max("voltage_v").alias("max_voltage"),
            mean("voltage_v", 6).alias("avg_voltage"),
            n.alias("source_interval_count"),
            F.lit(expected).alias("expected_interval_count"),
            pct(n, F.lit(expected)).alias("completeness_pct"),
            pct(F.count_if(F.col("vee_status") == "VALID"), n).alias("vee_pass_pct"),
        )
    )


def _energy():
    return [F.sum(c).alias(c) for c in ("kwh_delivered", "kwh_received", "kwh_net")] + [
        F.max("max_demand_kw").alias("max_demand_kw"),
        F.min("min_voltage").alias("min_voltage"),
        F.max("max_voltage").alias("max_voltage"),
    ]


def daily(hours: DataFrame, expected: int = 96) -> DataFrame:
    n = F.sum("source_interval_count")
    return (
        hours.withColumn("rollup_ts", day_floor("rollup_ts"))
        .groupBy("meter_id", "rollup_ts", "utility_territory")
        .agg(
            F.lit("DAY").alias("rollup_grain"),
            *_energy(),
            mean("avg_voltage", 6).alias("avg_voltage"),
            n.alias("source_interval_count"),
            F.lit(expected).alias("expected_interval_count"),
            pct(n, F.lit(expected)).alias("completeness_pct"),
            mean("vee_pass_pct", 2).alias("vee_pass_pct"),
        )
    )


def monthly(days: DataFrame) -> DataFrame:
    return (
        days.withColumn("rollup_ts", month_floor("rollup_ts"))
        .groupBy("meter_id", "rollup_ts", "utility_territory")
        .agg(
            F.lit("MONTH").alias("rollup_grain"),
            *_energy(),
            F.sum("source_interval_count").alias("source_interval_count"),
            mean("completeness_pct", 2).alias("completeness_pct"),
            mean("vee_pass_pct", 2).alias("vee_pass_pct"),
        )
    )
