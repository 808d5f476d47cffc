"""Value at risk of open service issues and the queue they form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loadweave.functions import ratio
from loadweave.operators.calendar import dated
from loadweave.operators.ranking import global_rank
from loadweave.sources.reference import FLAT_RATE_PER_KWH, HOLIDAYS

# Expected hours to resolution and penalty per hour by issue type.
RESOLUTION = {
    "OUTAGE": (4, 5.0), "TAMPER": (48, 1.0), "COMMS_LOSS": (24, 0.5), "ANOMALY": (24, 0.0),
    "SUSTAINED_ESTIMATION": (72, 0.25),
}
# Weight of a customer class in the priority score.
CLASS_WEIGHT = {"COMMERCIAL": 1.0, "SMALL_BUSINESS": 0.85, "RESIDENTIAL": 0.7}
PROTECTED_FLOOR = 0.5


def _lookup(key: Column, table: dict[str, float], default: float) -> Column:
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def peak_exposure(load: DataFrame, cycle_days: int, first: str, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """How often an hour of day and weekday holds the feeder's highest load of its cycle.

    The peak is the first hour of the cycle's highest load; a window holds the hours of one cycle.
    """
    cycle = F.floor(F.datediff(F.to_date("ts"), F.lit(first).cast("date")) / cycle_days).cast("int")
    hours = dated(load, F.col("ts"), holidays).withColumn("cycle", cycle)
    by_load = Window.partitionBy("feeder_id", "cycle").orderBy(F.desc("kwh"), "ts")
    return hours.withColumn("place", F.row_number().over(by_load)).groupBy(
        "feeder_id", "hour_local", "day_of_week", "season"
    ).agg(
        F.count(F.lit(1)).alias("hours"),
        F.count_if(F.col("place") == 1).alias("peaks"),
    ).withColumn("exposure", ratio(F.col("peaks"), F.col("hours")))


def value_at_risk(
    issues: DataFrame, usage: DataFrame, plans: DataFrame, windows: DataFrame, exposure: DataFrame, placed: DataFrame,
    export_rates: DataFrame, hours_in_period: int,
) -> DataFrame:
    """Dollars an open issue risks per hour and until its expected resolution; export credit that is not paid
    meanwhile is taken off.

    ``usage`` gives each meter's usual kWh, export and kW by hour of day, ``plans`` its rate plan, ``windows`` the
    plans' rates by day type, season and minute, ``exposure`` the feeder's peak odds.
    """
    w = windows.select(
        F.col("rate_plan_id").alias("plan"), F.col("day_type").alias("window_day"), F.col("season").alias("window_season"),
        "start_minute", "end_minute", F.col("energy_rate_per_kwh").alias("energy_rate"),
        F.col("demand_rate_per_kw").alias("demand_rate"),
    )
    minute = F.hour("detected_at") * 60 + F.minute("detected_at")
    in_window = (
        (F.col("plan") == F.col("rate_plan_id")) & (F.col("window_day") == F.col("day_type"))
        & ((F.col("window_season") == "ALL") | (F.col("window_season") == F.col("season")))
        & minute.between(F.col("start_minute"), F.col("end_minute"))
    )
    i = issues.withColumn("hour", F.hour("detected_at")).withColumn("dow", F.dayofweek("detected_at") - 1)
    joined = (
        i.join(placed.select("meter_id", "feeder_id"), "meter_id")
        .join(usage, ["meter_id", "hour"], "left")
        .join(plans, "meter_id", "left")
        .join(w, in_window, "left")
        .join(exposure.select("feeder_id", F.col("hour_local").alias("hour"), F.col("day_of_week").alias("dow"),
                              "season", "exposure"), ["feeder_id", "hour", "dow", "season"], "left")
        .join(export_rates, "meter_id", "left")
    )
    zero = F.lit(0.0)
    dbl = lambda c: F.coalesce(F.col(c).cast("double"), zero)
    hours = _lookup(F.col("issue_type"), {k: float(v[0]) for k, v in RESOLUTION.items()}, 24.0)
    penalty = _lookup(F.col("issue_type"), {k: v[1] for k, v in RESOLUTION.items()}, 0.0)
    hourly = (
        dbl("usual_kwh") * dbl("energy_rate")
        - dbl("usual_export") * dbl("export_rate")
        + dbl("usual_kw") * dbl("demand_rate") * dbl("exposure") / F.lit(float(hours_in_period))
        + penalty
    )
    return joined.select(
        "issue_id", "issue_type", "issue_source", "feeder_id", "meter_id", "customer_id", "customer_class", "is_protected", "has_der",
        "schedule_id", F.lit("OPEN").alias("status"), "detected_at",
        F.round(hourly, 4).alias("var_hourly"),
        F.round(F.round(hourly, 4) * hours, 4).alias("var_cumulative"),
    )


def feeder_risk(events: DataFrame) -> DataFrame:
    """Issues of anomalous feeder hours, with the feeder's forecast at the flat rate as the dollars at risk.

    Same columns as ``value_at_risk``; what a single customer would determine is null.
    """
    text = F.lit(None).cast("string")
    # Exact until rounded: a double product would fall on either side of a half.
    hourly = (F.col("forecast").cast("decimal(18,6)") * F.lit(FLAT_RATE_PER_KWH)).cast("decimal(18,4)")
    whole = (hourly * RESOLUTION["ANOMALY"][0]).cast("decimal(18,4)")
    return events.filter("is_anomaly").select(
        F.concat_ws("-", F.lit("FA"), "feeder_id", F.date_format("ts", "yyyyMMddHH")).alias("issue_id"),
        F.lit("ANOMALY").alias("issue_type"), F.lit("FEEDER_ANOMALY").alias("issue_source"), "feeder_id",
        text.alias("meter_id"), text.alias("customer_id"), text.alias("customer_class"),
        F.lit(False).alias("is_protected"), F.lit(None).cast("boolean").alias("has_der"), text.alias("schedule_id"),
        F.lit("OPEN").alias("status"), F.col("ts").alias("detected_at"),
        hourly.cast("double").alias("var_hourly"), whole.cast("double").alias("var_cumulative"),
    )


def score_issues(at_risk: DataFrame, now: Column) -> DataFrame:
    """Priority: dollars (a net gain counts as none) on a log scale, up to half as much again within four hours, weighted by class."""
    age = F.timestamp_diff("HOUR", "detected_at", now)
    duration = F.lit(1.0) + F.lit(0.5) * F.least(F.lit(1.0), age / F.lit(4.0))
    weight = _lookup(F.col("customer_class"), CLASS_WEIGHT, 0.7)
    floor = F.when(F.col("is_protected"), F.lit(PROTECTED_FLOOR)).otherwise(F.lit(0.0))
    score = F.log10(F.lit(1.0) + F.greatest(F.col("var_cumulative"), F.lit(0.0))) * duration * weight + floor
    return at_risk.withColumn("duration_hours", age).withColumn("priority_score", F.round(score, 4))


def ranked(issues: DataFrame, by: str, path: str, name: str = "rank") -> DataFrame:
    """All issues with their rank by a column, ties by id; ``path`` is a new folder for the sorted rows."""
    return global_rank(issues, [F.desc(by), F.col("issue_id")], path, name)
