"""Slot calendar, billing cycles and the expected load per slot."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadweave.functions import minute_of_day
from loadweave.sources.reference import HOLIDAYS, SUMMER_MONTHS, WINTER_MONTHS


def season_of(month: Column) -> Column:
    return (
        F.when(month.isin(SUMMER_MONTHS), "SUMMER").when(month.isin(WINTER_MONTHS), "WINTER")
        .otherwise("SHOULDER")
    )


def _is_holiday(date: Column, holidays: Sequence[str]) -> Column:
    return date.isin([F.lit(h).cast("date") for h in holidays]) if holidays else F.lit(False)


def dated(rows: DataFrame, at: Column, holidays: Sequence[str] = HOLIDAYS, timezone: str = "UTC") -> DataFrame:
    """Rows with the calendar columns of a time, each worked out from the time itself.

    Adds day_type, season, local_minute, hour_local and day_of_week. Facts never meet a calendar table for them,
    so nothing is shuffled by time.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(timezone), at) if timezone != "UTC" else at
    date, weekday = F.to_date(local), F.dayofweek(local) - 1
    return rows.withColumns({
        "day_type": F.when(_is_holiday(date, holidays), "HOLIDAY").when(weekday.isin(0, 6), "WEEKEND").otherwise("WEEKDAY"),
        "season": season_of(F.month(local)),
        "local_minute": F.hour(local) * 60 + F.minute(local),
        "hour_local": F.hour(local),
        "day_of_week": weekday,
    })


def slot_calendar(
    spark: SparkSession,
    first: dt.date,
    last: dt.date,
    holidays: Sequence[str] = HOLIDAYS,
    timezone: str = "UTC",
    minutes: int = 15,
) -> DataFrame:
    """One row per slot of the days ``first`` to ``last``, with one local time for everybody.

    Built on a range, so the planner knows how many rows it has (35,136 for a leap year).
    """
    slots = ((last - first).days + 1) * 24 * 60 // minutes
    start = F.lit(f"{first.isoformat()} 00:00:00").cast("timestamp_ntz")
    ts = start + F.make_dt_interval(mins=(F.col("id") * minutes).cast("int"))
    local = F.convert_timezone(F.lit("UTC"), F.lit(timezone), F.col("ts_utc"))
    stamped = spark.range(slots).select(ts.alias("ts_utc")).withColumn("local_ts", local)
    days = stamped.withColumn("local_date", F.to_date("local_ts"))
    marked = days.withColumn("named", _is_holiday(F.col("local_date"), holidays))
    weekday = F.dayofweek("local_date") - 1
    return marked.select(
        "ts_utc", "local_date",
        minute_of_day("local_ts").alias("local_minute"),
        F.hour("local_ts").alias("hour_local"),
        weekday.alias("day_of_week"),
        F.when(F.col("named"), "HOLIDAY").when(weekday.isin(0, 6), "WEEKEND").otherwise("WEEKDAY")
        .alias("day_type"),
        F.month("local_date").alias("month"),
        season_of(F.month("local_date")).alias("season"),
        F.col("named").alias("is_holiday"),
    )


def billing_cycles(
    accounts: DataFrame, first: dt.date, last: dt.date, every: str = "10 days"
) -> DataFrame:
    """Accounts by cycle; a cycle ends the day before the next one starts."""
    starts = F.expr(
        f"sequence(date'{first.isoformat()}', date'{last.isoformat()}', interval {every})"
    )
    cycle = F.col("cycle")
    return accounts.select("*", F.posexplode(starts).alias("cycle", "start_date")).select(
        F.concat(F.lit("BP-"), F.col("cis_account_id"), F.lit("-"), F.date_format("start_date", "yyyyMMdd"))
        .alias("billing_period_id"),
        "cis_account_id", "service_point_id",
        F.concat(F.lit("CYCLE-"), (cycle + 1).cast("string")).alias("bill_cycle"),
        "start_date",
        F.date_sub((F.col("start_date") + F.expr(f"interval {every}")).cast("date"), 1).alias("end_date"),
        *[c for c in accounts.columns if c not in ("cis_account_id", "service_point_id")],
    )


def overlapping_periods(periods: DataFrame) -> DataFrame:
    """Pairs of neighbouring periods of one service point that share a day (billed twice)."""
    from pyspark.sql import Window

    w = Window.partitionBy("service_point_id").orderBy("start_date", "billing_period_id")
    return (
        periods.withColumn("latest_end", F.max("end_date").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        .filter(F.col("start_date") <= F.col("latest_end"))
        .select("billing_period_id", "service_point_id", "start_date", "end_date", "latest_end")
    )


# kWh per slot by meter type, and the factors of the load shape.
BASE_KWH = {"RES": "0.5", "SMB": "3.0", "CNI": "20.0"}
PEAK_FACTOR, MORNING_FACTOR, NIGHT_FACTOR = "1.6", "1.2", "0.5"
SEASON_FACTORS = {"SUMMER": "1.3", "WINTER": "1.1"}
WEEKEND_CNI, WEEKEND_OTHER = "0.6", "0.9"


def _d(text: str, kind: str = "decimal(3,1)") -> Column:
    return F.lit(text).cast(kind)


def meter_level(meter_id: Column) -> Column:
    """A meter's own level between 0.70 and 1.29, from its hashed id."""
    digest = F.conv(F.substring(F.sha2(meter_id, 256), 1, 8), 16, 10).cast("bigint")
    return (_d("0.7", "decimal(3,2)") + (digest % 60).cast("decimal(2,0)") / 100).cast("decimal(3,2)")


def load_scale(meters: DataFrame) -> DataFrame:
    """What the meter alone contributes: base kWh of its type, and base times its own level."""
    kind = F.col("meter_type")
    base = (
        F.when(kind == "RES", _d(BASE_KWH["RES"])).when(kind == "SMB", _d(BASE_KWH["SMB"]))
        .otherwise(_d(BASE_KWH["CNI"]))
    )
    return meters.withColumn("base_kwh", base).withColumn(
        "level_kwh", (F.col("base_kwh") * meter_level(F.col("meter_id"))).cast("decimal(7,3)")
    )


def load_factors(slots: DataFrame, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """Rows with what their slot alone contributes; weekends differ for commercial meters."""
    hour, weekend = F.col("hour_local"), F.col("day_type") == "WEEKEND"
    season = (
        F.when(F.col("season") == "SUMMER", _d(SEASON_FACTORS["SUMMER"]))
        .when(F.col("season") == "WINTER", _d(SEASON_FACTORS["WINTER"])).otherwise(_d("1.0"))
    )
    of_hour = (
        F.when(hour.between(17, 20), _d(PEAK_FACTOR)).when(hour.between(7, 9), _d(MORNING_FACTOR))
        .when(hour.between(0, 5), _d(NIGHT_FACTOR)).otherwise(_d("1.0"))
    )

    def factor(weekend_factor: str) -> Column:
        return (F.when(weekend, _d(weekend_factor)).otherwise(_d("1.0")) * season * of_hour).cast("decimal(6,3)")

    sun = _d("4.0") - F.abs(hour.cast("decimal(3,1)") - _d("12.5"))
    return dated(slots, F.col("read_ts"), holidays).withColumns({
        "season_factor": season, "factor_cni": factor(WEEKEND_CNI), "factor_other": factor(WEEKEND_OTHER),
        "sun_factor": F.when(hour.between(9, 16), _d("0.2") * sun).otherwise(_d("0.0")),
    }).drop("day_type", "season", "local_minute", "hour_local", "day_of_week")


def expected_load(slots: DataFrame, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """Expected kWh, export and kW of rows with ``load_scale`` columns and a slot; no noise."""
    return scaled_load(load_factors(slots, holidays))


def scaled_load(rows: DataFrame) -> DataFrame:
    """Rows with ``load_scale`` and ``load_factors`` columns, with the expected values instead of the factors."""
    factor = F.when(F.col("meter_type") == "CNI", F.col("factor_cni")).otherwise(F.col("factor_other"))
    export = F.when(F.col("has_der"), F.col("base_kwh") * F.col("sun_factor")).otherwise(_d("0.0"))
    return (
        rows.withColumn("expected_kwh", (F.col("level_kwh") * factor).cast("decimal(14,4)"))
        .withColumn("expected_kwh_received", export.cast("decimal(14,4)"))
        .withColumn("expected_kw", (F.col("level_kwh") * F.col("season_factor") * _d("4.5")).cast("decimal(10,4)"))
        .drop("season_factor", "factor_cni", "factor_other", "sun_factor")
    )
