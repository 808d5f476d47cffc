"""Time-of-use tagging and pricing of reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from loadweave.functions import ratio
from loadweave.operators.calendar import dated
from loadweave.sources.reference import HOLIDAYS


def overlapping_windows(windows: DataFrame) -> DataFrame:
    """Pairs of windows that would tag one slot twice, because both ends are inclusive.

    Joined on plan and day type, so pairs form only within one plan's few windows.
    """
    a, b = windows.alias("a"), windows.alias("b")
    seasons_meet = (
        (F.col("a.season") == F.col("b.season")) | (F.col("a.season") == "ALL") | (F.col("b.season") == "ALL")
    )
    return a.join(
        b,
        (F.col("a.rate_plan_id") == F.col("b.rate_plan_id"))
        & (F.col("a.day_type") == F.col("b.day_type"))
        & (F.col("a.rate_window_id") < F.col("b.rate_window_id"))
        & seasons_meet
        & (F.col("a.start_minute") <= F.col("b.end_minute"))
        & (F.col("b.start_minute") <= F.col("a.end_minute")),
    ).select(
        F.col("a.rate_window_id").alias("first_window_id"),
        F.col("b.rate_window_id").alias("second_window_id"),
    )


def current_plans(links: DataFrame, customers: DataFrame) -> DataFrame:
    """The rate plan of each meter's current customer."""
    return links.filter("is_current").select("meter_id", "customer_id").join(
        customers.select("customer_id", "rate_plan_id"), "customer_id"
    ).select("meter_id", "rate_plan_id")


def tag(
    reads: DataFrame,
    plans: DataFrame,
    windows: DataFrame,
    holidays: Sequence[str] = HOLIDAYS,
    tz_mode: str = "calendar",
    timezone: str = "UTC",
) -> DataFrame:
    """Reads with the rate window they fall into; reads without plan (see ``current_plans``) or window drop out.

    ``tz_mode='calendar'`` uses one local time (of ``timezone``) for every meter, ``'meter'`` the meter's own
    wall-clock time. The day type, season and minute are worked out from that time.
    """
    if tz_mode not in ("calendar", "meter"):
        raise ValueError(f"unknown tz_mode {tz_mode!r}")
    known = reads.filter(F.col("vee_status").isin("VALID", "ESTIMATED")).join(plans.select("meter_id", "rate_plan_id"), "meter_id")
    if tz_mode == "calendar":
        slots = dated(known, F.col("read_ts"), holidays, timezone)
    else:
        slots = dated(known, F.col("read_local_ts"), holidays)
    w = windows.withColumnRenamed("season", "window_season").withColumnRenamed("rate_plan_id", "window_plan") \
        .withColumnRenamed("day_type", "window_day")
    return slots.join(
        w,
        (F.col("window_plan") == F.col("rate_plan_id"))
        & (F.col("window_day") == F.col("day_type"))
        & ((F.col("window_season") == "ALL") | (F.col("window_season") == F.col("season")))
        & F.col("local_minute").between(F.col("start_minute"), F.col("end_minute")),
    ).select(
        "meter_id", "read_ts", F.col("kwh_delivered").alias("kwh"), "demand_kw", "utility_territory",
        "day_type", "season", "rate_plan_id", "rate_window_id", "tou_bucket",
        "energy_rate_per_kwh", "demand_rate_per_kw",
    )


def charge(tagged: DataFrame, slots_per_day: int = 96) -> DataFrame:
    """Energy by rate; demand as a daily spread of the kW rate over the day's slots."""
    spread = F.lit(slots_per_day).cast("decimal(5,1)")
    return tagged.select(
        "meter_id", "read_ts", "utility_territory", "rate_plan_id", "rate_window_id", "tou_bucket",
        "kwh", "demand_kw", "energy_rate_per_kwh", "demand_rate_per_kw",
        (F.col("kwh") * F.col("energy_rate_per_kwh")).cast("decimal(14,4)").alias("energy_charge"),
        (F.col("demand_kw") * F.col("demand_rate_per_kw") / spread).cast("decimal(14,4)").alias("demand_charge"),
    )


def charges_by(charges: DataFrame, *keys) -> DataFrame:
    """Energy, demand and total charges summed by any keys, with the implied rate."""
    energy, demand = F.sum("energy_charge"), F.sum("demand_charge")
    return charges.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("intervals"),
        F.sum("kwh").alias("kwh"),
        energy.alias("energy_charge"),
        demand.alias("demand_charge"),
        (F.coalesce(energy, F.lit(0)) + F.coalesce(demand, F.lit(0))).alias("total_charge"),
        ratio(energy, F.sum("kwh")).alias("implied_rate"),
    )


def bucket_usage(charges: DataFrame) -> DataFrame:
    """Daily kWh per meter split into off-peak, shoulder, on-peak and critical."""

    def split(bucket: str):
        return F.coalesce(
            F.sum(F.when(F.col("tou_bucket") == bucket, F.col("kwh"))), F.lit(0).cast("decimal(14,4)")
        ).alias(f"kwh_{bucket.lower()}")

    return charges.groupBy("meter_id", F.to_date("read_ts").alias("usage_date"), "utility_territory").agg(
        *[split(b) for b in ("OFF_PEAK", "SHOULDER", "ON_PEAK", "CRITICAL")],
        F.sum("kwh").alias("kwh_total"),
    )
