"""Consumption per billing period and its reconciliation with billed quantities."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loadweave.functions import mean
from loadweave.sources.reference import READY_COMPLETENESS_PCT, READY_VEE_PCT


def consumption(
    periods: DataFrame,
    meters: DataFrame,
    days: DataFrame,
    ready_completeness: float = READY_COMPLETENESS_PCT,
    ready_vee: float = READY_VEE_PCT,
) -> DataFrame:
    """Daily rollups inside each period, both end dates included.

    The range condition rides on the meter equality, so the join is hashed, never nested-loop.
    """
    metered = periods.join(meters.select("service_point_id", "meter_id"), "service_point_id")
    day = F.to_date("rollup_ts")
    joined = metered.join(
        days.select("meter_id", day.alias("day"), "kwh_delivered", "kwh_received", "kwh_net",
                    "max_demand_kw", "completeness_pct", "vee_pass_pct"),
        "meter_id",
    ).filter(F.col("day").between(F.col("start_date"), F.col("end_date")))
    # Thresholds compare the unrounded means: sums against threshold times count.
    n = F.count(F.lit(1))
    ready = (
        F.coalesce(F.sum("completeness_pct") >= n * F.lit(ready_completeness), F.lit(False))
        & F.coalesce(F.sum("vee_pass_pct") >= n * F.lit(ready_vee), F.lit(False))
    )
    return joined.groupBy(
        "billing_period_id", "cis_account_id", "service_point_id", "meter_id", "start_date", "end_date"
    ).agg(
        F.sum("kwh_delivered").alias("kwh_total"),
        F.sum("kwh_received").alias("kwh_received"),
        F.sum("kwh_net").alias("kwh_net"),
        F.max("max_demand_kw").alias("max_demand_kw"),
        mean("completeness_pct", 2).alias("completeness_pct"),
        mean("vee_pass_pct", 2).alias("vee_pass_pct"),
        ready.alias("is_billing_ready"),
    )


def reconcile(consumed: DataFrame, periods: DataFrame) -> DataFrame:
    """Variance against the billed quantity; no billed quantity means no variance."""
    total, billed = F.col("kwh_total"), F.col("cis_billed_kwh")
    return consumed.join(periods.select("billing_period_id", "cis_billed_kwh"), "billing_period_id").select(
        "billing_period_id", "cis_account_id", "meter_id",
        total.alias("interval_sum_kwh"), "cis_billed_kwh",
        (total - F.coalesce(billed, total)).alias("variance_kwh"),
        F.round(
            F.abs(total - billed).cast("double") / F.nullif(billed, F.lit(0)).cast("double") * 100, 6
        ).alias("variance_pct"),
        "completeness_pct", "is_billing_ready",
    )
