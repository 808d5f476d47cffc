"""Row policies, column masks and the published projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from loadweave.sources.reference import SEE_ALL_ROLES, UNMASKED_ROLES


def apply_row_policy(
    df: DataFrame, role: str, mapping: DataFrame, territory: str = "utility_territory",
    see_all: Iterable[str] = SEE_ALL_ROLES,
) -> DataFrame:
    """Rows of the territories mapped to ``role``; privileged roles see all, unmapped ones nothing."""
    if role in set(see_all):
        return df
    allowed = mapping.filter(F.col("role_name") == role).select(F.col("utility_territory").alias(territory))
    return df.join(allowed, territory, "left_semi")


def masked(value: Column, role: str, unmasked: Iterable[str] = UNMASKED_ROLES) -> Column:
    return value if role in set(unmasked) else F.sha2(value, 256)


def mask_column(df: DataFrame, name: str, role: str, unmasked: Iterable[str] = UNMASKED_ROLES) -> DataFrame:
    return df.withColumn(name, masked(F.col(name), role, unmasked))


def published_billing(consumed: DataFrame, role: str) -> DataFrame:
    """Billing consumption for outside readers; the account is masked before it leaves."""
    return mask_column(consumed, "cis_account_id", role).select(
        "billing_period_id", "cis_account_id", "service_point_id", "meter_id", "start_date", "end_date",
        "kwh_total", "kwh_received", "kwh_net", "max_demand_kw", "completeness_pct", "vee_pass_pct",
        "is_billing_ready",
    )


def published_daily(days: DataFrame) -> DataFrame:
    return days.select(
        "meter_id", "utility_territory", F.to_date("rollup_ts").alias("read_date"),
        "kwh_delivered", "kwh_received", "max_demand_kw", "completeness_pct", "vee_pass_pct",
    )


def published_anomalies(events: DataFrame) -> DataFrame:
    return events.filter("is_anomaly")


def register_views(
    consumed: DataFrame, days: DataFrame, events: DataFrame, role: str, mapping: DataFrame
) -> None:
    """Make the published projections available to SQL under the rights of ``role``."""
    visible = apply_row_policy(days, role, mapping)
    # Billing rows carry no territory of their own; their meters' visibility decides.
    meters = visible.select("meter_id").distinct()
    published_billing(consumed.join(meters, "meter_id", "left_semi"), role).createOrReplaceTempView("cis_billing_consumption")
    published_daily(visible).createOrReplaceTempView("meter_daily_kwh")
    published_anomalies(events).createOrReplaceTempView("published_feeder_anomalies")
