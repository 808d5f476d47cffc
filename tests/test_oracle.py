"""Queries against their oracle. A core set by default, every query with ``ALL_QUERIES=1``."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from loadweave.plans import catalog

CORE = [
    "canonical_reads", "normalize_reads", "quarantined_reads", "unpivot_channels", "wide_view", "channel_hourly",
    "channel_daily", "hourly_rollup", "daily_rollup", "monthly_rollup", "time_dim", "load_profile", "tou_tagged_local",
    "charge_line", "billing_recon", "obs_dashboard", "sla_breach", "duplicate_audit", "premise_mismatch_report",
    "anomaly_baseline", "feeder_anomalies", "xfm_attribution", "model_card", "edge_kpi", "worst_feeders",
    "ingestion_hourly", "metric_by_territory", "metric_by_premise", "row_policy", "mask_account", "asof_link",
    "tariff_components", "charge_components", "fixed_charges", "rider_charges", "shadow_bill", "ops_queue",
    "xfm_hourly", "gap_fill", "metric_anomaly", "estimation_streaks", "late_upsert", "stream_hourly",
    "filled_reads", "refresh_history", "dated_riders", "asof_long", "sample_per_territory", "row_policy_meters", "retention_purge",
]
NAMES = sorted(contract.oracle_sql()) if os.environ.get("ALL_QUERIES") else CORE


@pytest.fixture(scope="module")
def duck(root):
    return connect(root)


@pytest.mark.parametrize("name", NAMES)
def test_equals_oracle(spark, root, duck, name):
    frame = contract.queries()[name](spark, root)
    assert difference(frame, duck, contract.oracle_sql()[name]) is None


def test_every_query_has_an_oracle():
    assert set(catalog.CATALOG) <= set(contract.oracle_sql())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0
    assert "completeness_pct" in frame.columns
