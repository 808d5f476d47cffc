"""Reports and metrics over stored tables give what they give over the feed, and read the tables."""

from __future__ import annotations

import pytest

from loadweave.plans import catalog, reports
from loadweave.plans.marts import Marts
from loadweave.plans.metrics import standard_model
from loadweave.plans.stored import StoredMarts
from loadweave.streaming.refresh import WIDER

NAMES = [
    "ingestion_kpi", "ingestion_hourly", "ingestion_sla", "dq_daily", "worst_feeders", "billing_stats", "billing_trend",
    "worst_unready", "tou_bucket_totals", "tou_daily_revenue", "tou_implied_rate", "anomaly_kpi", "top_feeder_anomalies",
    "xfm_attribution", "xfm_top_loaded", "feeder_health", "partial_meters", "lag_histogram", "vee_trend",
    "premise_mismatch_report", "reads_per_hour", "sla_heatmap", "vee_pass_trend", "interval_volume", "vee_share",
    "rollup_counts", "obs_spot_check",
]


@pytest.fixture(scope="module")
def fed(spark, root):
    return Marts(spark, root)


@pytest.fixture(scope="module")
def kept(spark, fed, tmp_path_factory):
    marts = catalog._tables(fed, str(tmp_path_factory.mktemp("stored")), *WIDER)
    marts.build(fed.reads)
    return StoredMarts(spark, marts, fed.feed)


def rows(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("name", NAMES)
def test_a_report_is_the_same_from_tables(fed, kept, name):
    report = getattr(reports, name)
    assert rows(report(kept)) == rows(report(fed))


def test_metrics_are_the_same_from_tables(fed, kept):
    for metrics, dimensions in (
        (["total_kwh", "meter_count", "total_energy_charge"], ["meter.territory"]), (["billing_ready_pct"], []),
        (["avg_pct_on_time"], ["sla.territory"]),
    ):
        assert rows(standard_model(kept).query(metrics, dimensions)) == rows(standard_model(fed).query(metrics, dimensions))


def test_reports_scan_tables_and_only_their_days(kept):
    def scans(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    for report in (reports.billing_stats, reports.sla_heatmap, reports.tou_bucket_totals, reports.xfm_attribution):
        assert "events.parquet" not in scans(report(kept))
    text = scans(kept.daily_between(kept.day(3), kept.anchor))
    assert "PartitionFilters: [isnotnull(part_date" in text
