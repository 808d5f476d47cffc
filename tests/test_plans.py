"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from loadweave.operators import ingest
from loadweave.plans import catalog
from loadweave.plans.marts import Marts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "daily_rollup", "channel_daily", "charge_line", "billing_recon", "feeder_anomalies", "charge_components",
    "gap_fill", "shadow_bill", "premise_mismatch", "meter_channels",
])
def test_no_product_joins_and_no_python(spark, root, name):
    text = plan(catalog.run(name, spark, root))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in text


def test_date_ranges_reach_the_scan(spark, root):
    m = Marts(spark, root)
    text = plan(m.daily_between(m.day(3), m.anchor))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_only_needed_columns_are_read(spark, root):
    text = plan(catalog.run("events_summary", spark, root))
    assert "ReadSchema: struct<event_type:string>" in text


@pytest.mark.parametrize("name", ["tou_tagged", "charge_line", "load_profile", "peak_exposure", "rider_charges", "ops_queue"])
def test_facts_are_never_dealt_by_time(spark, root, name):
    """Day type, season and minute are worked out from the time, so no calendar is joined."""
    m = Marts(spark, root)
    frame = m.scored_issues if name == "ops_queue" else catalog.CATALOG[name](m)
    text = plan(frame)
    assert "hashpartitioning(read_ts" not in text and "hashpartitioning(ts" not in text and "Range (" not in text


@pytest.mark.parametrize("name", ["duplicate_audit", "table_metrics", "metric_history", "stream_counts", "retention", "normalize_reads"])
def test_raw_copies_are_combined_before_any_join(spark, root, name):
    """Below every join lies an aggregate: no raw copy reaches one."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = Marts(spark, root)
        if name == "normalize_reads":
            landed = ingest.land(m.feed.payloads)
            frame = ingest.latest_reads(landed, m.feed.lookup.meters, ["ingested_at", "event_id"])
            optimized = frame._jdf.queryExecution().optimizedPlan().toString()
            assert optimized.index("Join") < optimized.index("max_by")
            return
        lines = plan(catalog.CATALOG[name](m)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scans = [i for i, line in enumerate(lines) if "events.parquet" in line]
    assert scans
    for scan in scans:
        depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
        above, at = [], depth(lines[scan])
        for line in reversed(lines[:scan]):
            if depth(line) < at:
                at = depth(line)
                above.append(line)
        first = next((line for line in above if "Aggregate" in line or "Join" in line), "")
        assert "Aggregate" in first


def test_dimensions_are_broadcast_by_size_and_facts_dealt_by_meter_once(spark, root):
    """With the facts too large to be sent around, the accounts still are; all rollups share one distribution."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    m = Marts(spark, root)
    accounts = m.feed.accounts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(accounts))
    try:
        monthly, charges = plan(Marts(spark, root).monthly), plan(Marts(spark, root).charges)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert monthly.count("Exchange hashpartitioning") == 2
    for text in (monthly, charges):
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "BuildLeft" not in text


def test_observability_and_shadow_bill_scan_the_facts_once(spark, root):
    for name in ("obs_dashboard", "shadow_bill"):
        assert plan(catalog.run(name, spark, root)).count("events.parquet") == 1


def test_fact_lookups_do_not_scan_the_facts_again(spark, root):
    assert plan(catalog.run("feeder_load", spark, root)).count("events.parquet") == 1
    assert plan(catalog.run("charge_line", spark, root)).count("events.parquet") == 1


def test_document_components_are_not_sent_to_the_driver(spark, root):
    """They are many times the accounts they come from, which no size estimate knows."""
    frame = catalog.run("document_charges", spark, root)
    nodes = frame._jdf.queryExecution().executedPlan().initialPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    sent = [i for i, line in enumerate(nodes) if "BroadcastExchange" in line]
    for at in sent:
        below = []
        for line in nodes[at + 1:]:
            if depth(line) <= depth(nodes[at]):
                break
            below.append(line)
        assert not any("posexplode(tiers" in line for line in below)
    assert any("posexplode(tiers" in line for line in nodes)


def test_documents_are_read_in_many_tasks_and_scheduled_rates_in_one_pass(spark, root):
    m = Marts(spark, root)
    assert m.tariff_documents.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert plan(catalog.CATALOG["tariff_components"](m)).count("from_json(") == 2
