"""Hand-made frames for the edges of each rule."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from loadweave.operators import (
    anomaly, billing, calendar, channels, edge, governance, ingest, priority, quality, rollups, tariff, tou,
)
from loadweave.operators.ranking import global_rank
from loadweave.sources import reference, tables

READS = (
    "meter_id string, read_ts timestamp_ntz, kwh_delivered decimal(14,4), kwh_received decimal(14,4), "
    "demand_kw decimal(10,4), voltage_v decimal(6,2), vee_status string, utility_territory string, "
    "ingestion_lag_sec bigint, ingested_at timestamp_ntz, event_id bigint"
)
DAY = dt.datetime(2024, 1, 3)  # a Wednesday


def read(ts, kwh="1.0", meter="M1", received="0", status="VALID", lag=5, event=1, kw="4.0", arrived=None):
    received = None if received is None else D(received)
    return (meter, ts, D(kwh), received, D(kw), D("240.00"), status, "NE", lag, arrived or ts, event)


def frame(spark, rows):
    return spark.createDataFrame(rows, READS)


def slots(day=DAY, skip=(), **kw):
    return [read(day + dt.timedelta(minutes=15 * i), event=i, **kw) for i in range(96) if i not in skip]


def test_last_write_wins_ignores_arrival_order_and_stale_replays(spark):
    at = lambda m: DAY + dt.timedelta(minutes=m)
    rows = [read(DAY, "1", event=1, arrived=at(1)), read(DAY, "3", event=3, arrived=at(9)),
            read(DAY, "2", event=2, arrived=at(5)), read(DAY, "4", event=4, arrived=at(9))]
    kept = ingest.last_write_wins(frame(spark, rows), ["meter_id", "read_ts"], ["ingested_at", "event_id"]).collect()
    assert [r.kwh_delivered for r in kept] == [D("4.0000")]


def test_one_slot_with_a_third_of_all_rows(spark):
    hot = spark.range(30000).select(
        F.lit("HOT").alias("meter_id"), F.lit(DAY).cast("timestamp_ntz").alias("read_ts"), F.col("id").alias("event_id"))
    cold = spark.range(60000).select(
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("meter_id"),
        F.lit(DAY).cast("timestamp_ntz").alias("read_ts"), F.col("id").alias("event_id"))
    kept = ingest.last_write_wins(hot.union(cold), ["meter_id", "read_ts"], ["event_id"])
    assert kept.count() == 60001
    assert kept.filter("meter_id = 'HOT'").first().event_id == 29999
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_dense_day_completeness_and_rounding_between_levels(spark):
    rows = slots(skip={7}) + slots(DAY + dt.timedelta(days=1))
    rows[0] = read(DAY, event=0, status="FAILED")
    hours = rollups.hourly(frame(spark, rows))
    first, second = hours.orderBy("rollup_ts").limit(2).collect()
    assert (first.completeness_pct, first.vee_pass_pct) == (D("100.00"), D("75.00"))
    assert (second.source_interval_count, second.completeness_pct) == (3, D("75.00"))
    days = rollups.daily(hours).orderBy("rollup_ts").collect()
    assert [d.completeness_pct for d in days] == [D("98.96"), D("100.00")]
    assert days[0].vee_pass_pct == D("98.96")
    assert rollups.monthly(rollups.daily(hours)).first().source_interval_count == 191


def test_rollup_conserves_energy_and_net_skips_half_known_reads(spark):
    rows = [read(DAY, "2", received="0.5"), read(DAY + dt.timedelta(minutes=15), "3", received=None, event=2)]
    hour = rollups.hourly(frame(spark, rows)).first()
    assert (hour.kwh_delivered, hour.kwh_received, hour.kwh_net) == (D("5.0000"), D("0.5000"), D("1.5000"))


def test_sla_boundaries_and_unknown_lag(spark):
    lags = [None, 900, 901, 3600, 3601]
    rows = [read(DAY + dt.timedelta(minutes=15 * i), lag=lag) for i, lag in enumerate(lags)]
    row = quality.sla(frame(spark, rows)).first()
    assert (row.late_arrival_count, row.very_late_arrival_count) == (3, 1)
    assert row.pct_arrived_within_15min == D("20.00")


def test_quality_only_day_has_null_keys_unless_asked(spark):
    rows = frame(spark, slots())
    empty = quality.sla(rows).filter("false")
    dq = quality.data_quality(rows)
    assert quality.unified(empty, dq).first().date_key is None
    assert quality.unified(empty, dq, coalesce_keys=True).first().date_key == DAY.date()
    assert dq.first().missing_intervals == 0


def test_breach_alert(spark):
    rows = frame(spark, [read(DAY, lag=1000)])
    day = F.lit(str(DAY.date())).cast("date")
    assert quality.breach_alerts(quality.sla(rows), day).first().status == "ALERT"
    assert quality.breach_alerts(quality.sla(rows), F.date_add(day, 1)).count() == 0


def test_breach_alert_names_its_threshold(spark):
    rows = quality.sla(frame(spark, [read(DAY, lag=1000)]))
    day = F.lit(str(DAY.date())).cast("date")
    text = lambda **k: quality.breach_alerts(rows, day, **k).first().message
    assert text() == "SLA breach: ingestion < 95% within 15-min window"
    assert text(threshold=99.0) == "SLA breach: ingestion < 99% within 15-min window"


def test_run_log_shows_running_and_failed_runs_with_the_whole_error(spark, tmp_path):
    log = quality.RunLog(spark, str(tmp_path / "log"))
    seen = []

    def good():
        seen.extend(log.read().collect())
        return 5

    def bad():
        raise ValueError("x" * 5000)

    assert log.run("A", good) == 5
    with pytest.raises(ValueError):
        log.run("B", bad)
    assert [(r.pipeline_name, r.status) for r in seen] == [("A", "RUNNING")]
    rows = {r.pipeline_name: r for r in log.read().collect()}
    assert (rows["A"].status, rows["A"].rows_processed) == ("SUCCESS", 5)
    assert (rows["B"].status, rows["B"].error_count, len(rows["B"].message)) == ("FAILED", 1, 5000)


def test_all_mismatches_and_issues_are_kept_and_ranked(spark, tmp_path):
    shape = spark.range(400).select(
        F.format_string("M%04d", "id").alias("meter_id"), F.lit("RES").alias("meter_type"), F.lit(1.0).alias("eve"),
        (F.lit(2.0) + F.col("id") % 7).alias("day"), F.lit(0.5).alias("night"), F.lit(0.9).alias("overall"))
    wrong = edge.premise_mismatch(shape)
    assert wrong.count() == 400
    order = [F.desc("separation"), F.col("meter_id")]
    got = global_rank(wrong, order, str(tmp_path / "r")).collect()
    want = sorted(got, key=lambda r: (-r.separation, r.meter_id))
    assert [r["rank"] for r in want] == list(range(1, 401))
    issues = spark.range(250).select(F.col("id").cast("string").alias("issue_id"), (F.col("id") % 9).alias("score"))
    places = {r.issue_id: r["rank"] for r in priority.ranked(issues, "score", str(tmp_path / "i")).collect()}
    assert sorted(places.values()) == list(range(1, 251)) and places["107"] == 1
    assert global_rank(issues.limit(0), [F.col("issue_id")], str(tmp_path / "e")).count() == 0


def test_a_retransmitting_meter_is_combined_before_the_join(spark):
    hot = spark.range(30_000).select(
        F.lit(1).cast("bigint").alias("user_id"), F.lit(DAY).cast("timestamp_ntz").alias("read_ts"),
        F.col("id").cast("decimal(14,4)").alias("kwh_delivered"), F.lit(DAY).cast("timestamp_ntz").alias("ingested_at"),
        F.col("id").alias("event_id"))
    cold = spark.range(60_000).select(
        (F.col("id") + 2).alias("user_id"), F.lit(DAY).cast("timestamp_ntz").alias("read_ts"),
        F.lit(1).cast("decimal(14,4)").alias("kwh_delivered"), F.lit(DAY).cast("timestamp_ntz").alias("ingested_at"),
        F.col("id").alias("event_id"))
    rows = edge.repeated_slots(hot.unionByName(cold), ["user_id", "read_ts"]).collect()
    assert [(r.user_id, r.copies, int(r["first"].value), int(r.kept.value)) for r in rows] == [(1, 30_000, 0, 29_999)]


def test_channel_rows_counts_what_unpivot_makes(spark):
    rows = frame(spark, [read(DAY), read(DAY, meter="M2"), read(DAY, meter="M3", received="0.5"), read(DAY, meter="M4", received=None)])
    rows = rows.withColumns({"quality_flag": F.lit("A"), "estimation_method": F.lit(None).cast("string"), "source_file": F.lit("f")})
    meters = spark.createDataFrame([("M1", False), ("M2", True), ("M3", False), ("M4", False)], "meter_id string, has_der boolean")
    n = channels.channel_rows(rows, meters).agg(F.sum("n_channels")).first()[0]
    assert n == channels.unpivot(rows, meters).count() == 14


def test_riders_on_demand_and_unknown_riders(spark):
    rated = spark.createDataFrame(
        [("M1", DAY + dt.timedelta(minutes=15 * i), D("10"), D("0"), D(kw), "S-TIERED", "P1", "WEEKDAY", 15 * i)
         for i, kw in enumerate(["3", "7", "5"])],
        "meter_id string, read_ts timestamp_ntz, kwh_delivered decimal(14,4), kwh_received decimal(14,4), "
        "demand_kw decimal(10,4), schedule_id string, billing_period_id string, day_type string, local_minute int")
    energy = tariff.energy_charges(rated, tariff.components(spark))
    row = tariff.rider_charges(rated, energy, [("PEAK", "DEMAND", "2.00000", "KW")]).first()
    assert (row.quantity, row.charge) == (D("7.000000"), D("14.0000"))
    for wrong in (("X", "DEMAND", "1", "KWH"), ("X", "ALL", "1", "MOON"), ("X", "RECEIVED", "1", "PCT")):
        with pytest.raises(ValueError):
            tariff.rider_charges(rated, energy, [wrong])


def test_documents_with_demand_schedules_price_by_month_and_day(spark):
    hours = lambda on: [1 if on <= h < on + 4 else 0 for h in range(24)]
    document = {
        "label": "S", "energyratestructure": [[{"rate": 0.1, "max": 15}, {"rate": 0.2}], [{"rate": 0.5}]],
        "energyweekdayschedule": [hours(16)] * 6 + [hours(12)] * 6, "energyweekendschedule": [[0] * 24] * 12,
        "demandratestructure": [[{"rate": 2.0}], [{"rate": 9.0}]],
        "demandweekdayschedule": [hours(16)] * 12, "demandweekendschedule": [[0] * 24] * 12, "fixedchargefirstmeter": 5.0,
    }
    docs = spark.createDataFrame([(json.dumps(document),)], "document string")
    parts = tariff.document_components(tariff.flatten_documents(docs))
    days = {dt.datetime(2024, 1, 3): "WEEKDAY", dt.datetime(2024, 7, 3): "WEEKDAY", dt.datetime(2024, 1, 6): "WEEKEND", dt.datetime(2024, 1, 1): "HOLIDAY"}
    rated = spark.createDataFrame(
        [("M1", d + dt.timedelta(hours=h), D("10"), D("0"), D("3"), "S", f"P{d:%m%d}", kind, 60 * h)
         for d, kind in days.items() for h in (13, 17)],
        "meter_id string, read_ts timestamp_ntz, kwh_delivered decimal(14,4), kwh_received decimal(14,4), "
        "demand_kw decimal(10,4), schedule_id string, billing_period_id string, day_type string, local_minute int")
    paid = {r.billing_period_id: r.c for r in tariff.energy_charges(rated, parts).groupBy("billing_period_id").agg(F.sum("charge").alias("c")).collect()}
    # 13 and 17 o'clock: off and on in winter, on and off in summer, off all weekend and holiday (5 kWh beyond the tier).
    assert paid == {"P0103": D("6.0000"), "P0703": D("6.5000"), "P0106": D("2.5000"), "P0101": D("2.5000")}
    peaks = tariff.demand_charges(rated, parts).groupBy("billing_period_id").agg(F.max("charge").alias("c")).collect()
    assert {r.billing_period_id: r.c for r in peaks} == {"P0103": 27, "P0703": 27, "P0106": 6, "P0101": 6}


def test_window_ends_day_types_and_overlap(spark):
    links = spark.createDataFrame([("M1", "C1", True)], "meter_id string, customer_id string, is_current boolean")
    customers = spark.createDataFrame([("C1", "RP-TOU3")], "customer_id string, rate_plan_id string")
    times = [(3, 15, 45), (3, 16, 0), (3, 20, 45), (3, 21, 0), (6, 16, 0), (1, 16, 0)]
    rows = frame(spark, [read(dt.datetime(2024, 1, d, h, mi), event=i) for i, (d, h, mi) in enumerate(times)])
    tagged = tou.tag(rows, tou.current_plans(links, customers), reference.rate_windows(spark))
    buckets = {r.read_ts: (r.day_type, r.tou_bucket) for r in tagged.collect()}
    assert [buckets[dt.datetime(2024, 1, d, h, mi)] for d, h, mi in times] == [
        ("WEEKDAY", "SHOULDER"), ("WEEKDAY", "ON_PEAK"), ("WEEKDAY", "ON_PEAK"), ("WEEKDAY", "OFF_PEAK"),
        ("WEEKEND", "OFF_PEAK"), ("HOLIDAY", "OFF_PEAK")]
    assert tou.overlapping_windows(reference.rate_windows(spark)).count() == 0
    touching = reference.rate_windows(spark).withColumn("end_minute", F.col("end_minute") + 1)
    assert tou.overlapping_windows(touching).count() > 0


def test_local_time_across_daylight_saving(spark):
    row = spark.sql("""SELECT convert_timezone('UTC', 'America/New_York', timestamp_ntz'2024-03-10 06:45:00') AS a,
                              convert_timezone('UTC', 'America/New_York', timestamp_ntz'2024-03-10 07:00:00') AS b""").first()
    assert (row.a.hour, row.b.hour) == (1, 3)


def test_unpivot_and_pivot_are_inverse(spark):
    rows = frame(spark, [read(DAY, "2"), read(DAY, "3", meter="M2", received="0.7")]).withColumn(
        "quality_flag", F.lit("A")).withColumn("estimation_method", F.lit(None).cast("string")).withColumn(
        "source_file", F.lit("f"))
    meters = spark.createDataFrame([("M1", False), ("M2", True)], "meter_id string, has_der boolean")
    long = channels.unpivot(rows, meters)
    assert long.filter("channel_code = 'KWH_REC'").count() == 1
    back = {r.meter_id: r for r in channels.pivot_wide(long).collect()}
    assert back["M1"].kwh_received is None and back["M2"].kwh_received == D("0.7000")
    assert back["M1"].demand_kw == D("4.0000") and back["M1"].voltage_v == D("240.00")


def test_billing_ready_and_reconciliation(spark):
    days = spark.createDataFrame(
        [("M1", DAY, D("10"), D("0"), D("10"), D("1"), D("99.00"), D("97.00")),
         ("M1", DAY + dt.timedelta(days=1), D("10"), D("0"), D("10"), D("2"), D("99.00"), D("97.00"))],
        "meter_id string, rollup_ts timestamp_ntz, kwh_delivered decimal(14,4), kwh_received decimal(14,4), "
        "kwh_net decimal(14,4), max_demand_kw decimal(10,4), completeness_pct decimal(5,2), vee_pass_pct decimal(5,2)")
    meters = spark.createDataFrame([("M1", "S1")], "meter_id string, service_point_id string")
    d = DAY.date()
    periods = spark.createDataFrame(
        [(f"P{i}", "A", "S1", d, d + dt.timedelta(days=1), None if b is None else D(b))
         for i, b in enumerate([None, "0", "20", "16"])],
        "billing_period_id string, cis_account_id string, service_point_id string, start_date date, end_date date, "
        "cis_billed_kwh decimal(14,4)")
    used = billing.consumption(periods, meters, days)
    assert all(r.is_billing_ready and r.kwh_total == 20 for r in used.collect())
    got = {r.billing_period_id: (r.variance_kwh, r.variance_pct) for r in billing.reconcile(used, periods).collect()}
    assert got == {"P0": (0, None), "P1": (20, None), "P2": (0, 0.0), "P3": (4, 25.0)}
    touching = periods.limit(1).unionByName(periods.limit(1).withColumn("billing_period_id", F.lit("PX")))
    assert calendar.overlapping_periods(touching).count() == 1


def test_tier_border_splits_a_read_and_fixed_amount_adds_up(spark):
    rated = spark.createDataFrame(
        [("M1", DAY + dt.timedelta(minutes=15 * i), D(k), D("0"), D("1"), "S-TIERED", "P1", "WEEKDAY", 15 * i)
         for i, k in enumerate(["150", "100", "300"])],
        "meter_id string, read_ts timestamp_ntz, kwh_delivered decimal(14,4), kwh_received decimal(14,4), "
        "demand_kw decimal(10,4), schedule_id string, billing_period_id string, day_type string, local_minute int")
    parts = tariff.components(spark)
    rows = tariff.energy_charges(rated, parts).orderBy("read_ts", "tier_from_kwh").collect()
    assert [(r.quantity, r.rate) for r in rows] == [
        (D("150.0000"), D("0.10000")), (D("50.0000"), D("0.10000")), (D("50.0000"), D("0.14000")),
        (D("250.0000"), D("0.14000")), (D("50.0000"), D("0.18000"))]
    fixed = tariff.fixed_charges(rated, parts)
    assert fixed.agg(F.sum("charge")).first()[0] == D("10.0000")


def test_constant_and_short_series_can_be_scored(spark):
    hours = [DAY + dt.timedelta(days=7 * i) for i in range(4)]
    rows = [("CONST", t, D("5")) for t in hours] + [("SHORT", hours[0], D("5")), ("SHORT", hours[1], D("7"))]
    load = spark.createDataFrame(rows, "feeder_id string, ts timestamp_ntz, kwh decimal(18,4)")
    base = anomaly.fit_baseline(load, "feeder_id", [])
    at = {(r.feeder_id, r.day_type, r.hour): r for r in base.collect()}
    assert (at["CONST", "WEEKDAY", 0].level, at["CONST", "WEEKDAY", 0].sigma) == ("DAY_HOUR", 0.01)
    assert at["SHORT", "WEEKEND", 5].level == "SERIES"
    assert at["SHORT", "WEEKDAY", 0].forecast == 6.0
    spike = spark.createDataFrame([("CONST", DAY, D("15"))], "feeder_id string, ts timestamp_ntz, kwh decimal(18,4)")
    assert anomaly.detect(spike, base, "feeder_id", []).first().is_anomaly


def test_injected_anomalies_are_recalled(spark):
    start = dt.datetime(2024, 1, 1)
    train = [(f"M{m}", start + dt.timedelta(hours=h), D(10 + (h * 7 + m) % 3)) for m in range(4) for h in range(24 * 21)]
    schema = "meter_id string, ts timestamp_ntz, kwh decimal(18,4)"
    base = anomaly.fit_baseline(spark.createDataFrame(train, schema), "meter_id", [])
    later = start + dt.timedelta(days=21)

    def level(m, h):
        usual = 10 + (h * 7 + m) % 3
        return 3 * usual if m == 0 and 18 <= h < 22 else 0 if m == 1 and h < 48 else usual

    recent = [(f"M{m}", later + dt.timedelta(hours=h), D(level(m, h))) for m in range(4) for h in range(72)]
    scored = anomaly.detect(spark.createDataFrame(recent, schema), base, "meter_id", [])
    labels = spark.createDataFrame(
        [("theft", "M0", later + dt.timedelta(hours=18), later + dt.timedelta(hours=21)),
         ("dead", "M1", later, later + dt.timedelta(hours=47))],
        "label_id string, meter_id string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    row = anomaly.evaluate(scored, labels, "meter_id").first()
    assert (row.recall_pct, row.precision_pct, row.mean_hours_to_detect) == (D("100.00"), D("100.00"), 0.0)


def test_gap_fill_only_fills_gaps_and_actuals_win(spark):
    meters = spark.createDataFrame(
        [("M1", "RES", False, "NE", "America/New_York")],
        "meter_id string, meter_type string, has_der boolean, utility_territory string, timezone string")
    day = str(DAY.date())
    filled = edge.gap_fill(frame(spark, slots(skip={3, 50})), meters, day, day)
    assert sorted(r.read_ts.hour * 4 + r.read_ts.minute // 15 for r in filled.collect()) == [3, 50]
    assert edge.gap_fill(frame(spark, []), meters, day, day).count() == 96


def test_roles_and_masks(spark):
    rows = spark.createDataFrame([("NE", "a"), ("SE", "b")], "utility_territory string, account string")
    roles = reference.role_territories(spark)
    count = lambda role: governance.apply_row_policy(rows, role, roles).count()
    assert (count("ANALYST_NE"), count("OWNER"), count("NOBODY")) == (1, 2, 0)
    import hashlib
    shown = governance.mask_column(rows, "account", "OPS").orderBy("utility_territory").first().account
    assert shown == hashlib.sha256(b"a").hexdigest()
    assert governance.mask_column(rows, "account", "ENG").first().account in ("a", "b")


def test_bad_payloads_are_quarantined_not_lost(spark):
    texts = ['{"meter_id":"M1","read_ts":"2024-01-03T00:00:00","kwh_delivered":1.5}', "no json",
             '{"meter_id":"M1","read_ts":"yesterday"}', '{"meter_id":"M9","read_ts":"2024-01-03T00:00:00"}']
    raw = ingest.land(spark.createDataFrame([(t, "f", DAY) for t in texts],
                                            "payload_text string, source_file string, ingested_at timestamp_ntz"))
    meters = spark.createDataFrame([("M1", "NE", "America/New_York")],
                                   "meter_id string, utility_territory string, timezone string")
    good = ingest.normalise(raw, meters).collect()
    assert [r.kwh_delivered for r in good] == [D("1.5000")]
    held = {r.reason: r.payload_text for r in ingest.quarantine(raw, meters).collect()}
    assert set(held) == {"MALFORMED", "BAD_TIMESTAMP", "UNKNOWN_METER"}
    assert held["MALFORMED"] == "no json"


def test_estimation_streaks(spark):
    days = [0, 1, 2, 3, 7]
    rows = [read(DAY + dt.timedelta(days=d), status="ESTIMATED", event=d) for d in days]
    got = {r.days: r.is_sustained for r in edge.estimation_streaks(frame(spark, rows)).collect()}
    assert got == {4: True, 1: False}


def test_metric_layer_refuses_fan_out(spark, root):
    from loadweave.plans.marts import Marts
    from loadweave.plans.metrics import standard_model

    model = standard_model(Marts(spark, root))
    assert (len(model.metrics), len(model.facts), len(model.dimensions)) == (11, 14, 17)
    with pytest.raises(ValueError):
        model.query(["total_kwh"], ["billing.start_date"])


def test_purge_drops_only_old_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 2, 3)], "ingest_date date, x int")
    path = str(tmp_path / "bronze")
    tables.write_partitioned(rows, path, "ingest_date")
    assert tables.purge_before(spark, path, "ingest_date", dt.date(2024, 1, 3)) == [
        "ingest_date=2024-01-01", "ingest_date=2024-01-02"]
    assert spark.read.parquet(path).count() == 1


def test_published_views_respect_the_role(spark, root):
    from loadweave.plans.marts import Marts

    m = Marts(spark, root)
    governance.register_views(m.consumption, m.daily, m.feeder_events, "ANALYST_NE", m.roles)
    assert [r[0] for r in spark.sql("SELECT DISTINCT utility_territory FROM meter_daily_kwh").collect()] == ["NE"]
    row = spark.sql("SELECT max(length(cis_account_id)) AS n, count(*) AS c FROM cis_billing_consumption").first()
    assert row.n == 64 and 0 < row.c < m.consumption.count()


def test_long_histories_are_carried_along(spark):
    """Thousands of versions of one key, gaps between some, facts before the first: equal to the range join, without it."""
    first = dt.datetime(2023, 1, 1)
    versions = spark.range(5_000).select(
        F.when(F.col("id") < 4_990, "A").otherwise("B").alias("meter"), F.col("id").alias("version"),
        (F.lit(first).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id"))).alias("effective_from"),
    ).withColumn("effective_to", F.when(F.col("version") % 7 == 3, F.col("effective_from") + F.expr("interval 20 minutes")).when(
        ~F.col("version").isin(4_989, 4_999), F.col("effective_from") + F.expr("interval 1 hour")))
    facts = spark.range(8_000).select(
        F.element_at(F.array(F.lit("A"), F.lit("A"), F.lit("B"), F.lit("C")), (F.col("id") % 4 + 1).cast("int")).alias("meter"),
        (F.lit(first).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id") * 53 - 3_000)).alias("read_ts"), F.col("id").alias("_at"),
    ).unionByName(spark.createDataFrame([(None, first, -1), ("A", None, -2)], "meter string, read_ts timestamp_ntz, _at bigint"))
    short, long = tariff.as_of(facts, versions, "meter"), tariff.as_of_long(facts, versions, "meter")
    assert sorted(short.columns) == sorted(long.columns) and long.count() > 3_000
    assert sorted(map(repr, long.select(*short.columns).collect())) == sorted(map(repr, short.collect()))
    assert "Join" not in long._jdf.queryExecution().executedPlan().toString()


def test_a_sample_has_exactly_its_rows_in_any_partitioning(spark):
    df = spark.range(3_000).select("id", F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "").otherwise(None).alias("g"))
    wanted = {"a": 50, "": 50, None: 50}
    seen = set()
    for parts in (1, 4, 13):
        rows = ingest.sample_rows(df.repartition(parts), "id", 50, ["g"]).collect()
        assert {g: sum(r.g == g for r in rows) for g in wanted} == wanted
        seen.add(frozenset(r.id for r in rows))
    assert len(seen) == 1
    digest = ingest.hashed_key("id")
    best = {r.id for r in df.orderBy(digest, "id").limit(70).collect()}
    assert {r.id for r in ingest.sample_rows(df, "id", 70).collect()} == best
    assert ingest.sample_rows(df, "id", 5_000).count() == 3_000 and ingest.sample_rows(df.limit(0), "id", 5).count() == 0
    assert ingest.sample_rows(df, "id", 70, salt="x").join(ingest.sample_rows(df, "id", 70), "id").count() < 70


def test_flat_documents_without_schedules_hours_or_rates(spark):
    """What is missing gives no row; a broken document gives none at all."""
    documents = [
        {"label": "A", "energyratestructure": [[{"rate": 0.1}]], "energyweekdayschedule": [[0, 0, 1], [], None],
         "demandratestructure": [[{"rate": 8.0}, {"rate": 9.0}], [{}]]},
        {"label": "B", "demandratestructure": [[{"rate": 2.0, "max": 3}, {"rate": 4.0}]], "demandweekendschedule": [[0, 0]],
         "fixedchargefirstmeter": 1.5},
        {"label": "C"},
    ]
    docs = spark.createDataFrame([(json.dumps(d),) for d in documents] + [(None,), ("{",)], "document string")
    flat = tariff.flatten_documents(docs).select(
        "schedule_id", "component_type", "day_type", "month", "start_hour", "end_hour", "period", "tier", "tier_from_kwh",
        "tier_to_kwh", "rate", "unit",
    )
    assert {tuple(r) for r in flat.collect()} == {
        ("A", "ENERGY", "WEEKDAY", 1, 0, 1, 0, 1, D("0"), None, D("0.1"), "KWH"),
        ("A", "DEMAND", "ALL", None, 0, 23, 0, 1, None, None, D("8"), "KW"),
        ("A", "DEMAND", "ALL", None, 0, 23, 1, 1, None, None, None, "KW"),
        ("B", "DEMAND", "WEEKEND", 1, 0, 1, 0, 1, D("0"), D("3"), D("2"), "KW"),
        ("B", "DEMAND", "WEEKEND", 1, 0, 1, 0, 2, D("3"), None, D("4"), "KW"),
        ("B", "FIXED", "ALL", None, 0, 23, None, None, None, None, D("1.5"), "MONTH"),
    }


def test_channel_hours_equal_hours_of_unfolded_reads(spark):
    """Odd rows included: null and negative export, meters listed twice, rules given twice or for no channel of a read."""
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    wide = spark.createDataFrame(
        [("A", at(0, 0), 1.5, 0.0, 2.25, 230.1, "VALID", "NE"), ("A", at(0, 15), None, None, None, None, "FAILED", "NE"),
         ("A", at(0, 15), 3.0, -2.0, None, 1.0, "VALID", None), ("B", at(0, 0), 1.0, 0.0, 2.0, 3.0, "VALID", "NE"),
         ("B", at(0, 15), 1.0, 7.0, 2.0, 3.0, "FAILED", "NE"), ("B", at(0, 30), 1.0, -1.0, 2.0, 3.0, "VALID", "NE"),
         ("B", at(1, 30), 1.0, 0.0, 2.0, 3.0, "VALID", "NE"), ("C", at(0, 0), 1.0, None, 2.0, 3.0, "VALID", "NE"),
         ("C", at(0, 20), 5.0, 1.0, 7.0, 8.0, None, "NE"), (None, at(0, 0), 1.0, None, 2.0, 3.0, "VALID", "NE"),
         ("D", at(0, 0), 1.0, 2.0, 2.0, 3.0, "VALID", "NE"), ("E", at(2, 0), 1.0, 2.0, 2.0, 3.0, "VALID", "NE")],
        "meter_id string, read_ts timestamp_ntz, del double, rec double, kw double, volt double, vee_status string, utility_territory string",
    ).selectExpr(
        "meter_id", "read_ts", "cast(del as decimal(14,4)) kwh_delivered", "cast(rec as decimal(14,4)) kwh_received",
        "cast(kw as decimal(10,4)) demand_kw", "cast(volt as decimal(6,2)) voltage_v", "vee_status", "utility_territory",
        *[f"cast(null as string) {c}" for c in channels.CARRIED if c not in ("vee_status", "utility_territory")],
    )
    meters = spark.createDataFrame(
        [("A", True), ("C", True), ("C", True), ("B", False), ("B", None), (None, True), ("D", False)], "meter_id string, has_der boolean"
    )
    usual = [("KWH_DEL", "SUM"), ("KW_DEM", "MAX"), ("VOLT_AVG", "AVG"), ("KWH_REC", "SUM")]
    rules = spark.createDataFrame(
        [(m, *r) for m in "ABC" for r in usual] + [("B", "KWH_REC", a) for a in ("MIN", "MAX", "AVG")]
        + [("B", "KWH_DEL", "SUM"), ("D", "KWH_DEL", None), ("D", "OTHER", "SUM"), (None, "KWH_DEL", "SUM"), ("D", None, "SUM")],
        "meter_id string, channel_code string, aggregation string",
    )
    unfolded = channels.channel_hourly(channels.unpivot(wide, meters), rules, 4)
    beside = channels.channel_hours(channels.with_rules(wide, meters, rules), 4)
    assert beside.schema == unfolded.schema
    assert sorted(map(str, beside.collect())) == sorted(map(str, unfolded.collect())) and unfolded.count() == 25
