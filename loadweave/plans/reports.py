"""Report queries over the marts. Each is a function of the marts; ranges end at the anchor day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from loadweave.functions import hour_floor, pct, ratio
from loadweave.operators import anomaly, edge, quality, topology
from loadweave.operators.channels import channel_rows
from loadweave.plans.marts import Marts, ntz
from loadweave.sources import reference
from loadweave.sources.reference import TERRITORIES


def n_rows() -> Column:
    return F.count(F.lit(1))


def _pivot_territories(df: DataFrame, key: str, value: str, how) -> DataFrame:
    """One column per territory; conditional aggregates keep it to a single shuffle."""
    return df.groupBy(key).agg(
        *[how(F.when(F.col("utility_territory") == t, F.col(value))).alias(t.lower()) for t in TERRITORIES]
    )


def _average(column: Column, scale: int = 2) -> Column:
    return (F.sum(column) / F.nullif(F.count(column), F.lit(0))).cast(f"decimal(12,{scale})")


# -- ingestion ------------------------------------------------------------------------------------


def ingestion_kpi(m: Marts) -> DataFrame:
    on_day = m.sla_between(m.anchor, m.anchor).agg(
        _average(F.col("pct_arrived_within_15min")).alias("on_time"),
        F.coalesce(F.sum("late_arrival_count"), F.lit(0)).alias("late_1d"),
    )
    totals = m.reads.groupBy("meter_id").agg(n_rows().alias("n")).agg(
        F.sum("n").alias("interval_rows"), n_rows().alias("meters")
    )
    late_price = float(reference.KWH_PER_LATE_READ) * float(reference.FLAT_RATE_PER_KWH)
    return (
        totals.withColumn("one", F.lit(1)).join(on_day.withColumn("one", F.lit(1)), "one")
        .select("interval_rows", "meters", "on_time", "late_1d",
                F.round(F.col("late_1d") * F.lit(late_price), 2).alias("late_exposure"))
    )


def ingestion_hourly(m: Marts) -> DataFrame:
    reads = m.reads_between(m.end_of_anchor(2), m.end_of_anchor())
    counted = reads.groupBy(hour_floor("read_ts").alias("hour"), "utility_territory").agg(n_rows().alias("c"))
    wide = _pivot_territories(counted, "hour", "c", F.sum)
    return wide.orderBy("hour").select(
        F.date_format("hour", "MM-dd HH").alias("hr"), *[F.col(t.lower()) for t in TERRITORIES]
    )


def ingestion_sla(m: Marts) -> DataFrame:
    rows = m.sla_between(m.day(14), m.anchor).groupBy("date_key").agg(
        _average(F.col("pct_arrived_within_15min")).alias("pct_on_time")
    )
    return rows.orderBy("date_key").select(F.date_format("date_key", "MM-dd").alias("date_key"), "pct_on_time")


def dq_daily(m: Marts) -> DataFrame:
    wide = _pivot_territories(m.dq_between(m.day(14), m.anchor), "date_key", "vee_pass_rate", _average)
    return wide.orderBy("date_key").select(
        F.date_format("date_key", "MM-dd").alias("date_key"), *[F.col(t.lower()) for t in TERRITORIES]
    )


def _completeness(m: Marts) -> DataFrame:
    """Eight calendar days over a seven-day denominator, as the reports define it."""
    return topology.feeder_completeness(m.reads_of_days(m.day(7), m.anchor), m.placed, m.per_day, 7)


def worst_feeders(m: Marts, top: int = 20) -> DataFrame:
    return _completeness(m).select("feeder_id", "meters", "completeness_pct").orderBy(
        "completeness_pct", "feeder_id"
    ).limit(top)


def worst_feeders_rolling(m: Marts, top: int = 20) -> DataFrame:
    """The dashboard's variant: seven days up to now, where now is the end of the data."""
    reads = m.reads_between(m.end_of_anchor(7), m.span[1])
    return topology.feeder_completeness(reads, m.placed, m.per_day, 7).select(
        "feeder_id", "meters", "completeness_pct"
    ).orderBy("completeness_pct", "feeder_id").limit(top)


# -- billing --------------------------------------------------------------------------------------


def billing_stats(m: Marts) -> DataFrame:
    ready = F.count_if(F.col("is_billing_ready"))
    return m.consumption.agg(n_rows().alias("total"), ready.alias("ready"), pct(ready, n_rows()).alias("pct_ready"))


def billing_trend(m: Marts) -> DataFrame:
    ready = F.count_if(F.col("is_billing_ready"))
    held = F.count_if(~F.col("is_billing_ready"))
    price = F.lit(reference.KWH_PER_HELD_BILL * reference.FLAT_RATE_PER_KWH)
    return m.consumption.groupBy(F.date_format("start_date", "yyyy-MM").alias("period")).agg(
        n_rows().alias("total"), ready.alias("ready"), held.alias("not_ready"),
        pct(ready, n_rows()).alias("pct_ready"),
        (held * price / F.lit(1000000)).cast("decimal(12,2)").alias("dollars_held_m"),
    ).orderBy("period")


def billing_by_period(m: Marts) -> DataFrame:
    return m.consumption.groupBy(F.date_format("start_date", "yyyy-MM").alias("start_date")).agg(
        F.count_if(F.col("is_billing_ready")).alias("ready"),
        F.count_if(~F.col("is_billing_ready")).alias("not_ready"),
    ).orderBy("start_date")


def billing_ready_by_start(m: Marts) -> DataFrame:
    ready = F.count_if(F.col("is_billing_ready"))
    return m.consumption.groupBy("start_date").agg(
        n_rows().alias("total_periods"), ready.alias("ready"), pct(ready, n_rows()).alias("pct_ready")
    ).orderBy(F.desc("start_date"))


def worst_unready(m: Marts, top: int = 10) -> DataFrame:
    return m.consumption.filter(~F.col("is_billing_ready")).select(
        "billing_period_id", "meter_id", "kwh_total", "completeness_pct", "vee_pass_pct"
    ).orderBy("completeness_pct", "billing_period_id").limit(top)


# -- time of use ----------------------------------------------------------------------------------


def tou_bucket_totals(m: Marts) -> DataFrame:
    lines = m.charges_between(m.day(30), m.end_of_anchor())
    return lines.groupBy("tou_bucket").agg(
        F.sum("energy_charge").cast("decimal(14,2)").alias("energy_charge")
    ).orderBy(F.desc("energy_charge"))


def tou_daily_revenue(m: Marts) -> DataFrame:
    lines = m.charges_between(m.day(14), m.end_of_anchor())
    return lines.groupBy(F.to_date("read_ts").alias("d")).agg(
        F.sum("energy_charge").cast("decimal(14,2)").alias("energy"),
        F.sum("demand_charge").cast("decimal(14,2)").alias("demand"),
    ).orderBy("d").select(F.date_format("d", "MM-dd").alias("day"), "energy", "demand")


def tou_implied_rate(m: Marts, plan: str = "RP-TOU3", back: int = 5) -> DataFrame:
    """One plan's buckets on one weekday."""
    day = m.day(back)
    lines = m.charges_between(day, dt.datetime.combine(day, dt.time(23, 59, 59)))
    return lines.filter(F.col("rate_plan_id") == plan).groupBy("tou_bucket").agg(
        n_rows().alias("intervals"), F.sum("kwh").cast("decimal(14,2)").alias("kwh"),
        F.sum("energy_charge").alias("energy_charge"),
        ratio(F.sum("energy_charge"), F.sum("kwh"), 5).alias("implied_rate"),
    )


# -- anomalies ------------------------------------------------------------------------------------


def anomaly_kpi(m: Marts) -> DataFrame:
    feeders = m.feeder_events.agg(
        n_rows().alias("scored"), F.count_if(F.col("is_anomaly")).alias("feeder_anomalies")
    )
    meters = m.meter_events.agg(F.count_if(F.col("is_anomaly")).alias("meter_anomalies"))
    return feeders.withColumn("one", F.lit(1)).join(meters.withColumn("one", F.lit(1)), "one").drop("one")


def _top_events(events: DataFrame, series: str, top: int) -> DataFrame:
    best = events.filter("is_anomaly").orderBy(F.desc("distance"), series, "ts").limit(top)
    return best.select(
        series, F.date_format("ts", "MM-dd HH:mm").alias("ts"), F.col("kwh").cast("decimal(12,1)").alias("kwh"),
        F.round("forecast", 1).alias("forecast"), F.round("upper_bound", 1).alias("upper_bound"),
        F.round("distance", 3).alias("distance"),
    )


def top_feeder_anomalies(m: Marts, top: int = 15) -> DataFrame:
    return _top_events(m.feeder_events, "feeder_id", top)


def top_meter_anomalies(m: Marts, top: int = 15) -> DataFrame:
    return _top_events(m.meter_events, "meter_id", top)


def anomaly_board(m: Marts, top: int = 50) -> DataFrame:
    return m.feeder_events.filter("is_anomaly").orderBy(F.desc("distance"), "feeder_id", "ts").limit(top).select(
        "feeder_id", "ts", "kwh", "forecast", "lower_bound", "upper_bound", "distance"
    )


def anomalies_per_day(m: Marts) -> DataFrame:
    return m.feeder_events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(F.col("is_anomaly")).alias("anomalies")
    ).orderBy(F.desc("day"))


def forecast_band(m: Marts, feeder: str = "FDR-00002", hours: int = 168) -> DataFrame:
    newest = m.feeder_events.filter(F.col("feeder_id") == feeder).orderBy(F.desc("ts")).limit(hours)
    return newest.orderBy("ts").select(
        F.date_format("ts", "MM-dd HH:mm").alias("ts"), F.col("kwh").cast("decimal(14,2)").alias("kwh"),
        F.round("forecast", 2).alias("forecast"), F.round("lower_bound", 2).alias("lower"),
        F.round("upper_bound", 2).alias("upper"), "is_anomaly", F.round("distance", 3).alias("distance"),
        F.when(F.col("is_anomaly"), F.col("kwh").cast("decimal(14,2)")).alias("anomaly_kwh"),
    )


def model_card(m: Marts) -> DataFrame:
    return anomaly.model_card(m.feeder_events, m.feeder_training, "feeder_id", "feeder_seasonal").unionByName(
        anomaly.model_card(m.meter_events, m.meter_training, "meter_id", "commercial_meter_seasonal")
    )


def anomaly_summary(m: Marts) -> DataFrame:
    return m.feeder_events.agg(
        n_rows().alias("scored_rows"), F.count_if(F.col("is_anomaly")).alias("anomalies"),
        _average(F.col("distance").cast("decimal(18,6)"), 3).alias("avg_distance"),
        F.round(F.max("distance"), 3).alias("max_distance"),
    )


def xfm_attribution(m: Marts, top: int = 25) -> DataFrame:
    return m.attribution.orderBy(F.desc_nulls_last("est_dollar_exposure"), "transformer_id").limit(top)


def anomaly_exposure(m: Marts, top: int = 15) -> DataFrame:
    return anomaly.exposure(m.feeder_events, "feeder_id").orderBy(
        F.desc("distance"), "feeder_id", "ts"
    ).limit(top)


# -- network --------------------------------------------------------------------------------------


def xfm_summary(m: Marts) -> DataFrame:
    return m.feed.transformers.agg(
        n_rows().alias("xfm_count"), F.countDistinct("feeder_id").alias("feeder_count"),
        F.sum("kva_rating").alias("total_kva"),
    )


def xfm_top_loaded(m: Marts, top: int = 25) -> DataFrame:
    days = m.daily_between(m.day(30), m.anchor)
    loaded = topology.transformer_load(days, m.placed, m.feed.transformers)
    return loaded.select(
        "transformer_id", "feeder_id", F.col("kva_rating").alias("kva"), "meters",
        F.col("kwh_30d").cast("decimal(14,2)").alias("kwh_30d"),
        F.col("peak_kw").cast("decimal(12,2)").alias("peak_kw"), "load_factor_pct",
    ).orderBy(F.desc_nulls_last("load_factor_pct"), "transformer_id").limit(top)


def xfm_by_territory(m: Marts) -> DataFrame:
    return m.feed.transformers.join(m.feed.feeders.select("feeder_id", "utility_territory"), "feeder_id").groupBy(
        F.col("utility_territory").alias("territory")
    ).agg(
        n_rows().alias("xfm_count"), F.sum("kva_rating").alias("total_kva"),
        F.count_if(F.col("phase") == "THREE").alias("three_phase"),
    ).orderBy("territory")


def substation_feeders(m: Marts) -> DataFrame:
    return topology.substation_feeders(m.feed.substations, m.feed.feeders)


def feeder_health(m: Marts) -> DataFrame:
    """Position and completeness of every feeder; callers page, the query does not cut."""
    return _completeness(m).join(m.feed.feeders.select("feeder_id", "utility_territory"), "feeder_id").select(
        "feeder_id", F.col("utility_territory").alias("territory"), "lat", "lon", "meters", "completeness_pct"
    )


# -- events, runs ---------------------------------------------------------------------------------


def events_summary(m: Marts) -> DataFrame:
    return m.feed.meter_events.groupBy("event_type").agg(n_rows().alias("count")).orderBy(
        F.desc("count"), "event_type"
    )


def events_recent(m: Marts, days: int = 7, top: int = 100) -> DataFrame:
    """The newest events of the last ``days`` (1, 7, 30 or 90 on the page), payload as text."""
    newest = m.feed.meter_events.filter(F.col("event_ts") >= ntz(m.day(days))).orderBy(
        F.desc("event_ts"), F.desc("event_id")
    ).limit(top)
    return newest.select(
        "event_id", "meter_id", "event_type", F.date_format("event_ts", "yyyy-MM-dd HH:mm").alias("event_ts"),
        F.col("payload_text").alias("event_payload"),
    )


def refresh_history(m: Marts) -> DataFrame:
    """Runs of refresh jobs and stream batches of the last seven days."""
    return quality.refresh_history(m.runs, m.now, 7)


def latest_refresh(m: Marts) -> DataFrame:
    recent = quality.refresh_history(m.runs, m.now, 3)
    return quality.latest_per_name(recent).orderBy("name").select(
        "name", "schema_name", "state", F.date_format("end_time", "MM-dd HH:mm").alias("last_refresh"), "duration_sec",
        "refresh_action", "rows_processed",
    )


def audit_recent(m: Marts, top: int = 30) -> DataFrame:
    return m.runs.orderBy(F.desc("start_time"), "run_id").limit(top).select(
        "pipeline_name", F.date_format("start_time", "MM-dd HH:mm").alias("start_time"), "status",
        "rows_processed", "error_count", "message",
    )


# -- edge cases -----------------------------------------------------------------------------------


def _partial(m: Marts) -> DataFrame:
    day_back = m.last_slot - dt.timedelta(days=1)
    return edge.partial_meters(m.reads_between(day_back, m.span[1]), m.feed.lookup.meters, ntz(m.last_slot), m.per_day)


def partial_meters(m: Marts, top: int = 25) -> DataFrame:
    return _partial(m).orderBy("intervals_24h", "meter_id").limit(top)


def edge_kpi(m: Marts) -> DataFrame:
    day_back, week_back = m.last_slot - dt.timedelta(days=1), m.last_slot - dt.timedelta(days=7)
    severe = F.col("intervals_24h") * 2 < m.per_day
    partial = _partial(m).agg(
        n_rows().alias("partial_meters_24h"), F.count_if(severe).alias("severe_meters_24h")
    )
    week = m.reads_between(week_back, m.span[1])
    status = F.col("vee_status")
    n = F.col("n_channels")
    rows = channel_rows(week, m.feed.lookup.meters).agg(
        *[F.coalesce(F.sum(F.when(status == s, n)), F.lit(0)).alias(f"{s.lower()}_7d") for s in ("ESTIMATED", "FAILED")]
    )
    copies = m.duplicates.agg(n_rows().alias("duplicates_resolved"))
    wrong = m.mismatches.agg(n_rows().alias("mapping_issues"))
    out = partial.withColumn("one", F.lit(1))
    for part in (copies, rows, wrong):
        out = out.join(part.withColumn("one", F.lit(1)), "one")
    return out.drop("one")


def lag_histogram(m: Marts) -> DataFrame:
    return edge.lag_histogram(m.counted_channels).orderBy("bucket")


def duplicate_sample(m: Marts, top: int = 25) -> DataFrame:
    newest = m.duplicates.orderBy(F.desc("read_ts"), "meter_id").limit(top)
    return newest.select(
        "duplicate_id", "meter_id", "utility_territory", "read_ts", "value_first", "value_second",
        F.date_format("received_first", "MM-dd HH:mm").alias("received_first"),
        F.date_format("received_second", "MM-dd HH:mm").alias("received_second"), "gap_min", "resolution",
    )


def duplicate_summary(m: Marts) -> DataFrame:
    delta = F.abs(F.col("value_second") - F.col("value_first"))
    return m.duplicates.agg(
        n_rows().alias("total"), _average(F.col("gap_min"), 1).alias("avg_gap_min"),
        _average(delta, 3).alias("avg_delta"),
    )


def vee_distribution(m: Marts) -> DataFrame:
    return m.counted_channels.groupBy(F.col("vee_status").alias("status")).agg(F.sum("n_channels").alias("n"))


def vee_trend(m: Marts) -> DataFrame:
    since = m.last_slot - dt.timedelta(days=14)
    rows = channel_rows(m.reads_between(since, m.span[1]), m.feed.lookup.meters)
    status, n = F.col("vee_status"), F.col("n_channels")
    return rows.groupBy(F.to_date("read_ts").alias("day")).agg(
        *[F.coalesce(F.sum(F.when(status == s, n)), F.lit(0)).alias(s.lower()) for s in ("VALID", "ESTIMATED", "FAILED")]
    ).orderBy("day").select(F.date_format("day", "MM-dd").alias("d"), "valid", "estimated", "failed")


def estimation_methods(m: Marts) -> DataFrame:
    return m.counted_channels.filter(F.col("estimation_method").isNotNull()).groupBy(
        F.col("estimation_method").alias("method")
    ).agg(F.sum("n_channels").alias("n")).orderBy(F.desc("n"))


def premise_mismatch_report(m: Marts, top: int = 25) -> DataFrame:
    """The clearest mismatches; the mart holds all of them, the window below sees ``top`` rows."""
    where = m.placed.select("meter_id", "utility_territory", "feeder_id")
    best = m.mismatches.orderBy(F.desc("separation"), "meter_id").limit(top)
    rank = F.row_number().over(Window.orderBy(F.desc("separation"), "meter_id"))
    return best.withColumn("rank", rank).join(where, "meter_id", "left").select(
        "rank", "meter_id", "current_type", "suggested_type", "avg_eve_kwh", "avg_day_kwh", "avg_night_kwh",
        "avg_overall", "confidence", F.col("utility_territory").alias("territory"), "feeder_id",
    )


# -- dashboard and validation ---------------------------------------------------------------------


def reads_per_hour(m: Marts) -> DataFrame:
    reads = m.reads_between(m.end_of_anchor(7), m.span[1])
    return reads.groupBy(hour_floor("read_ts").alias("hr"), "utility_territory").agg(
        n_rows().alias("reads")
    ).orderBy("hr", "utility_territory")


def sla_heatmap(m: Marts) -> DataFrame:
    return m.sla.select(
        "date_key", "utility_territory", "pct_arrived_within_15min", "late_arrival_count", "max_ingestion_lag_min"
    ).orderBy(F.desc("date_key"), "utility_territory")


def vee_pass_trend(m: Marts) -> DataFrame:
    return m.dq.select(
        "date_key", "utility_territory", "vee_pass_rate", "estimated_intervals", "failed_intervals",
        "completeness_pct",
    ).orderBy(F.desc("date_key"), "utility_territory")


def _counts(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        one = df.agg(n_rows().alias(name)).withColumn("one", F.lit(1))
        out = one if out is None else out.join(one, "one")
    return out.drop("one")


def dim_counts(m: Marts) -> DataFrame:
    f = m.feed
    return _counts({
        "substations": f.substations, "feeders": f.feeders, "transformers": f.transformers,
        "service_points": f.service_points, "meters": f.meters, "customers": f.customers,
        "time_dim_rows": m.calendar, "billing_periods": m.cycles,
    })


def interval_volume(m: Marts) -> DataFrame:
    """Reads against what every reporting meter should have sent over the days of the data."""
    days = (m.anchor - m.first_day).days + 1
    per_meter = m.reads.groupBy("meter_id").agg(n_rows().alias("n"))
    total = F.sum("n")
    return per_meter.agg(
        total.alias("interval_rows"), pct(total, F.lit(m.per_day * days) * n_rows()).alias("pct_of_target")
    )


def vee_share(m: Marts) -> DataFrame:
    """Share of each status; the window runs over one row per status."""
    counted = m.reads.groupBy("vee_status").agg(n_rows().alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(1)))
    return counted.select("vee_status", "rows", pct(F.col("rows"), total).alias("pct"))


def exposure_total(m: Marts) -> DataFrame:
    """Exposure over all flagged hours, which the top list shows only a part of."""
    return anomaly.exposure(m.feeder_events, "feeder_id").agg(
        n_rows().alias("flagged_hours"), F.sum("exposure").alias("exposure")
    )


def rollup_counts(m: Marts) -> DataFrame:
    return _counts({"hourly": m.hourly, "daily": m.daily, "monthly": m.monthly})


def obs_spot_check(m: Marts) -> DataFrame:
    day = m.day(1)
    both = quality.unified(m.sla_between(day, day), m.dq_between(day, day))
    return both.select(
        "date_key", "utility_territory", "pct_arrived_within_15min", "vee_pass_rate", "completeness_pct"
    ).orderBy("utility_territory")


def stream_counts(m: Marts) -> DataFrame:
    raw = m.feed.arrivals.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("raw_rows")).withColumn("one", F.lit(1))
    kept = m.reads.agg(n_rows().alias("dt_rows")).withColumn("one", F.lit(1))
    return raw.join(kept, "one").drop("one")
