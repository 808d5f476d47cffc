"""Every query by name: operators over their whole input, marts, and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loadweave.functions import to_report_types
from loadweave.operators import (
    anomaly, calendar, channels, distinct, edge, governance, ingest, priority, quality, tariff, topology, tou,
)
from loadweave.plans import reports
from loadweave.plans.lattice import Lattice, standard_lattice
from loadweave.plans.marts import Marts, ntz
from loadweave.plans.metrics import standard_model
from loadweave.plans.stored import StoredMarts
from loadweave.session import fresh_folder
from loadweave.sources import tables
from loadweave.streaming import hot, pipeline, refresh
from loadweave.streaming.delta import DeltaMarts
from loadweave.streaming.progress import ProgressLog

Query = Callable[[Marts], DataFrame]
CATALOG: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        CATALOG[name] = fn
        return fn

    return register


for _name in (
    "ingestion_kpi", "ingestion_hourly", "ingestion_sla", "dq_daily", "worst_feeders", "worst_feeders_rolling",
    "billing_stats", "billing_trend", "billing_by_period", "billing_ready_by_start", "worst_unready",
    "tou_bucket_totals", "tou_daily_revenue", "tou_implied_rate", "anomaly_kpi", "top_feeder_anomalies",
    "top_meter_anomalies", "anomaly_board", "anomalies_per_day", "forecast_band", "model_card",
    "anomaly_summary", "xfm_attribution", "anomaly_exposure", "exposure_total", "xfm_summary", "xfm_top_loaded",
    "xfm_by_territory", "substation_feeders", "feeder_health", "events_summary", "events_recent",
    "edge_kpi", "partial_meters", "lag_histogram",
    "duplicate_sample", "duplicate_summary", "vee_distribution", "vee_trend", "estimation_methods",
    "premise_mismatch_report", "reads_per_hour", "sla_heatmap", "vee_pass_trend", "dim_counts",
    "interval_volume", "vee_share", "rollup_counts", "obs_spot_check", "stream_counts",
):
    CATALOG[_name] = getattr(reports, _name)

READ_COLUMNS = [
    "meter_id", "read_ts", "read_local_ts", "kwh_delivered", "kwh_received", "demand_kw", "voltage_v",
    "quality_flag", "vee_status", "estimation_method", "utility_territory", "source_file", "ingested_at",
    "ingestion_lag_sec",
]

ROLLUP_COLUMNS = [
    "rollup_grain", "meter_id", "rollup_ts", "utility_territory", "kwh_delivered", "kwh_net", "max_demand_kw",
    "source_interval_count", "completeness_pct", "vee_pass_pct",
]

# -- sources and sinks ----------------------------------------------------------------------------


def _payload_view(raw: DataFrame) -> DataFrame:
    get = lambda name, kind: F.variant_get("raw_payload", f"$.{name}", kind).alias(name)
    return raw.select(
        get("meter_id", "string"), get("read_ts", "string"), get("kwh_delivered", "decimal(14,4)"),
        get("vee_status", "string"), "source_file", "schema_version", "ingested_at",
    )


@query("raw_landing")
def raw_landing(m: Marts) -> DataFrame:
    return _payload_view(ingest.land(m.feed.payloads))


@query("file_landing")
def file_landing(m: Marts) -> DataFrame:
    """JSON lines in one folder per source, read back as a batch."""
    path = fresh_folder(m.spark, "stage")
    m.feed.payloads.select(F.col("payload_text").alias("value"), "source_file").hint(
        "rebalance", "source_file"
    ).write.partitionBy("source_file").text(path)
    lines = m.spark.read.text(path).select(
        F.col("value").alias("payload_text"), "source_file", F.localtimestamp().alias("ingested_at")
    )
    return _payload_view(ingest.land(lines)).drop("ingested_at")


@query("ingest_append")
def ingest_append(m: Marts) -> DataFrame:
    """The same files as a stream, appended to the raw table batch by batch."""
    work = fresh_folder(m.spark, "append")
    m.feed.payloads.select(F.col("payload_text").alias("value"), "source_file").hint(
        "rebalance", "source_file"
    ).write.partitionBy("source_file").text(f"{work}/drop")
    stream = pipeline.text_stream(m.spark, f"{work}/drop")
    pipeline.append_stream(stream, f"{work}/raw", f"{work}/checkpoint")
    landed = ingest.land(m.spark.read.parquet(f"{work}/raw"))
    return _payload_view(landed).groupBy("meter_id", "vee_status").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("kwh_delivered").alias("kwh")
    )


@query("meter_event_log")
def meter_event_log(m: Marts) -> DataFrame:
    return m.feed.meter_events.select(
        "event_id", "meter_id", "event_ts", "event_type",
        F.variant_get("event_payload", "$.k", "bigint").alias("payload_k"),
    )


@query("channel_catalog")
def channel_catalog(m: Marts) -> DataFrame:
    """The catalogue with the number of meters that carry each channel."""
    used = m.meter_channels.groupBy("channel_code").agg(F.count(F.lit(1)).alias("meters"))
    return m.catalog.join(used, "channel_code", "left").withColumn("meters", F.coalesce("meters", F.lit(0)))


@query("feeder_snapshot")
def feeder_snapshot(m: Marts) -> DataFrame:
    return tables.snapshot(m.feeder_recent, fresh_folder(m.spark, "feeder-recent"))


@query("shared_billing")
def shared_billing(m: Marts) -> DataFrame:
    return governance.published_billing(m.consumption, role="ANALYST_NE")


@query("shared_daily_kwh")
def shared_daily_kwh(m: Marts) -> DataFrame:
    return governance.published_daily(m.daily)


@query("shared_anomalies")
def shared_anomalies(m: Marts) -> DataFrame:
    return governance.published_anomalies(m.feeder_events)


# -- conforming -----------------------------------------------------------------------------------


@query("normalize_reads")
def normalize_reads(m: Marts) -> DataFrame:
    landed = ingest.land(m.feed.payloads)
    return ingest.latest_reads(landed, m.feed.lookup.meters, ["ingested_at", "event_id"]).select(*READ_COLUMNS)


@query("quarantined_reads")
def quarantined_reads(m: Marts) -> DataFrame:
    """Landed reads the register of occupied premises does not know, by meter."""
    occupied = m.feed.accounts.filter(~F.col("is_vacant")).select("meter_id")
    held = ingest.quarantine(ingest.land(m.feed.payloads), occupied)
    return held.groupBy("meter_id", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query("canonical_reads")
def canonical_reads(m: Marts) -> DataFrame:
    return m.reads.select(*READ_COLUMNS)


@query("local_time")
def local_time(m: Marts) -> DataFrame:
    return m.reads.select("meter_id", "read_ts", "read_local_ts")


@query("ingestion_lag")
def ingestion_lag(m: Marts) -> DataFrame:
    return m.feed.transmitted.select("event_id", "meter_id", "read_ts", "ingestion_lag_sec")


@query("lww_dedup")
def lww_dedup(m: Marts) -> DataFrame:
    return m.reads.select("meter_id", "read_ts", "event_id", "kwh_delivered", "ingested_at")


@query("unpivot_channels")
def unpivot_channels(m: Marts) -> DataFrame:
    return m.channel_reads.select(
        "meter_id", "channel_id", "channel_code", "read_ts", "value", "uom", "quality_flag", "vee_status",
        "estimation_method", "utility_territory", "ingestion_lag_sec",
    )


@query("wide_view")
def wide_view(m: Marts) -> DataFrame:
    return channels.pivot_wide(m.channel_reads)


@query("meter_channels")
def meter_channels(m: Marts) -> DataFrame:
    return m.meter_channels


@query("meter_link")
def meter_link(m: Marts) -> DataFrame:
    return m.feed.links


@query("conform_meter")
def conform_meter(m: Marts) -> DataFrame:
    return m.feed.meters


@query("conform_customer")
def conform_customer(m: Marts) -> DataFrame:
    return m.feed.customers


@query("topology")
def meter_topology(m: Marts) -> DataFrame:
    return m.topology


@query("time_dim")
def time_dim(m: Marts) -> DataFrame:
    """The calendar of the data's months, with the number of reads in each slot."""
    used = m.reads.groupBy(F.col("read_ts").alias("ts_utc")).agg(F.count(F.lit(1)).alias("reads"))
    return m.calendar.join(used, "ts_utc", "left").withColumn("reads", F.coalesce("reads", F.lit(0)))


@query("billing_periods")
def billing_periods(m: Marts) -> DataFrame:
    return m.periods


@query("load_profile")
def load_profile(m: Marts) -> DataFrame:
    kinds = m.feed.lookup.meters.select("meter_id", "meter_type", "has_der")
    rows = m.reads.select("meter_id", "read_ts", "kwh_delivered").join(calendar.load_scale(kinds), "meter_id")
    return calendar.expected_load(rows).select(
        "meter_id", "read_ts", "kwh_delivered", "expected_kwh", "expected_kwh_received", "expected_kw"
    )


@query("data_anchor")
def data_anchor(m: Marts) -> DataFrame:
    return m.feed.events.agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("max_date"))


@query("sample_reads")
def sample_reads(m: Marts) -> DataFrame:
    """The sampling operator: a repeatable one percent of the reads, by hashed event."""
    return ingest.sample_by_key(m.reads, "event_id", 1.0).select("meter_id", "read_ts", "event_id")


@query("sample_per_territory")
def sample_per_territory(m: Marts) -> DataFrame:
    """Exactly forty reads of each territory, always the same ones."""
    return ingest.sample_rows(m.reads, "event_id", 40, ["utility_territory"]).select("utility_territory", "meter_id", "read_ts", "event_id")


# -- marts ----------------------------------------------------------------------------------------


@query("hourly_rollup")
def hourly_rollup(m: Marts) -> DataFrame:
    return m.hourly


@query("daily_rollup")
def daily_rollup(m: Marts) -> DataFrame:
    return m.daily


@query("monthly_rollup")
def monthly_rollup(m: Marts) -> DataFrame:
    return m.monthly


@query("channel_hourly")
def channel_hourly(m: Marts) -> DataFrame:
    return m.channel_hourly


@query("channel_daily")
def channel_daily(m: Marts) -> DataFrame:
    return m.channel_daily


@query("tou_tagged")
def tou_tagged(m: Marts) -> DataFrame:
    return m.tagged


@query("tou_tagged_local")
def tou_tagged_local(m: Marts) -> DataFrame:
    return m.tagged_local


@query("charge_line")
def charge_line(m: Marts) -> DataFrame:
    return m.charges


@query("billing_consumption")
def billing_consumption(m: Marts) -> DataFrame:
    return m.consumption


@query("billing_recon")
def billing_recon(m: Marts) -> DataFrame:
    return m.reconciliation


@query("sla_metrics")
def sla_metrics(m: Marts) -> DataFrame:
    return m.sla


@query("dq_metrics")
def dq_metrics(m: Marts) -> DataFrame:
    return m.dq


@query("obs_dashboard")
def obs_dashboard(m: Marts) -> DataFrame:
    return m.observability


@query("sla_breach")
def sla_breach(m: Marts) -> DataFrame:
    """Alert rows of the anchor day; the threshold is the sample's, where about 98% arrive in time."""
    day = F.lit(str(m.anchor)).cast("date")
    return quality.breach_alerts(m.sla_between(m.anchor, m.anchor), day, threshold=99.0)


@query("table_metrics")
def table_metrics(m: Marts) -> DataFrame:
    return quality.table_metrics({"raw": m.feed.arrivals, "canonical": m.reads}, ntz(m.end_of_anchor()))


@query("run_audit")
def run_audit(m: Marts) -> DataFrame:
    """Materialise the hourly rollup under the run log and return the log."""
    work = fresh_folder(m.spark, "audit")
    log = quality.RunLog(m.spark, f"{work}/log")

    def job() -> int:
        return tables.snapshot(m.hourly, f"{work}/hourly").count()

    log.run("HOURLY_ROLLUP", job)
    return log.read().select("pipeline_name", "status", "rows_processed", "error_count")


@query("feeder_load")
def feeder_load(m: Marts) -> DataFrame:
    return topology.feeder_load(m.reads, m.placed)


@query("feeder_training")
def feeder_training(m: Marts) -> DataFrame:
    return m.feeder_training


@query("anomaly_baseline")
def anomaly_baseline(m: Marts) -> DataFrame:
    return m.feeder_baseline


@query("feeder_anomalies")
def feeder_anomalies(m: Marts) -> DataFrame:
    return m.feeder_events


@query("meter_anomalies")
def meter_anomalies(m: Marts) -> DataFrame:
    return m.meter_events


@query("anomaly_events")
def anomaly_events(m: Marts) -> DataFrame:
    """Scores upserted twice, as two overlapping passes would: still one row per feeder and hour."""
    work = fresh_folder(m.spark, "scores")
    frozen = tables.snapshot(m.feeder_events, f"{work}/scored")
    for _ in range(2):
        refresh.score_pass(frozen, f"{work}/events", f"{work}/staging", "feeder_id")
    return m.spark.read.parquet(f"{work}/events").select(*frozen.columns)


@query("score_pass")
def score_pass(m: Marts) -> DataFrame:
    work = fresh_folder(m.spark, "score-pass")
    refresh.score_pass(m.meter_events, f"{work}/events", f"{work}/staging", "meter_id")
    return m.spark.read.parquet(f"{work}/events").select(
        "meter_id", "ts", "kwh", "forecast", "is_anomaly", "distance"
    )


@query("duplicate_audit")
def duplicate_audit(m: Marts) -> DataFrame:
    return m.duplicates


@query("load_shape")
def load_shape(m: Marts) -> DataFrame:
    return m.week_shape


@query("premise_mismatch")
def premise_mismatch(m: Marts) -> DataFrame:
    return m.ranked_mismatches


# -- streaming ------------------------------------------------------------------------------------


def _landed_stream(
    m: Marts, work: str, files_per_batch: int | None = pipeline.FILES_PER_BATCH, payloads: DataFrame | None = None,
) -> DataFrame:
    """Bronze on disk, then a stream of typed reads over it in batches of a fixed number of files."""
    pipeline.land_bronze(m.feed.payloads if payloads is None else payloads, f"{work}/bronze")
    meters = m.feed.lookup.meters.select("meter_id", "utility_territory", "timezone")
    return pipeline.normalised_stream(pipeline.bronze_stream(m.spark, f"{work}/bronze", files_per_batch), meters)


@query("stream_normalize")
def stream_normalize(m: Marts) -> DataFrame:
    work = fresh_folder(m.spark, "stream-normalize")
    pipeline.append_stream(_landed_stream(m, work), f"{work}/typed", f"{work}/checkpoint")
    return m.spark.read.parquet(f"{work}/typed").select("event_id", *READ_COLUMNS)


@query("stream_lww")
def stream_lww(m: Marts) -> DataFrame:
    work = fresh_folder(m.spark, "stream-lww")
    pipeline.changelog(pipeline.stateful_lww(_landed_stream(m, work)), f"{work}/log", f"{work}/checkpoint")
    return pipeline.current(m.spark, f"{work}/log", pipeline.READ_KEYS).select(*READ_COLUMNS)


@query("stream_hot")
def stream_hot(m: Marts) -> DataFrame:
    """Merged behind state that forgets a slot as soon as the next batch begins: what is late is merged, not ignored."""
    work = fresh_folder(m.spark, "stream-hot")
    pipeline.keep_state_on_disk(m.spark)
    passed = hot.newest_only(_landed_stream(m, work), hold_ms=0)
    pipeline.merge_stream(passed, f"{work}/canonical", f"{work}/merge")
    return m.spark.read.parquet(f"{work}/canonical").select(*READ_COLUMNS)


@query("late_upsert")
def late_upsert(m: Marts) -> DataFrame:
    work = fresh_folder(m.spark, "late-upsert")
    pipeline.merge_stream(_landed_stream(m, work), f"{work}/canonical", f"{work}/merge")
    return m.spark.read.parquet(f"{work}/canonical").select(*READ_COLUMNS)


@query("stream_hourly")
def stream_hourly(m: Marts) -> DataFrame:
    work = fresh_folder(m.spark, "stream-hourly")
    pipeline.changelog(pipeline.windowed_load(_landed_stream(m, work)), f"{work}/log", f"{work}/checkpoint")
    return pipeline.current(m.spark, f"{work}/log", ["meter_id", "utility_territory", "hour"])


@query("incremental_refresh")
def incremental_refresh(m: Marts) -> DataFrame:
    """Rollups refreshed batch by batch behind the merge, day and month rows together."""
    work = fresh_folder(m.spark, "incremental")
    marts = refresh.MartTables(m.spark, f"{work}/marts", m.per_hour, m.per_day)
    pipeline.merge_stream(_landed_stream(m, work), marts.canonical, f"{work}/merge", marts.refresh)
    return marts.read("daily").select(*ROLLUP_COLUMNS).unionByName(marts.read("monthly").select(*ROLLUP_COLUMNS))


def _tables(m: Marts, root: str, *wider: str, kind: type[refresh.MartTables] = refresh.MartTables) -> refresh.MartTables:
    """Empty mart tables below a folder, which will keep the rollups and the named wider marts."""
    f = m.feed
    dims = refresh.Dimensions(
        f.lookup.meters, channels.instantiate_channels(f.lookup.meters, m.catalog), f.lookup.links,
        f.lookup.customers, m.windows, m.known_cycles.drop("meter_no", "meter_id"),
    )
    return kind(m.spark, root, m.per_hour, m.per_day, dims, wider=wider)


def _delta_marts(m: Marts) -> DeltaMarts:
    """Rollups and billing periods that took the changes of each batch of a stream."""
    work = fresh_folder(m.spark, "delta")
    marts = _tables(m, f"{work}/marts", "billing", kind=DeltaMarts)
    pipeline.merge_stream(_landed_stream(m, work, 16), marts.canonical, f"{work}/merge", on_changes=marts.take)
    return marts


@query("delta_refresh")
def delta_refresh(m: Marts) -> DataFrame:
    """Day and month rows of marts that are never computed from their reads, but take what each batch changes."""
    marts = _delta_marts(m)
    return marts.read("daily").select(*ROLLUP_COLUMNS).unionByName(marts.read("monthly").select(*ROLLUP_COLUMNS))


@query("delta_billing")
def delta_billing(m: Marts) -> DataFrame:
    return _delta_marts(m).read("billing").drop("part_date")


def _filled(m: Marts) -> DeltaMarts:
    """Tables whose gaps were filled by estimates on a day on which some reads had still to come.

    Reads that arrived before the cut are merged, the three days before it are completed with estimates, then the later
    arrivals are merged: an actual replaces an estimate, whatever is newer.
    """
    work, cut = fresh_folder(m.spark, "filled"), m.day(3)
    marts = _tables(m, f"{work}/marts", "charges", kind=DeltaMarts)
    newest = [ingest.precedence(), *pipeline.NEWEST]
    early = F.col("ingested_at") < ntz(cut)

    def merge(payloads: DataFrame) -> None:
        stream = _landed_stream(m, work, None, payloads)
        pipeline.merge_stream(stream, marts.canonical, f"{work}/merge", newest=newest, on_changes=marts.take)

    merge(m.feed.payloads.filter(early))
    first, last = m.day(6), m.day(4)
    known = marts.read("canonical").filter(F.col("read_date").between(F.lit(first), F.lit(last)))
    estimates = edge.gap_fill(known, m.feed.meters.dropDuplicates(["meter_id"]), str(first), str(last))
    pipeline.store_estimates(marts.canonical, estimates, ntz(cut), f"{work}/estimates", newest, marts.take, unique=True, span=3)
    merge(m.feed.payloads.filter(~early))
    return marts


@query("filled_reads")
def filled_reads(m: Marts) -> DataFrame:
    """What the table holds per meter and day after gaps were filled and late reads came in."""
    made = F.col("source_file") == edge.GAP_FILL
    return _filled(m).read("canonical").groupBy("meter_id", "read_date").agg(
        F.count(F.lit(1)).alias("reads"), F.count_if(made).alias("filled"),
        F.count_if((F.col("vee_status") == "ESTIMATED") & ~made).alias("sent_estimates"), F.sum("kwh_delivered").alias("kwh_delivered"),
    )


@query("filled_daily")
def filled_daily(m: Marts) -> DataFrame:
    return _filled(m).read("daily").select(*ROLLUP_COLUMNS)


@query("filled_charges")
def filled_charges(m: Marts) -> DataFrame:
    return tou.charges_by(_filled(m).read("charges"), F.to_date("read_ts").alias("charge_date"), "tou_bucket")


def _logged(m: Marts) -> StoredMarts:
    """Tables kept by a stream that was drained twice, a week before the last day and after it, under the run log."""
    work = fresh_folder(m.spark, "logged")
    marts = _tables(m, f"{work}/marts")
    marts.log = quality.RunLog(m.spark, f"{work}/run-log")
    listener = ProgressLog(quality.RunLog(m.spark, f"{work}/run-log", "RAW"))
    m.spark.streams.addListener(listener)
    early = F.col("ingested_at") < ntz(m.day(7))
    try:
        for part in (early, ~early):
            stream = _landed_stream(m, work, None, m.feed.payloads.filter(part))
            listener.wait(pipeline.merge_stream(
                stream, marts.canonical, f"{work}/merge", marts.refresh, name="READS_TO_CANONICAL", log=marts.log,
            ))
    finally:
        m.spark.streams.removeListener(listener)
    return StoredMarts(m.spark, marts, m.feed)


@query("refresh_history")
def refresh_history(m: Marts) -> DataFrame:
    """Every run and stream batch of a log that a stream and its refresh jobs wrote, without what a clock says."""
    return reports.refresh_history(_logged(m)).select(
        "name", "schema_name", "state", "refresh_action", "batch_id", "rows_processed", "state_rows",
        (F.col("duration_sec") >= 0).alias("is_timed"),
    )


@query("latest_refresh")
def latest_refresh(m: Marts) -> DataFrame:
    return reports.latest_refresh(_logged(m)).select("name", "schema_name", "state", "refresh_action", "rows_processed")


@query("audit_recent")
def audit_recent(m: Marts) -> DataFrame:
    return reports.audit_recent(_logged(m)).drop("start_time")


def _refreshed(m: Marts, wider: str, mart: str) -> DataFrame:
    """A mart kept current behind the merge of a stream."""
    work = fresh_folder(m.spark, f"refreshed-{mart}")
    marts = _tables(m, f"{work}/marts", wider)
    pipeline.merge_stream(_landed_stream(m, work), marts.canonical, f"{work}/merge", marts.refresh)
    return marts.read(mart).drop("part_date")


for _wider, _table, _name in (
    ("billing", "billing", "refreshed_billing"), ("channels", "channel_daily", "refreshed_channels"),
    ("charges", "charges", "refreshed_charges"), ("sla", "sla", "refreshed_sla"), ("dq", "dq", "refreshed_dq"),
):
    CATALOG[_name] = lambda m, wider=_wider, table=_table: _refreshed(m, wider, table)


@query("refresh_log")
def refresh_log(m: Marts) -> DataFrame:
    """What the refresh jobs logged while all marts were built: the newest run of each."""
    marts = _tables(m, fresh_folder(m.spark, "logged-marts"), *refresh.WIDER)
    marts.log = quality.RunLog(m.spark, f"{marts.root}/run-log")
    marts.build(m.reads)
    now = F.current_timestamp().cast("timestamp_ntz") + F.expr("interval 1 day")
    runs = quality.latest_per_name(quality.refresh_history(marts.log.read(), now, 2))
    return runs.select("name", "state", "rows_processed")


def _stored(m: Marts, *wider: str) -> StoredMarts:
    """The reports' graph over tables built from canonical reads."""
    marts = _tables(m, fresh_folder(m.spark, "stored-marts"), *wider)
    marts.build(m.reads)
    return StoredMarts(m.spark, marts, m.feed)


def _scored(m: Marts) -> StoredMarts:
    """Stored tables with the scores of a pass; reports on anomalies read those and fit nothing."""
    kept = _stored(m)
    kept.stored.score("feeder_scores", kept.feeder_events, "feeder_id")
    kept.stored.score("meter_scores", kept.meter_events, "meter_id")
    return StoredMarts(m.spark, kept.stored, m.feed)


for _report in ("anomaly_kpi", "top_feeder_anomalies", "top_meter_anomalies", "anomalies_per_day", "xfm_attribution"):
    CATALOG[f"scored_{_report}"] = lambda m, report=_report: getattr(reports, report)(_scored(m))
CATALOG["stored_billing_stats"] = lambda m: reports.billing_stats(_stored(m, "billing"))
CATALOG["stored_xfm_attribution"] = lambda m: reports.xfm_attribution(_stored(m))
CATALOG["stored_metric_by_territory"] = lambda m: metric_by_territory(_stored(m, "charges"))


@query("channel_backfill")
def channel_backfill(m: Marts) -> DataFrame:
    """The channel backfill of the whole span, run twice, counted per channel and day."""
    path = f"{fresh_folder(m.spark, 'channels')}/channel_reads"
    for _ in range(2):
        refresh.backfill_channels(m.reads, m.feed.lookup.meters, path, m.first_day, m.anchor)
    return m.spark.read.parquet(path).groupBy("channel_code", "read_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").alias("value")
    )


# -- governance and metrics -----------------------------------------------------------------------


@query("row_policy")
def row_policy(m: Marts) -> DataFrame:
    return governance.apply_row_policy(m.reads, "ANALYST_NE", m.roles).select(
        "meter_id", "read_ts", "utility_territory", "kwh_delivered"
    )


@query("row_policy_meters")
def row_policy_meters(m: Marts) -> DataFrame:
    """The same policy on the meters themselves."""
    return governance.apply_row_policy(m.feed.meters, "ANALYST_NE", m.roles).select("meter_id", "meter_type", "utility_territory")


@query("mask_account")
def mask_account(m: Marts) -> DataFrame:
    return governance.mask_column(m.feed.customers, "cis_account_id", "ANALYST_NE").select(
        "customer_id", "cis_account_id", "segment", "rate_plan_id"
    )


for _metric in (
    "total_kwh", "total_kwh_net", "avg_completeness", "meter_count", "billing_ready_pct", "total_billed_kwh",
    "total_energy_charge", "total_demand_charge", "avg_energy_rate", "anomaly_count", "avg_pct_on_time",
):
    CATALOG[f"metric_{_metric}"] = lambda m, metric=_metric: standard_model(m).query([metric])


@query("metric_by_territory")
def metric_by_territory(m: Marts) -> DataFrame:
    return standard_model(m).query(
        ["total_kwh", "meter_count", "total_energy_charge"], ["meter.territory"]
    )


@query("metric_by_premise")
def metric_by_premise(m: Marts) -> DataFrame:
    return standard_model(m).query(
        ["total_kwh", "avg_completeness", "billing_ready_pct"], ["service_point.premise"]
    )


@query("metric_by_bucket")
def metric_by_bucket(m: Marts) -> DataFrame:
    return standard_model(m).query(
        ["total_energy_charge", "total_demand_charge", "avg_energy_rate"],
        ["charge_line.tou_bucket", "meter.meter_type"],
    )


def _lattice(m: Marts) -> Lattice:
    """Summaries of stored marts, with charges and billing."""
    kept = _stored(m, "charges", "billing", "sla")
    numbers = m.feed.accounts.select("meter_id", "meter_no")
    return standard_lattice(m.spark, standard_model(kept), f"{kept.stored.root}/summaries", numbers, lambda: kept.monthly)


@query("routed_by_territory")
def routed_by_territory(m: Marts) -> DataFrame:
    """Answered by the summary of days and territories and that of buckets."""
    return _lattice(m).query(["total_kwh", "meter_count", "total_energy_charge"], ["meter.territory"])


@query("routed_by_premise")
def routed_by_premise(m: Marts) -> DataFrame:
    return _lattice(m).query(["total_kwh", "avg_completeness", "billing_ready_pct"], ["service_point.premise"])


@query("routed_by_type")
def routed_by_type(m: Marts) -> DataFrame:
    """No summary knows the meter's type: the monthly rollup is the coarsest table that leads to it."""
    return _lattice(m).query(["total_kwh", "total_kwh_net", "meter_count"], ["meter.meter_type"])


@query("rolling_meters")
def rolling_meters(m: Marts) -> DataFrame:
    """Distinct meters of the seven days up to each day, per territory, from the days' bitmaps."""
    maps = _lattice(m).members("daily_by_territory").withColumn("day", F.to_date("daily_rollup_rollup_date"))
    return distinct.rolling(maps.select("day", "meter_territory", "bucket", "members"), "day", ["meter_territory"], 7, "meters")


# -- specified extensions -------------------------------------------------------------------------


@query("asof_link")
def asof_link(m: Marts) -> DataFrame:
    versions = m.feed.lookup.links.select("meter_id", "customer_id", "effective_from", "effective_to", "is_current")
    return tariff.as_of(m.reads.select("meter_id", "read_ts", "kwh_delivered"), versions, "meter_id").select(
        "meter_id", "read_ts", "kwh_delivered", "customer_id", "effective_from", "is_current"
    )


@query("asof_long")
def asof_long(m: Marts) -> DataFrame:
    """The versions in force, carried along the reads."""
    versions = m.feed.lookup.links.select("meter_id", "customer_id", "effective_from", "effective_to", "is_current")
    return tariff.as_of_long(m.reads.select("meter_id", "read_ts", "kwh_delivered"), versions, "meter_id").select(
        "meter_id", "read_ts", "kwh_delivered", "customer_id", "effective_from", "is_current"
    )


@query("tariff_components")
def tariff_components(m: Marts) -> DataFrame:
    return tariff.flatten_documents(m.tariff_documents)


@query("document_charges")
def document_charges(m: Marts) -> DataFrame:
    """Energy charges by the tariff document of each account, per meter and period.

    The components of all documents are far more than the accounts they come from, which the planner's size estimate does
    not see; they are sorted and merged, never sent to the driver. Those of months without a read are left out before.
    """
    own = m.feed.accounts.select("meter_id", F.concat(F.lit("SCH-"), F.col("meter_no").cast("string")).alias("schedule_id"))
    rated = m.rated.drop("schedule_id").join(own, "meter_id")
    flat = tariff.flatten_documents(m.tariff_documents)
    parts = tariff.document_components(flat.filter(F.col("month").isNull() | F.col("month").isin(m.months)))
    return tariff.energy_charges(rated, parts.hint("merge")).groupBy("meter_id", "billing_period_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("charge").alias("charge")
    )


@query("charge_components")
def charge_components(m: Marts) -> DataFrame:
    return m.energy_components


@query("demand_charges")
def demand_charges(m: Marts) -> DataFrame:
    return m.demand_components


@query("fixed_charges")
def fixed_charges(m: Marts) -> DataFrame:
    return m.fixed_components


@query("rider_charges")
def rider_charges(m: Marts) -> DataFrame:
    return m.rider_components


@query("dated_riders")
def dated_riders(m: Marts) -> DataFrame:
    """Riders that begin, end or change inside billing periods, priced for their days."""
    return tariff.dated_rider_charges(m.rated, m.energy_components)


@query("export_credit")
def export_credit(m: Marts) -> DataFrame:
    return m.export_components


@query("period_charges")
def period_charges(m: Marts) -> DataFrame:
    """Five kinds of charges read the rated reads, so those are written once."""
    m.rated = tables.snapshot(m.rated, fresh_folder(m.spark, "rated"))
    return tariff.period_charges(
        m.energy_components, m.demand_components, m.fixed_components, m.rider_components, m.export_components
    )


@query("shadow_bill")
def shadow_bill(m: Marts) -> DataFrame:
    return tariff.shadow_bill(m.rated, m.components, "S-TOU")


@query("peak_exposure")
def peak_exposure(m: Marts) -> DataFrame:
    return m.exposure_factors


@query("value_at_risk")
def value_at_risk(m: Marts) -> DataFrame:
    return m.at_risk


def _ranked_issues(m: Marts) -> DataFrame:
    work = fresh_folder(m.spark, "issues")
    by_priority = priority.ranked(m.scored_issues, "priority_score", f"{work}/priority")
    return priority.ranked(by_priority, "var_cumulative", f"{work}/dollars", "dollar_rank")


@query("ops_queue")
def ops_queue(m: Marts) -> DataFrame:
    """All open issues in the order to dispatch them, with their rank by dollars as well."""
    return _ranked_issues(m)


@query("ops_queue_by_dollars")
def ops_queue_by_dollars(m: Marts) -> DataFrame:
    """The same issues, ranked by the dollars at risk first."""
    return _ranked_issues(m).withColumnsRenamed({"rank": "priority_rank", "dollar_rank": "rank"})


@query("xfm_hourly")
def xfm_hourly(m: Marts) -> DataFrame:
    return topology.transformer_hours(m.hourly, m.placed)


@query("gap_fill")
def gap_fill(m: Marts) -> DataFrame:
    """Missing slots of the whole span, summed per meter and day."""
    filled = edge.gap_fill(m.reads, m.feed.meters, str(m.first_day), str(m.anchor))
    return filled.groupBy("meter_id", F.to_date("read_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("filled"), F.sum("kwh_delivered").alias("kwh_delivered"),
        F.sum("kwh_received").alias("kwh_received"), F.max("demand_kw").alias("demand_kw"),
        F.min("read_ts").alias("first_gap"),
    )


@query("anomaly_eval")
def anomaly_eval(m: Marts) -> DataFrame:
    """Scores of commercial meters against their tamper reports, four hours each."""
    start = F.date_trunc("hour", "event_ts").cast("timestamp_ntz")
    series = m.feed.lookup.meters.filter(F.col("meter_type") == "CNI").select("meter_id")
    labels = m.feed.meter_events.filter(
        (F.col("event_type") == "TAMPER") & (F.col("event_ts") >= ntz(m.detect_from))
    ).join(series, "meter_id", "left_semi").select(
        F.col("event_id").alias("label_id"), "meter_id", start.alias("start_ts"),
        (start + F.expr("interval 3 hours")).alias("end_ts"),
    )
    scored = tables.snapshot(m.meter_events, fresh_folder(m.spark, "meter-scores"))
    return anomaly.evaluate(scored, labels, "meter_id")


@query("retention")
def retention(m: Marts) -> DataFrame:
    kept = tables.retained(m.feed.arrivals, m.anchor, 14)
    return kept.groupBy(F.to_date("ingested_at").alias("ingest_date")).agg(F.sum("n_rows").alias("rows"))


@query("retention_purge")
def retention_purge(m: Marts) -> DataFrame:
    """What is left of the stored raw table after its old partitions were dropped."""
    path = f"{fresh_folder(m.spark, 'purged')}/bronze"
    pipeline.land_bronze(m.feed.payloads, path)
    tables.purge_before(m.spark, path, "ingest_date", m.day(14))
    return m.spark.read.parquet(path).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("rows"))


@query("rollup_tou")
def rollup_tou(m: Marts) -> DataFrame:
    return tou.bucket_usage(m.charges)


@query("charges_by_day")
def charges_by_day(m: Marts) -> DataFrame:
    return tou.charges_by(m.charges, F.to_date("read_ts").alias("charge_date"), "tou_bucket")


@query("charges_by_customer")
def charges_by_customer(m: Marts) -> DataFrame:
    current = m.feed.lookup.links.filter("is_current").select("meter_id", "customer_id")
    return tou.charges_by(m.charges.join(current, "meter_id"), "customer_id", "rate_plan_id")


@query("charges_by_period")
def charges_by_period(m: Marts) -> DataFrame:
    """Charges by billing period; reads are priced per meter and day before they meet the periods."""
    per_day = tou.charges_by(m.charges, "meter_id", F.to_date("read_ts").alias("day"))
    periods = m.known_cycles.select("meter_id", "billing_period_id", "start_date", "end_date")
    inside = per_day.join(periods, "meter_id").filter(F.col("day").between(F.col("start_date"), F.col("end_date")))
    return inside.groupBy("billing_period_id", "meter_id").agg(
        F.sum("intervals").alias("intervals"), F.sum("kwh").alias("kwh"),
        F.sum("energy_charge").alias("energy_charge"), F.sum("demand_charge").alias("demand_charge"),
        F.sum("total_charge").alias("total_charge"),
    )


@query("sla_by_meter")
def sla_by_meter(m: Marts) -> DataFrame:
    return quality.sla(m.reads, ["meter_id", "utility_territory"])


@query("dq_by_feeder")
def dq_by_feeder(m: Marts) -> DataFrame:
    on_feeder = m.reads.join(m.placed.select("meter_id", "feeder_id"), "meter_id")
    return quality.data_quality(on_feeder, m.per_day, [F.to_date("read_ts").alias("date_key"), F.col("feeder_id")])


@query("metric_history")
def metric_history(m: Marts) -> DataFrame:
    return quality.metric_history(m.feed.arrivals, "raw")


@query("metric_anomaly")
def metric_anomaly(m: Marts) -> DataFrame:
    return quality.metric_anomalies(quality.metric_history(m.feed.arrivals, "raw"))


@query("estimation_streaks")
def estimation_streaks(m: Marts) -> DataFrame:
    return edge.estimation_streaks(m.reads)


def run(name: str, spark: SparkSession, root: str) -> DataFrame:
    return to_report_types(CATALOG[name](Marts(spark, root)))
