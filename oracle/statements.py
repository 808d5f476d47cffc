"""One DuckDB statement per query name."""

from __future__ import annotations

from loadweave.sources import reference
from oracle.parts import PARTS, dq, sla
from oracle.sql import mean, mean_units, pct, with_parts

READ_COLUMNS = """meter_id, read_ts, read_local_ts, kwh_delivered::DOUBLE AS kwh_delivered,
 kwh_received::DOUBLE AS kwh_received, demand_kw::DOUBLE AS demand_kw, voltage_v::DOUBLE AS voltage_v, quality_flag,
 vee_status, estimation_method, utility_territory, source_file, ingested_at, ingestion_lag_sec"""
PAYLOAD = """meter_id, strftime(read_ts, '%Y-%m-%dT%H:%M:%S') AS read_ts, kwh_delivered::DOUBLE AS kwh_delivered,
 vee_status, source_file"""
ENERGY = """kwh_delivered::DOUBLE AS kwh_delivered, kwh_received::DOUBLE AS kwh_received, kwh_net::DOUBLE AS kwh_net,
 max_demand_kw::DOUBLE AS max_demand_kw, min_voltage::DOUBLE AS min_voltage, max_voltage::DOUBLE AS max_voltage"""
PCTS = "complete_u / 100.0::DOUBLE AS completeness_pct, pass_u / 100.0::DOUBLE AS vee_pass_pct"
CONSUMPTION = f"""billing_period_id, cis_account_id, service_point_id, meter_id, start_date, end_date,
 kwh_total::DOUBLE AS kwh_total, kwh_received::DOUBLE AS kwh_received, kwh_net::DOUBLE AS kwh_net,
 max_demand_kw::DOUBLE AS max_demand_kw, {PCTS}, is_billing_ready"""
TAG = """meter_id, read_ts, kwh::DOUBLE AS kwh, demand_kw::DOUBLE AS demand_kw, utility_territory, day_type, season,
 rate_plan_id, rate_window_id, tou_bucket, energy_rate_per_kwh::DOUBLE AS energy_rate_per_kwh,
 demand_rate_per_kw::DOUBLE AS demand_rate_per_kw"""
EVENT = """ts, kwh::DOUBLE AS kwh, forecast, lower_bound, upper_bound, is_anomaly, distance"""
TERRITORIES = ("NE", "SE", "MW", "W")
SUMS = """count(*) AS intervals, sum(kwh)::DOUBLE AS kwh, sum(energy_charge)::DOUBLE AS energy_charge,
 sum(demand_charge)::DOUBLE AS demand_charge, (sum(energy_charge) + sum(demand_charge))::DOUBLE AS total_charge"""
RATE = "round(sum(energy_charge)::DOUBLE / nullif(sum(kwh)::DOUBLE, 0), 6)"


def by_territory(value: str, how) -> str:
    return ", ".join(
        f"{how(f'CASE WHEN utility_territory = {chr(39)}{t}{chr(39)} THEN {value} END')} AS {t.lower()}"
        for t in TERRITORIES
    )


def _sum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def _mean_pct(x: str) -> str:
    """Mean, to two decimals, of a percentage held in hundredths."""
    return f"CAST({mean_units(x, 0)} AS DOUBLE)/100"


def _top_events(table: str, series: str) -> str:
    return f"""
SELECT {series}, strftime(ts, '%m-%d %H:%M') AS ts, CAST(kwh AS DECIMAL(12,1))::DOUBLE AS kwh, round(forecast, 1) AS forecast,
       round(upper_bound, 1) AS upper_bound, round(distance, 3) AS distance
FROM {table} WHERE is_anomaly ORDER BY {table}.distance DESC, {series}, {table}.ts LIMIT 15"""


def _card(ev: str, train: str, series: str, name: str) -> str:
    return f"""
SELECT '{name}' AS name, 'KWH' AS target, '{series.upper()}' AS series_col, t.*, e.* FROM
 (SELECT date_diff('day', min(ts), max(ts)) AS training_window_days, count(*) AS training_rows,
         count(DISTINCT {series}) AS n_series, CAST(max(ts) AS DATE) AS last_trained FROM {train}) t CROSS JOIN
 (SELECT count(*) AS scored, count(*) FILTER (is_anomaly) AS anomalies_found,
         {pct('count(*) FILTER (is_anomaly)', 'count(*)')} AS pct_flagged, {_avg_distance()} AS avg_distance,
         round(max(distance), 3) AS max_distance FROM {ev}) e"""


def _avg_distance() -> str:
    """Mean of six-decimal distances, half up to three decimals."""
    s, n = "CAST(sum(CAST(distance AS DECIMAL(18,6))) * 1000000 AS HUGEINT)", "count(*)"
    return (
        f"CAST(CASE WHEN {s} < 0 THEN -((2*-{s} + 1000*{n}) // (2000*{n})) "
        f"ELSE (2*{s} + 1000*{n}) // (2000*{n}) END AS DOUBLE)/1000"
    )


S: dict[str, str] = {}

# -- sources, conforming --------------------------------------------------------------------------
S["raw_landing"] = f"SELECT {PAYLOAD}, 'v1' AS schema_version, ingested_at FROM c_sent"
S["file_landing"] = f"SELECT {PAYLOAD}, 'v1' AS schema_version FROM c_sent"
S["ingest_append"] = """
SELECT meter_id, vee_status, count(*) AS rows, sum(kwh_delivered)::DOUBLE AS kwh FROM c_sent GROUP BY ALL"""
S["meter_event_log"] = "SELECT event_id, meter_id, event_ts, event_type, payload_k FROM c_mevents"
S["channel_catalog"] = """
SELECT c.*, coalesce(u.meters, 0) AS meters FROM c_catalog c
LEFT JOIN (SELECT channel_code, count(*) AS meters FROM c_mch GROUP BY ALL) u ON u.channel_code = c.channel_code"""
S["feeder_snapshot"] = "SELECT feeder_id, ts, kwh::DOUBLE AS kwh FROM c_frecent"
S["shared_billing"] = f"SELECT {CONSUMPTION.replace('cis_account_id', 'sha256(cis_account_id) AS cis_account_id', 1)} FROM c_bpc"
S["shared_daily_kwh"] = f"""
SELECT meter_id, utility_territory, CAST(rollup_ts AS DATE) AS read_date, kwh_delivered::DOUBLE AS kwh_delivered,
       kwh_received::DOUBLE AS kwh_received, max_demand_kw::DOUBLE AS max_demand_kw, {PCTS} FROM c_daily"""
S["shared_anomalies"] = f"SELECT feeder_id, {EVENT} FROM c_fev WHERE is_anomaly"
S["normalize_reads"] = f"SELECT {READ_COLUMNS} FROM c_reads"
S["quarantined_reads"] = """
SELECT s.meter_id, 'UNKNOWN_METER' AS reason, count(*) AS rows FROM c_sent s
WHERE meter_no % 16 = 15 GROUP BY s.meter_id"""
S["canonical_reads"] = f"SELECT {READ_COLUMNS} FROM c_reads"
S["local_time"] = "SELECT meter_id, read_ts, read_local_ts FROM c_reads"
S["ingestion_lag"] = "SELECT event_id, meter_id, read_ts, ingestion_lag_sec FROM c_sent"
S["lww_dedup"] = "SELECT meter_id, read_ts, event_id, kwh_delivered::DOUBLE AS kwh_delivered, ingested_at FROM c_reads"
S["unpivot_channels"] = """
SELECT meter_id, channel_id, channel_code, read_ts, value::DOUBLE AS value, uom, quality_flag, vee_status,
       estimation_method, utility_territory, ingestion_lag_sec FROM c_chan"""
S["wide_view"] = """
SELECT meter_id, read_ts, max(CASE WHEN channel_code = 'KWH_DEL' THEN value END)::DOUBLE AS kwh_delivered,
       max(CASE WHEN channel_code = 'KWH_REC' THEN value END)::DOUBLE AS kwh_received,
       max(CASE WHEN channel_code = 'KW_DEM' THEN value END)::DOUBLE AS demand_kw,
       max(CASE WHEN channel_code = 'VOLT_AVG' THEN value END)::DOUBLE AS voltage_v,
       min(quality_flag) AS quality_flag, min(vee_status) AS vee_status, min(estimation_method) AS estimation_method,
       min(event_id) AS event_id, min(utility_territory) AS utility_territory, min(source_file) AS source_file,
       min(ingested_at) AS ingested_at, min(ingestion_lag_sec) AS ingestion_lag_sec
FROM c_chan GROUP BY meter_id, read_ts"""
S["meter_channels"] = """
SELECT channel_id, meter_id, channel_code, channel_number, uom, direction, aggregation, interval_min::BIGINT AS interval_min,
       scale_factor::DOUBLE AS scale_factor, status, effective_from FROM c_mch"""
S["meter_link"] = "SELECT * FROM c_links"
S["conform_meter"] = "SELECT * FROM c_meters"
S["conform_customer"] = "SELECT * FROM c_cust"
S["topology"] = """
SELECT m.meter_id, m.service_point_id, m.meter_type, m.has_der, p.feeder_id, p.transformer_id, p.premise_type,
       p.utility_territory, p.lat::DOUBLE AS lat, p.lon::DOUBLE AS lon, t.kva_rating::DOUBLE AS kva_rating, t.phase,
       f.substation_id, f.voltage_kv::DOUBLE AS voltage_kv, s.substation_name
FROM c_meters m JOIN c_sp p ON p.service_point_id = m.service_point_id JOIN c_xfm t ON t.transformer_id = p.transformer_id
JOIN c_feeders f ON f.feeder_id = p.feeder_id JOIN c_subs s ON s.substation_id = f.substation_id"""
S["time_dim"] = """
SELECT ts_utc, local_date, local_minute::BIGINT AS local_minute, hour_local, day_of_week, day_type, month, season, is_holiday,
       coalesce(u.reads, 0) AS reads
FROM c_cal LEFT JOIN (SELECT read_ts, count(*) AS reads FROM c_reads GROUP BY ALL) u ON u.read_ts = c_cal.ts_utc"""
S["billing_periods"] = """
SELECT billing_period_id, cis_account_id, service_point_id, bill_cycle, start_date, end_date,
       cis_billed_kwh::DOUBLE AS cis_billed_kwh FROM c_periods"""
_LEVEL = "CAST(0.7 + CAST((('0x' || substr(sha256(x.meter_id), 1, 8))::BIGINT % 60) AS DECIMAL(2,0)) * 0.01 AS DECIMAL(3,2))"
_BASE = "CAST(CASE x.meter_type WHEN 'RES' THEN 0.5 WHEN 'SMB' THEN 3.0 ELSE 20.0 END AS DECIMAL(3,1))"
_SEASON = "CAST(CASE td.season WHEN 'SUMMER' THEN 1.3 WHEN 'WINTER' THEN 1.1 ELSE 1.0 END AS DECIMAL(3,1))"
_DAY = """CAST(CASE WHEN td.day_type = 'WEEKEND' AND x.meter_type = 'CNI' THEN 0.6 WHEN td.day_type = 'WEEKEND' THEN 0.9
 ELSE 1.0 END AS DECIMAL(3,1))"""
_HOUR = """CAST(CASE WHEN td.hour_local BETWEEN 17 AND 20 THEN 1.6 WHEN td.hour_local BETWEEN 7 AND 9 THEN 1.2
 WHEN td.hour_local BETWEEN 0 AND 5 THEN 0.5 ELSE 1.0 END AS DECIMAL(3,1))"""
EXPECTED = f"""CAST({_BASE} * {_LEVEL} * {_DAY} * {_SEASON} * {_HOUR} AS DECIMAL(14,4)) AS expected_kwh,
 CAST(CASE WHEN x.has_der AND td.hour_local BETWEEN 9 AND 16
      THEN {_BASE} * 0.2 * (4.0 - abs(CAST(td.hour_local AS DECIMAL(3,1)) - 12.5)) ELSE 0 END AS DECIMAL(14,4)) AS expected_kwh_received,
 CAST({_BASE} * {_LEVEL} * {_SEASON} * 4.5 AS DECIMAL(10,4)) AS expected_kw"""
S["load_profile"] = f"""
SELECT meter_id, read_ts, kwh_delivered::DOUBLE AS kwh_delivered, expected_kwh::DOUBLE AS expected_kwh,
       expected_kwh_received::DOUBLE AS expected_kwh_received, expected_kw::DOUBLE AS expected_kw FROM (
  SELECT i.meter_id, i.read_ts, i.kwh_delivered, {EXPECTED}
  FROM c_reads i JOIN c_meters x ON x.meter_id = i.meter_id JOIN c_cal td ON td.ts_utc = i.read_ts)"""
S["data_anchor"] = "SELECT strftime(max(ts), '%Y-%m-%d') AS max_date FROM events"
S["sample_reads"] = """
SELECT meter_id, read_ts, event_id FROM c_reads
WHERE ('0x' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 10000 < 100"""

# -- marts ----------------------------------------------------------------------------------------
S["hourly_rollup"] = f"""
SELECT meter_id, rollup_ts, utility_territory, 'HOUR' AS rollup_grain, {ENERGY}, voltage_u / 1000000.0::DOUBLE AS avg_voltage,
       n AS source_interval_count, 1::BIGINT AS expected_interval_count, {PCTS} FROM c_hourly"""
S["daily_rollup"] = f"""
SELECT meter_id, rollup_ts, utility_territory, 'DAY' AS rollup_grain, {ENERGY}, voltage_u / 1000000.0::DOUBLE AS avg_voltage,
       n AS source_interval_count, 2::BIGINT AS expected_interval_count, {PCTS} FROM c_daily"""
S["monthly_rollup"] = f"""
SELECT meter_id, rollup_ts, utility_territory, 'MONTH' AS rollup_grain, {ENERGY}, n AS source_interval_count, {PCTS}
FROM c_monthly"""
_RULE = """CASE WHEN aggregation = 'SUM' THEN total::DOUBLE END AS value_sum,
 CASE WHEN aggregation = 'MAX' THEN highest::DOUBLE END AS value_max,
 CASE WHEN aggregation = 'MIN' THEN lowest::DOUBLE END AS value_min,
 CASE WHEN aggregation = 'AVG' THEN average_u / 10000.0::DOUBLE END AS value_avg"""
S["channel_hourly"] = f"""
SELECT meter_id, channel_code, uom, rollup_ts, utility_territory, {_RULE},
       CASE aggregation WHEN 'SUM' THEN total::DOUBLE WHEN 'MAX' THEN highest::DOUBLE WHEN 'MIN' THEN lowest::DOUBLE
            WHEN 'AVG' THEN average_u / 10000.0::DOUBLE END AS canonical_value,
       n AS source_interval_count, 1::BIGINT AS expected_interval_count, {PCTS} FROM c_chour"""
S["channel_daily"] = f"""
SELECT meter_id, channel_code, uom, date_trunc('day', rollup_ts) AS rollup_date, utility_territory,
       sum(CASE WHEN aggregation = 'SUM' THEN total END)::DOUBLE AS value_sum,
       max(CASE WHEN aggregation = 'MAX' THEN highest END)::DOUBLE AS value_max,
       min(CASE WHEN aggregation = 'MIN' THEN lowest END)::DOUBLE AS value_min,
       CAST({mean_units("CASE WHEN aggregation = 'AVG' THEN average_u END", 0)} AS DOUBLE) / 10000 AS value_avg,
       CAST(sum(n) AS BIGINT) AS source_interval_count, 2::BIGINT AS expected_interval_count,
       {pct('sum(n)', '2')} AS completeness_pct, {_mean_pct('pass_u')} AS vee_pass_pct
FROM c_chour GROUP BY meter_id, channel_code, uom, date_trunc('day', rollup_ts), utility_territory"""
S["tou_tagged"] = f"SELECT {TAG} FROM c_tag"
S["tou_tagged_local"] = f"SELECT {TAG} FROM c_wtag"
S["charge_line"] = """
SELECT meter_id, read_ts, utility_territory, rate_plan_id, rate_window_id, tou_bucket, kwh::DOUBLE AS kwh,
       demand_kw::DOUBLE AS demand_kw, energy_rate_per_kwh::DOUBLE AS energy_rate_per_kwh,
       demand_rate_per_kw::DOUBLE AS demand_rate_per_kw, energy_charge::DOUBLE AS energy_charge,
       demand_charge::DOUBLE AS demand_charge FROM c_line"""
S["billing_consumption"] = f"SELECT {CONSUMPTION} FROM c_bpc"
S["billing_recon"] = """
SELECT b.billing_period_id, b.cis_account_id, b.meter_id, b.kwh_total::DOUBLE AS interval_sum_kwh,
       p.cis_billed_kwh::DOUBLE AS cis_billed_kwh,
       (b.kwh_total - coalesce(p.cis_billed_kwh, b.kwh_total))::DOUBLE AS variance_kwh,
       round(abs(b.kwh_total - p.cis_billed_kwh)::DOUBLE / nullif(p.cis_billed_kwh, 0)::DOUBLE * 100, 6) AS variance_pct,
       b.complete_u / 100.0::DOUBLE AS completeness_pct, b.is_billing_ready
FROM c_bpc b JOIN c_periods p ON p.billing_period_id = b.billing_period_id"""
_SLA = """total_reads, max_ingestion_lag_min, on_time_u / 100.0::DOUBLE AS pct_arrived_within_15min, late_arrival_count,
 very_late_arrival_count"""
_DQ = """total_reads, pass_u / 100.0::DOUBLE AS vee_pass_rate, estimated_intervals, failed_intervals, missing_intervals,
 complete_u / 100.0::DOUBLE AS completeness_pct"""
S["sla_metrics"] = f"SELECT date_key, utility_territory, {_SLA} FROM c_sla"
S["dq_metrics"] = f"SELECT date_key, utility_territory, {_DQ} FROM c_dq"
S["obs_dashboard"] = """
SELECT s.date_key, s.utility_territory, s.total_reads, s.max_ingestion_lag_min,
       s.on_time_u / 100.0::DOUBLE AS pct_arrived_within_15min, s.late_arrival_count, q.pass_u / 100.0::DOUBLE AS vee_pass_rate,
       q.estimated_intervals, q.failed_intervals, q.missing_intervals, q.complete_u / 100.0::DOUBLE AS completeness_pct
FROM c_sla s FULL OUTER JOIN c_dq q ON s.date_key = q.date_key AND s.utility_territory = q.utility_territory"""
S["sla_breach"] = f"""
SELECT 'SLA_BREACH_ALERT' AS pipeline_name,
       sha256('SLA_BREACH_ALERT' || strftime(CAST(anchor AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')) AS run_id,
       CAST(anchor AS TIMESTAMP) AS start_time, CAST(anchor AS TIMESTAMP) AS end_time, 'ALERT' AS status,
       0::BIGINT AS rows_processed, 1::BIGINT AS error_count,
       '{reference.SLA_BREACH_MESSAGE.format(99)}' AS message
FROM c_span WHERE EXISTS (SELECT 1 FROM c_sla WHERE date_key = anchor AND on_time_u < 9900)"""
S["table_metrics"] = """
SELECT t.table_name, k.metric, CASE k.metric WHEN 'ROW_COUNT' THEN t.n ELSE datesub('second', t.newest, s.anchor_end) END AS value,
       s.anchor_end AS measured_at
FROM (SELECT 'raw' AS table_name, count(*) AS n, max(ingested_at) AS newest FROM c_sent
      UNION ALL SELECT 'canonical', count(*), max(ingested_at) FROM c_reads) t
CROSS JOIN (VALUES ('ROW_COUNT'), ('FRESHNESS_SEC')) k(metric) CROSS JOIN c_span s"""
S["feeder_load"] = "SELECT feeder_id, ts, kwh::DOUBLE AS kwh FROM c_fload"
S["feeder_training"] = "SELECT feeder_id, ts, kwh::DOUBLE AS kwh FROM c_ftrain"
S["anomaly_baseline"] = "SELECT feeder_id, day_type, hour, level, points, forecast, sigma FROM c_fbase"
S["feeder_anomalies"] = f"SELECT feeder_id, {EVENT} FROM c_fev"
S["meter_anomalies"] = f"SELECT meter_id, {EVENT} FROM c_mev"
S["anomaly_events"] = f"SELECT feeder_id, {EVENT} FROM c_fev"
S["score_pass"] = "SELECT meter_id, ts, kwh::DOUBLE AS kwh, forecast, is_anomaly, distance FROM c_mev"
S["duplicate_audit"] = """
SELECT duplicate_id, meter_id, utility_territory, read_ts, copies, value_first::DOUBLE AS value_first,
       value_second::DOUBLE AS value_second, received_first, received_second, gap_min, resolution, channel_code FROM c_dup"""
S["load_shape"] = "SELECT meter_id, meter_type, eve, day, night, overall FROM c_shape"
_MISMATCH = """rank, meter_id, meter_type AS current_type, suggested_type, round(eve, 3) AS avg_eve_kwh,
 round(day, 3) AS avg_day_kwh, round(night, 3) AS avg_night_kwh, round(overall, 3) AS avg_overall,
 round(separation, 3) AS confidence"""
S["premise_mismatch"] = f"SELECT {_MISMATCH} FROM c_wrong"

# -- streaming: what the drained output must equal --------------------------------------------------
S["stream_normalize"] = f"SELECT event_id, {READ_COLUMNS} FROM c_sent"
S["stream_lww"] = f"SELECT {READ_COLUMNS} FROM c_reads"
S["late_upsert"] = f"SELECT {READ_COLUMNS} FROM c_reads"
S["stream_hourly"] = """
SELECT meter_id, utility_territory, date_trunc('hour', read_ts) AS hour, count(*) AS reads, sum(kwh_delivered)::DOUBLE AS kwh
FROM c_sent GROUP BY ALL"""
_REFRESHED = f"""meter_id, rollup_ts, utility_territory, kwh_delivered::DOUBLE AS kwh_delivered, kwh_net::DOUBLE AS kwh_net,
 max_demand_kw::DOUBLE AS max_demand_kw, n AS source_interval_count, {PCTS}"""
S["incremental_refresh"] = f"""
SELECT 'DAY' AS rollup_grain, {_REFRESHED} FROM c_daily UNION ALL SELECT 'MONTH', {_REFRESHED} FROM c_monthly"""

S["refreshed_billing"] = S["billing_consumption"]
S["channel_backfill"] = """
SELECT channel_code, CAST(read_ts AS DATE) AS read_date, count(*) AS rows, sum(value)::DOUBLE AS value
FROM c_chan GROUP BY ALL"""

# -- governance, metrics --------------------------------------------------------------------------
S["row_policy"] = """
SELECT meter_id, read_ts, utility_territory, kwh_delivered::DOUBLE AS kwh_delivered FROM c_reads WHERE utility_territory = 'NE'"""
S["mask_account"] = "SELECT customer_id, sha256(cis_account_id) AS cis_account_id, segment, rate_plan_id FROM c_cust"
_METRIC = {
    "total_kwh": ("sum(kwh_delivered)::DOUBLE", "c_daily"),
    "total_kwh_net": ("(sum(kwh_delivered) - sum(kwh_received))::DOUBLE", "c_daily"),
    "avg_completeness": (mean("CAST(complete_u AS DECIMAL(18,0)) * 0.01", 6), "c_daily"),
    "meter_count": ("count(DISTINCT meter_id)", "c_daily"),
    "billing_ready_pct": (pct("count(*) FILTER (is_billing_ready)", "count(*)", 6), "c_bpc"),
    "total_billed_kwh": ("sum(kwh_total)::DOUBLE", "c_bpc"),
    "total_energy_charge": ("sum(energy_charge)::DOUBLE", "c_line"),
    "total_demand_charge": ("sum(demand_charge)::DOUBLE", "c_line"),
    "avg_energy_rate": (RATE, "c_line"),
    "anomaly_count": ("count(*) FILTER (is_anomaly)", "c_fev"),
    "avg_pct_on_time": (mean("CAST(on_time_u AS DECIMAL(18,0)) * 0.01", 6), "c_sla"),
}
for _name, (_expr, _table) in _METRIC.items():
    S[f"metric_{_name}"] = f"SELECT {_expr} AS {_name} FROM {_table}"
S["metric_by_territory"] = f"""
SELECT d.t AS meter_territory, d.total_kwh, d.meter_count, c.total_energy_charge FROM
 (SELECT m.utility_territory AS t, {_METRIC['total_kwh'][0]} AS total_kwh, count(DISTINCT r.meter_id) AS meter_count
  FROM c_daily r JOIN c_meters m ON m.meter_id = r.meter_id GROUP BY ALL) d
FULL OUTER JOIN (SELECT m.utility_territory AS t, {_METRIC['total_energy_charge'][0]} AS total_energy_charge
  FROM c_line r JOIN c_meters m ON m.meter_id = r.meter_id GROUP BY ALL) c ON c.t = d.t"""
S["metric_by_premise"] = f"""
SELECT d.t AS service_point_premise, d.total_kwh, d.avg_completeness, b.billing_ready_pct FROM
 (SELECT m.premise_type AS t, {_METRIC['total_kwh'][0]} AS total_kwh, {_METRIC['avg_completeness'][0]} AS avg_completeness
  FROM c_daily r JOIN c_metered m ON m.meter_id = r.meter_id GROUP BY ALL) d
FULL OUTER JOIN (SELECT m.premise_type AS t, {_METRIC['billing_ready_pct'][0]} AS billing_ready_pct
  FROM c_bpc r JOIN c_metered m ON m.meter_id = r.meter_id GROUP BY ALL) b ON b.t = d.t"""
S["metric_by_bucket"] = f"""
SELECT r.tou_bucket AS charge_line_tou_bucket, m.meter_type AS meter_meter_type,
       {_METRIC['total_energy_charge'][0]} AS total_energy_charge, {_METRIC['total_demand_charge'][0]} AS total_demand_charge,
       {RATE} AS avg_energy_rate
FROM c_line r JOIN c_meters m ON m.meter_id = r.meter_id GROUP BY ALL"""

# -- reports --------------------------------------------------------------------------------------
S["ingestion_kpi"] = f"""
SELECT (SELECT count(*) FROM c_reads) AS interval_rows, (SELECT count(DISTINCT meter_id) FROM c_reads) AS meters,
       {_mean_pct('on_time_u')} AS on_time, CAST(sum(late_arrival_count) AS BIGINT) AS late_1d,
       round(sum(late_arrival_count)::DOUBLE * (2.0::DOUBLE * 0.15::DOUBLE), 2) AS late_exposure
FROM c_sla WHERE date_key = (SELECT anchor FROM c_span)"""
S["ingestion_hourly"] = f"""
SELECT strftime(h, '%m-%d %H') AS hr, {by_territory('c', _sum)} FROM (
  SELECT date_trunc('hour', read_ts) AS h, utility_territory, count(*) AS c FROM c_reads, c_span
  WHERE read_ts BETWEEN anchor_end - INTERVAL 2 DAY AND anchor_end GROUP BY ALL) GROUP BY h"""
S["ingestion_sla"] = f"""
SELECT strftime(d, '%m-%d') AS date_key, pct_on_time FROM (SELECT date_key AS d, {_mean_pct('on_time_u')} AS pct_on_time
FROM c_sla, c_span WHERE date_key BETWEEN anchor - 14 AND anchor GROUP BY date_key)"""
S["dq_daily"] = f"""
SELECT strftime(d, '%m-%d') AS date_key, ne, se, mw, w FROM (SELECT date_key AS d, {by_territory('pass_u', _mean_pct)}
FROM c_dq, c_span WHERE date_key BETWEEN anchor - 14 AND anchor GROUP BY date_key)"""
_WORST = "SELECT feeder_id, meters, complete_u / 100.0::DOUBLE AS completeness_pct FROM {} ORDER BY complete_u, feeder_id LIMIT 20"
S["worst_feeders"] = _WORST.format("c_fcomp")
S["worst_feeders_rolling"] = _WORST.format("c_froll")
_READY = pct("count(*) FILTER (is_billing_ready)", "count(*)")
S["billing_stats"] = f"""
SELECT count(*) AS total, count(*) FILTER (is_billing_ready) AS ready, {_READY} AS pct_ready FROM c_bpc"""
S["billing_trend"] = f"""
SELECT strftime(start_date, '%Y-%m') AS period, count(*) AS total, count(*) FILTER (is_billing_ready) AS ready,
       count(*) FILTER (NOT is_billing_ready) AS not_ready, {_READY} AS pct_ready,
       CAST(count(*) FILTER (NOT is_billing_ready) * 0.0001125 AS DECIMAL(12,2))::DOUBLE AS dollars_held_m
FROM c_bpc GROUP BY strftime(start_date, '%Y-%m')"""
S["billing_by_period"] = """
SELECT strftime(start_date, '%Y-%m') AS start_date, count(*) FILTER (is_billing_ready) AS ready,
       count(*) FILTER (NOT is_billing_ready) AS not_ready FROM c_bpc GROUP BY strftime(c_bpc.start_date, '%Y-%m')"""
S["billing_ready_by_start"] = f"""
SELECT start_date, count(*) AS total_periods, count(*) FILTER (is_billing_ready) AS ready, {_READY} AS pct_ready
FROM c_bpc GROUP BY start_date"""
S["worst_unready"] = f"""
SELECT billing_period_id, meter_id, kwh_total::DOUBLE AS kwh_total, {PCTS} FROM c_bpc WHERE NOT is_billing_ready
ORDER BY complete_u, billing_period_id LIMIT 10"""
S["tou_bucket_totals"] = """
SELECT tou_bucket, CAST(sum(energy_charge) AS DECIMAL(14,2))::DOUBLE AS energy_charge FROM c_line, c_span
WHERE read_ts BETWEEN anchor - 30 AND anchor_end GROUP BY tou_bucket"""
S["tou_daily_revenue"] = """
SELECT strftime(d, '%m-%d') AS day, energy, demand FROM (SELECT CAST(read_ts AS DATE) AS d,
  CAST(sum(energy_charge) AS DECIMAL(14,2))::DOUBLE AS energy, CAST(sum(demand_charge) AS DECIMAL(14,2))::DOUBLE AS demand
  FROM c_line, c_span WHERE read_ts BETWEEN anchor - 14 AND anchor_end GROUP BY CAST(read_ts AS DATE))"""
S["tou_implied_rate"] = """
SELECT tou_bucket, count(*) AS intervals, CAST(sum(kwh) AS DECIMAL(14,2))::DOUBLE AS kwh,
       sum(energy_charge)::DOUBLE AS energy_charge,
       round(sum(energy_charge)::DOUBLE / nullif(sum(kwh)::DOUBLE, 0), 5) AS implied_rate
FROM c_line, c_span WHERE rate_plan_id = 'RP-TOU3' AND CAST(read_ts AS DATE) = anchor - 5 GROUP BY tou_bucket"""
S["anomaly_kpi"] = """
SELECT count(*) AS scored, count(*) FILTER (is_anomaly) AS feeder_anomalies,
       (SELECT count(*) FILTER (is_anomaly) FROM c_mev) AS meter_anomalies FROM c_fev"""
S["top_feeder_anomalies"] = _top_events("c_fev", "feeder_id")
S["top_meter_anomalies"] = _top_events("c_mev", "meter_id")
S["anomaly_board"] = """
SELECT feeder_id, ts, kwh::DOUBLE AS kwh, forecast, lower_bound, upper_bound, distance FROM c_fev WHERE is_anomaly
ORDER BY distance DESC, feeder_id, ts LIMIT 50"""
S["anomalies_per_day"] = "SELECT CAST(ts AS DATE) AS day, count(*) FILTER (is_anomaly) AS anomalies FROM c_fev GROUP BY CAST(ts AS DATE)"
S["forecast_band"] = """
SELECT strftime(ts, '%m-%d %H:%M') AS ts, CAST(kwh AS DECIMAL(14,2))::DOUBLE AS kwh, round(forecast, 2) AS forecast,
       round(lower_bound, 2) AS lower, round(upper_bound, 2) AS upper, is_anomaly, round(distance, 3) AS distance,
       CASE WHEN is_anomaly THEN CAST(kwh AS DECIMAL(14,2))::DOUBLE END AS anomaly_kwh
FROM c_fev WHERE feeder_id = 'FDR-00002' ORDER BY c_fev.ts DESC LIMIT 168"""
S["model_card"] = _card("c_fev", "c_ftrain", "feeder_id", "feeder_seasonal") + " UNION ALL " + _card(
    "c_mev", "c_mtrain", "meter_id", "commercial_meter_seasonal")
S["anomaly_summary"] = f"""
SELECT count(*) AS scored_rows, count(*) FILTER (is_anomaly) AS anomalies, {_avg_distance()} AS avg_distance,
       round(max(distance), 3) AS max_distance FROM c_fev"""
S["xfm_attribution"] = """
SELECT transformer_id, feeder_id, kva_rating::DOUBLE AS kva, meters, hours AS feeder_anomaly_hours, share_pct, est_excess_kwh,
       est_dollar_exposure, max_distance
FROM c_attr ORDER BY est_dollar_exposure DESC NULLS LAST, transformer_id LIMIT 25"""
S["anomaly_exposure"] = """
SELECT feeder_id, ts, kwh::DOUBLE AS kwh, forecast, distance,
       CAST(greatest(CAST(kwh AS DECIMAL(18,6)) - CAST(forecast AS DECIMAL(18,6)), 0) * 0.15 AS DECIMAL(18,4))::DOUBLE AS exposure
FROM c_fev WHERE is_anomaly ORDER BY distance DESC, feeder_id, ts LIMIT 15"""
S["xfm_summary"] = """
SELECT count(*) AS xfm_count, count(DISTINCT feeder_id) AS feeder_count, sum(kva_rating)::DOUBLE AS total_kva FROM c_xfm"""
S["xfm_top_loaded"] = f"""
SELECT * FROM (
  SELECT t.transformer_id, t.feeder_id, t.kva_rating::DOUBLE AS kva, count(DISTINCT p.service_point_id) AS meters,
         CAST(sum(d.kwh_delivered) AS DECIMAL(14,2))::DOUBLE AS kwh_30d, CAST(max(d.max_demand_kw) AS DECIMAL(12,2))::DOUBLE AS peak_kw,
         {pct('max(d.max_demand_kw)', 't.kva_rating', 1)} AS load_factor_pct
  FROM c_daily d JOIN c_placed p ON p.meter_id = d.meter_id JOIN c_xfm t ON t.transformer_id = p.transformer_id
  CROSS JOIN c_span s WHERE d.rollup_ts BETWEEN s.anchor - 30 AND s.anchor
  GROUP BY t.transformer_id, t.feeder_id, t.kva_rating)
ORDER BY load_factor_pct DESC NULLS LAST, transformer_id LIMIT 25"""
S["xfm_by_territory"] = """
SELECT f.utility_territory AS territory, count(*) AS xfm_count, sum(t.kva_rating)::DOUBLE AS total_kva,
       count(*) FILTER (t.phase = 'THREE') AS three_phase
FROM c_xfm t JOIN c_feeders f ON f.feeder_id = t.feeder_id GROUP BY f.utility_territory"""
S["substation_feeders"] = """
SELECT substation_id, utility_territory, lat::DOUBLE AS lat, lon::DOUBLE AS lon,
       (SELECT count(*) FROM c_feeders f WHERE f.substation_id = s.substation_id) AS feeder_count FROM c_subs s"""
S["feeder_health"] = """
SELECT c.feeder_id, f.utility_territory AS territory, lat_u / 1000000.0::DOUBLE AS lat, lon_u / 1000000.0::DOUBLE AS lon, meters,
       complete_u / 100.0::DOUBLE AS completeness_pct
FROM c_fcomp c JOIN c_feeders f ON f.feeder_id = c.feeder_id"""
S["events_summary"] = "SELECT event_type, count(*) AS count FROM c_mevents GROUP BY event_type"
S["events_recent"] = """
SELECT event_id, meter_id, event_type, strftime(event_ts, '%Y-%m-%d %H:%M') AS event_ts, props AS event_payload FROM c_mevents, c_span
WHERE c_mevents.event_ts >= anchor - 7 ORDER BY c_mevents.event_ts DESC, event_id DESC LIMIT 100"""
S["edge_kpi"] = """
SELECT (SELECT count(*) FROM c_partial) AS partial_meters_24h,
       (SELECT count(*) FROM c_partial WHERE intervals_24h * 2 < 2) AS severe_meters_24h,
       (SELECT count(*) FROM c_dup) AS duplicates_resolved,
       (SELECT count(*) FROM c_chan, c_span WHERE vee_status = 'ESTIMATED' AND read_ts >= last_slot - INTERVAL 7 DAY) AS estimated_7d,
       (SELECT count(*) FROM c_chan, c_span WHERE vee_status = 'FAILED' AND read_ts >= last_slot - INTERVAL 7 DAY) AS failed_7d,
       (SELECT count(*) FROM c_wrong) AS mapping_issues"""
S["partial_meters"] = "SELECT * FROM c_partial ORDER BY intervals_24h, meter_id LIMIT 25"
S["lag_histogram"] = """
SELECT CASE WHEN ingestion_lag_sec < 14400 THEN '0-4h' WHEN ingestion_lag_sec < 86400 THEN '4-24h'
            WHEN ingestion_lag_sec < 100800 THEN '24-28h' ELSE '>28h' END AS bucket, count(*) AS n
FROM c_chan WHERE ingestion_lag_sec IS NOT NULL GROUP BY 1"""
S["duplicate_sample"] = """
SELECT duplicate_id, meter_id, utility_territory, read_ts, value_first::DOUBLE AS value_first, value_second::DOUBLE AS value_second,
       strftime(received_first, '%m-%d %H:%M') AS received_first, strftime(received_second, '%m-%d %H:%M') AS received_second,
       gap_min, resolution
FROM c_dup ORDER BY read_ts DESC, meter_id LIMIT 25"""
S["duplicate_summary"] = """
SELECT count(*) AS total,
       CAST((20 * CAST(sum(gap_min) AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS avg_gap_min,
       CAST((2 * CAST(sum(abs(value_second - value_first)) * 10000 AS HUGEINT) + 10 * count(*)) // (20 * count(*)) AS DOUBLE) / 1000 AS avg_delta
FROM c_dup"""
S["vee_distribution"] = "SELECT vee_status AS status, count(*) AS n FROM c_chan GROUP BY vee_status"
S["vee_trend"] = """
SELECT strftime(day, '%m-%d') AS d, valid, estimated, failed FROM (SELECT CAST(read_ts AS DATE) AS day,
  count(*) FILTER (vee_status = 'VALID') AS valid, count(*) FILTER (vee_status = 'ESTIMATED') AS estimated,
  count(*) FILTER (vee_status = 'FAILED') AS failed
  FROM c_chan, c_span WHERE read_ts >= last_slot - INTERVAL 14 DAY GROUP BY CAST(read_ts AS DATE))"""
S["estimation_methods"] = """
SELECT estimation_method AS method, count(*) AS n FROM c_chan WHERE estimation_method IS NOT NULL GROUP BY estimation_method"""
S["premise_mismatch_report"] = f"""
SELECT w.*, p.utility_territory AS territory, p.feeder_id FROM (SELECT {_MISMATCH} FROM c_wrong) w
LEFT JOIN c_placed p ON p.meter_id = w.meter_id ORDER BY w.rank LIMIT 25"""
S["reads_per_hour"] = """
SELECT date_trunc('hour', read_ts) AS hr, utility_territory, count(*) AS reads FROM c_reads, c_span
WHERE read_ts >= anchor_end - INTERVAL 7 DAY GROUP BY ALL"""
S["sla_heatmap"] = """
SELECT date_key, utility_territory, on_time_u / 100.0::DOUBLE AS pct_arrived_within_15min, late_arrival_count,
       max_ingestion_lag_min FROM c_sla"""
S["vee_pass_trend"] = """
SELECT date_key, utility_territory, pass_u / 100.0::DOUBLE AS vee_pass_rate, estimated_intervals, failed_intervals,
       complete_u / 100.0::DOUBLE AS completeness_pct FROM c_dq"""
S["dim_counts"] = """
SELECT (SELECT count(*) FROM c_subs) AS substations, (SELECT count(*) FROM c_feeders) AS feeders,
       (SELECT count(*) FROM c_xfm) AS transformers, (SELECT count(*) FROM c_sp) AS service_points,
       (SELECT count(*) FROM c_meters) AS meters, (SELECT count(*) FROM c_cust) AS customers,
       (SELECT count(*) FROM c_cal) AS time_dim_rows, (SELECT count(*) FROM c_cycles) AS billing_periods"""
S["interval_volume"] = f"""
SELECT count(*) AS interval_rows,
       {pct('count(*)', '2 * (max(s.anchor) - max(s.first_day) + 1) * count(DISTINCT meter_id)')} AS pct_of_target
FROM c_reads CROSS JOIN c_span s"""
S["vee_share"] = f"""
SELECT vee_status, n AS rows, {pct('n', 'total')} AS pct
FROM (SELECT vee_status, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM c_reads GROUP BY vee_status)"""
S["rollup_counts"] = """
SELECT (SELECT count(*) FROM c_hourly) AS hourly, (SELECT count(*) FROM c_daily) AS daily,
       (SELECT count(*) FROM c_monthly) AS monthly"""
S["obs_spot_check"] = """
SELECT s.date_key, s.utility_territory, s.on_time_u / 100.0::DOUBLE AS pct_arrived_within_15min,
       q.pass_u / 100.0::DOUBLE AS vee_pass_rate, q.complete_u / 100.0::DOUBLE AS completeness_pct
FROM c_sla s JOIN c_dq q ON s.date_key = q.date_key AND s.utility_territory = q.utility_territory
WHERE s.date_key = (SELECT anchor - 1 FROM c_span)"""
S["stream_counts"] = "SELECT (SELECT count(*) FROM c_sent) AS raw_rows, (SELECT count(*) FROM c_reads) AS dt_rows"

# -- specified extensions ---------------------------------------------------------------------------
S["asof_link"] = """
SELECT i.meter_id, i.read_ts, i.kwh_delivered::DOUBLE AS kwh_delivered, l.customer_id, l.effective_from, l.is_current
FROM c_reads i JOIN c_links l ON l.meter_id = i.meter_id AND i.read_ts >= l.effective_from
     AND (l.effective_to IS NULL OR i.read_ts < l.effective_to)"""
_ON = "(0.25 + CAST(meter_no % 7 AS DECIMAL(4,0)) * 0.01)::DOUBLE"
_OFF = "(0.08 + CAST(meter_no % 7 AS DECIMAL(4,0)) * 0.01)::DOUBLE"
_OFF2 = "(0.12 + CAST(meter_no % 7 AS DECIMAL(4,0)) * 0.01)::DOUBLE"
S["tariff_components"] = f"""
SELECT 'SCH-' || meter_no AS schedule_id, 'ENERGY' AS component_type, w.day_type, g.month, w.start_hour, w.end_hour, w.period,
       t.tier, CASE WHEN t.tier = 2 THEN 200.0::DOUBLE ELSE 0.0::DOUBLE END AS tier_from_kwh,
       CASE WHEN w.period = 0 AND t.tier = 1 THEN 200.0::DOUBLE END AS tier_to_kwh,
       CASE WHEN w.period = 1 THEN {_ON} WHEN t.tier = 1 THEN {_OFF} ELSE {_OFF2} END AS rate, 'KWH' AS unit
FROM (SELECT meter_no, 'WEEKDAY' AS day_type, 0::BIGINT AS start_hour, 14 + meter_no % 3 AS end_hour, 0::BIGINT AS period FROM c_acct
      UNION ALL SELECT meter_no, 'WEEKDAY', 15 + meter_no % 3, 20, 1 FROM c_acct
      UNION ALL SELECT meter_no, 'WEEKDAY', 21, 23, 0 FROM c_acct
      UNION ALL SELECT meter_no, 'WEEKEND', 0, 23, 0 FROM c_acct) w
CROSS JOIN generate_series(1, 12) g(month)
JOIN (VALUES (0::BIGINT, 1::BIGINT), (0, 2), (1, 1)) t(period, tier) ON t.period = w.period
UNION ALL
SELECT 'SCH-' || meter_no, 'DEMAND', 'ALL', NULL, 0, 23, 0, 1, NULL, NULL, 8.0::DOUBLE, 'KW' FROM c_acct
UNION ALL
SELECT 'SCH-' || meter_no, 'FIXED', 'ALL', NULL, 0, 23, NULL, NULL, NULL, NULL, 10.0::DOUBLE, 'MONTH' FROM c_acct"""
S["document_charges"] = f"""
SELECT meter_id, billing_period_id, sum(quantity)::DOUBLE AS quantity, sum(CAST(quantity * rate AS DECIMAL(14,4)))::DOUBLE AS charge FROM (
  SELECT r.meter_id, r.billing_period_id, CAST(t.rate AS DECIMAL(10,5)) AS rate,
         CAST(least(r.after, coalesce(CAST(t.tier_to_kwh AS DECIMAL(14,4)), r.after))
              - greatest(r.after - r.kwh_delivered, CAST(t.tier_from_kwh AS DECIMAL(14,4))) AS DECIMAL(14,4)) AS quantity
  FROM (SELECT c.*, a.meter_no, sum(kwh_delivered) OVER (PARTITION BY c.meter_id, billing_period_id ORDER BY read_ts
               ROWS UNBOUNDED PRECEDING) AS after FROM c_rated c JOIN c_acct a ON a.meter_id = c.meter_id) r
  JOIN ({S['tariff_components']}) t ON t.schedule_id = 'SCH-' || r.meter_no AND t.component_type = 'ENERGY'
       AND t.day_type = CASE r.day_type WHEN 'HOLIDAY' THEN 'WEEKEND' ELSE r.day_type END AND t.month = month(r.read_ts)
       AND hour(r.read_ts) BETWEEN t.start_hour AND t.end_hour)
WHERE quantity > 0 GROUP BY meter_id, billing_period_id"""
_COMP = "meter_id, billing_period_id, read_ts, schedule_id, component_id, component_type"
S["charge_components"] = f"""
SELECT {_COMP}, tou_bucket, tier_from_kwh::DOUBLE AS tier_from_kwh, quantity::DOUBLE AS quantity, rate::DOUBLE AS rate,
       charge::DOUBLE AS charge FROM c_energy"""
S["demand_charges"] = """
SELECT meter_id, billing_period_id, schedule_id, component_id, component_type, peak_kw::DOUBLE AS peak_kw,
       charge::DOUBLE AS charge FROM c_demand"""
S["fixed_charges"] = f"SELECT {_COMP}, quantity, rate::DOUBLE AS rate, charge::DOUBLE AS charge FROM c_fixed"
S["rider_charges"] = """
SELECT meter_id, billing_period_id, rider_code, applies_to, unit, quantity::DOUBLE AS quantity, rate::DOUBLE AS rate,
       charge::DOUBLE AS charge FROM c_rcharge"""
S["dated_riders"] = """
SELECT meter_id, billing_period_id, rider_code, applies_to, unit, rider_from, days, quantity::DOUBLE AS quantity, rate::DOUBLE AS rate,
       charge::DOUBLE AS charge FROM c_drider"""
S["export_credit"] = """
SELECT meter_id, billing_period_id, read_ts, schedule_id, nem_version, component_type, quantity::DOUBLE AS quantity,
       rate::DOUBLE AS rate, charge::DOUBLE AS charge FROM c_credit"""
S["period_charges"] = """
SELECT meter_id, billing_period_id, component_type, sum(charge)::DOUBLE AS charge FROM (
  SELECT meter_id, billing_period_id, 'ENERGY' AS component_type, charge FROM c_energy
  UNION ALL SELECT meter_id, billing_period_id, component_type, charge FROM c_demand
  UNION ALL SELECT meter_id, billing_period_id, 'FIXED', charge FROM c_fixed
  UNION ALL SELECT meter_id, billing_period_id, 'RIDER', charge FROM c_rcharge
  UNION ALL SELECT meter_id, billing_period_id, 'EXPORT_CREDIT', charge FROM c_credit) GROUP BY ALL"""
S["shadow_bill"] = f"""
SELECT coalesce(a.meter_id, b.meter_id) AS meter_id, coalesce(a.billing_period_id, b.billing_period_id) AS billing_period_id,
       a.c::DOUBLE AS current_charge, b.c::DOUBLE AS shadow_charge, (coalesce(b.c, 0) - coalesce(a.c, 0))::DOUBLE AS delta,
       {pct('coalesce(b.c, 0) - coalesce(a.c, 0)', 'a.c')} AS delta_pct
FROM (SELECT meter_id, billing_period_id, sum(charge) AS c FROM c_energy GROUP BY ALL) a
FULL OUTER JOIN (SELECT meter_id, billing_period_id, sum(charge) AS c FROM c_shadow GROUP BY ALL) b
     ON a.meter_id = b.meter_id AND a.billing_period_id = b.billing_period_id"""
S["peak_exposure"] = "SELECT feeder_id, hour_local, day_of_week, season, hours, peaks, exposure FROM c_expo"
_ISSUE = """issue_id, issue_type, issue_source, feeder_id, meter_id, customer_id, customer_class, is_protected, has_der, schedule_id, status,
 detected_at, var_hourly, var_cumulative"""
S["value_at_risk"] = f"SELECT {_ISSUE} FROM c_var"
_QUEUE = """
SELECT {cols}, duration_hours, priority_score, row_number() OVER (ORDER BY priority_score DESC, issue_id) AS {first},
       row_number() OVER (ORDER BY var_cumulative DESC, issue_id) AS {second}
FROM c_scored"""
S["ops_queue"] = _QUEUE.format(cols=_ISSUE, first="rank", second="dollar_rank")
S["ops_queue_by_dollars"] = _QUEUE.format(cols=_ISSUE, first="priority_rank", second="rank")
S["exposure_total"] = """
SELECT count(*) AS flagged_hours,
       sum(CAST(greatest(CAST(kwh AS DECIMAL(18,6)) - CAST(forecast AS DECIMAL(18,6)), 0) * 0.15 AS DECIMAL(18,4)))::DOUBLE AS exposure
FROM c_fev WHERE is_anomaly"""
S["run_audit"] = """
SELECT 'HOURLY_ROLLUP' AS pipeline_name, 'SUCCESS' AS status, count(*) AS rows_processed, 0::BIGINT AS error_count
FROM c_hourly"""
S["xfm_hourly"] = f"""
SELECT l.transformer_id, l.feeder_id, l.ts, l.kwh::DOUBLE AS kwh, u.usual_u / 1000000.0::DOUBLE AS usual_kwh,
       CAST(CAST(l.kwh * 1000000 AS HUGEINT) - u.usual_u AS DOUBLE) / 1000000 AS deviation_kwh,
       round((CAST(CAST(l.kwh * 1000000 AS HUGEINT) - u.usual_u AS DOUBLE) / 1000000)
             / nullif(u.usual_u / 1000000.0::DOUBLE, 0), 6) AS deviation_ratio
FROM (SELECT p.transformer_id, p.feeder_id, h.rollup_ts AS ts, sum(h.kwh_delivered) AS kwh
      FROM c_hourly h JOIN c_placed p ON p.meter_id = h.meter_id GROUP BY ALL) l
JOIN (SELECT transformer_id, hour(ts) AS hour, {mean_units('kwh', 6)} AS usual_u FROM (
        SELECT p.transformer_id, h.rollup_ts AS ts, sum(h.kwh_delivered) AS kwh
        FROM c_hourly h JOIN c_placed p ON p.meter_id = h.meter_id GROUP BY ALL) GROUP BY transformer_id, hour(ts)) u
     ON u.transformer_id = l.transformer_id AND u.hour = hour(l.ts)"""
S["gap_fill"] = f"""
SELECT meter_id, CAST(read_ts AS DATE) AS day, count(*) AS filled, sum(expected_kwh)::DOUBLE AS kwh_delivered,
       sum(expected_kwh_received)::DOUBLE AS kwh_received, max(expected_kw)::DOUBLE AS demand_kw, min(read_ts) AS first_gap
FROM (SELECT x.meter_id, td.ts_utc AS read_ts, {EXPECTED}
      FROM c_meters x CROSS JOIN c_span s JOIN c_cal td ON CAST(td.ts_utc AS DATE) BETWEEN s.first_day AND s.anchor
      WHERE NOT EXISTS (SELECT 1 FROM c_reads i WHERE i.meter_id = x.meter_id AND i.read_ts = td.ts_utc))
GROUP BY meter_id, CAST(read_ts AS DATE)"""
_LABELS = """
SELECT e.event_id AS label_id, e.meter_id, date_trunc('hour', e.event_ts) AS start_ts,
       date_trunc('hour', e.event_ts) + INTERVAL 3 HOUR AS end_ts
FROM c_mevents e JOIN c_meters m ON m.meter_id = e.meter_id AND m.meter_type = 'CNI' CROSS JOIN c_span s
WHERE e.event_type = 'TAMPER' AND e.event_ts >= s.detect_from"""
_HITS = f"""
SELECT l.label_id, v.meter_id, v.ts, date_diff('hour', l.start_ts, v.ts) AS hours
FROM ({_LABELS}) l JOIN c_mev v ON v.meter_id = l.meter_id AND v.is_anomaly AND v.ts BETWEEN l.start_ts AND l.end_ts"""
S["anomaly_eval"] = f"""
SELECT labels, detected, flagged, true_positives, {pct('detected', 'labels')} AS recall_pct,
       {pct('true_positives', 'flagged')} AS precision_pct, round(hours::DOUBLE / nullif(detected, 0), 6) AS mean_hours_to_detect
FROM (SELECT (SELECT count(*) FROM ({_LABELS})) AS labels, (SELECT count(DISTINCT label_id) FROM ({_HITS})) AS detected,
             (SELECT count(*) FROM c_mev WHERE is_anomaly) AS flagged,
             (SELECT count(*) FROM (SELECT DISTINCT meter_id, ts FROM ({_HITS}))) AS true_positives,
             (SELECT CAST(sum(h) AS BIGINT) FROM (SELECT min(hours) AS h FROM ({_HITS}) GROUP BY label_id)) AS hours)"""
S["retention"] = """
SELECT CAST(ingested_at AS DATE) AS ingest_date, count(*) AS rows FROM c_sent, c_span
WHERE CAST(ingested_at AS DATE) >= anchor - 14 GROUP BY CAST(ingested_at AS DATE)"""
S["rollup_tou"] = "SELECT meter_id, CAST(read_ts AS DATE) AS usage_date, utility_territory, " + ", ".join(
    f"coalesce(sum(CASE WHEN tou_bucket = '{b}' THEN kwh END), 0)::DOUBLE AS kwh_{b.lower()}"
    for b in ("OFF_PEAK", "SHOULDER", "ON_PEAK", "CRITICAL")
) + ", sum(kwh)::DOUBLE AS kwh_total FROM c_line GROUP BY meter_id, CAST(read_ts AS DATE), utility_territory"
S["charges_by_day"] = f"""
SELECT CAST(read_ts AS DATE) AS charge_date, tou_bucket, {SUMS}, {RATE} AS implied_rate FROM c_line
GROUP BY CAST(read_ts AS DATE), tou_bucket"""
S["charges_by_customer"] = f"""
SELECT l.customer_id, rate_plan_id, {SUMS}, {RATE} AS implied_rate
FROM c_line i JOIN c_links l ON l.meter_id = i.meter_id AND l.is_current GROUP BY l.customer_id, rate_plan_id"""
S["charges_by_period"] = f"""
SELECT p.billing_period_id, i.meter_id, {SUMS} FROM c_line i JOIN c_cycles p ON p.meter_id = i.meter_id
     AND CAST(i.read_ts AS DATE) BETWEEN p.start_date AND p.end_date GROUP BY p.billing_period_id, i.meter_id"""
S["sla_by_meter"] = f"SELECT meter_id, utility_territory, {_SLA} FROM ({sla('meter_id, utility_territory', 'meter_id, utility_territory')})"
S["dq_by_feeder"] = f"""
SELECT date_key, feeder_id, {_DQ} FROM ({dq('CAST(read_ts AS DATE) AS date_key, feeder_id', 'CAST(read_ts AS DATE), feeder_id',
    '(SELECT i.*, p.feeder_id FROM c_reads i JOIN c_placed p ON p.meter_id = i.meter_id)')})"""
_MH = """
SELECT 'raw' AS table_name, d AS metric_date, k.metric,
       CASE k.metric WHEN 'ROW_COUNT' THEN n ELSE datesub('second', newest, CAST(d + 1 AS TIMESTAMP)) END AS value
FROM (SELECT CAST(ingested_at AS DATE) AS d, count(*) AS n, max(ingested_at) AS newest FROM c_sent GROUP BY 1)
CROSS JOIN (VALUES ('ROW_COUNT'), ('FRESHNESS_SEC')) k(metric)"""
S["metric_history"] = _MH
S["metric_anomaly"] = f"""
SELECT table_name, metric, metric_date, value, expected, sigma, abs(value - expected) > 3.0::DOUBLE * sigma AS is_anomaly FROM (
  SELECT *, round(s::DOUBLE / n, 6) AS expected,
         round(sqrt((n * q - s * s)::DOUBLE / (n * (n - 1))::DOUBLE), 6) AS sigma FROM (
    SELECT *, count(*) OVER w AS n, CAST(sum(value) OVER w AS HUGEINT) AS s, CAST(sum(value * value) OVER w AS HUGEINT) AS q
    FROM ({_MH}) WINDOW w AS (PARTITION BY table_name, metric ORDER BY metric_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
  WHERE n >= 7)"""
S["estimation_streaks"] = """
SELECT meter_id, first_day, last_day, days, estimated_intervals, days > 3 AS is_sustained FROM c_streaks"""


S["refreshed_channels"], S["refreshed_charges"] = S["channel_daily"], S["charge_line"]
S["refresh_log"] = " UNION ALL ".join(
    f"SELECT 'REFRESH_{mart}' AS name, 'SUCCESS' AS state, count(*) AS rows_processed FROM {table}" for mart, table in (
        ("HOURLY", "c_hourly"), ("DAILY", "c_daily"), ("MONTHLY", "c_monthly"), ("CHANNEL_HOURLY", "c_chour"),
        ("CHANNEL_DAILY", f"({S['channel_daily']}) d"), ("CHARGES", "c_line"), ("SLA", "c_sla"), ("DQ", "c_dq"),
        ("BILLING", "c_bpc"),
    ))
S["refreshed_sla"], S["refreshed_dq"] = S["sla_metrics"], S["dq_metrics"]
for _name in ("billing_stats", "xfm_attribution", "metric_by_territory"):
    S[f"stored_{_name}"] = S[_name]


S["stream_hot"], S["asof_long"], S["retention_purge"] = S["stream_lww"], S["asof_link"], S["retention"]
S["row_policy_meters"] = "SELECT meter_id, meter_type, utility_territory FROM c_meters WHERE utility_territory = 'NE'"
S["sample_per_territory"] = """
SELECT utility_territory, meter_id, read_ts, event_id FROM c_reads
QUALIFY row_number() OVER (PARTITION BY utility_territory
  ORDER BY CAST('0x' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT), event_id) <= 40"""
for _name in ("anomaly_kpi", "top_feeder_anomalies", "top_meter_anomalies", "anomalies_per_day", "xfm_attribution"):
    S[f"scored_{_name}"] = S[_name]
S["routed_by_territory"], S["routed_by_premise"] = S["metric_by_territory"], S["metric_by_premise"]
S["routed_by_type"] = f"""
SELECT m.meter_type AS meter_meter_type, {_METRIC['total_kwh'][0]} AS total_kwh, {_METRIC['total_kwh_net'][0]} AS total_kwh_net,
       count(DISTINCT r.meter_id) AS meter_count
FROM c_daily r JOIN c_meters m ON m.meter_id = r.meter_id GROUP BY m.meter_type"""
S["rolling_meters"] = """
SELECT d.day, m.utility_territory AS meter_territory, count(DISTINCT r.meter_id) AS meters
FROM (SELECT DISTINCT CAST(rollup_ts AS DATE) AS day FROM c_daily) d
JOIN c_daily r ON CAST(r.rollup_ts AS DATE) BETWEEN d.day - 6 AND d.day JOIN c_meters m ON m.meter_id = r.meter_id GROUP BY ALL"""

S["delta_refresh"], S["delta_billing"] = S["incremental_refresh"], S["billing_consumption"]

# Reads by precedence (an actual before an estimate), then the newest; gaps of three days before the cut are estimated.
PARTS["c_best"] = """
SELECT * FROM c_sent QUALIFY row_number() OVER (
  PARTITION BY meter_id, read_ts ORDER BY vee_status <> 'ESTIMATED' DESC, ingested_at DESC, event_id DESC) = 1"""
PARTS["c_filled"] = f"""
SELECT meter_id, read_ts, kwh_delivered, kwh_received, demand_kw, voltage_v, vee_status, utility_territory, FALSE AS made
FROM c_best UNION ALL
SELECT meter_id, read_ts, expected_kwh, expected_kwh_received, expected_kw, NULL, 'ESTIMATED', utility_territory, TRUE
FROM (SELECT x.meter_id, x.utility_territory, td.ts_utc AS read_ts, {EXPECTED}
      FROM c_meters x CROSS JOIN c_span s JOIN c_cal td ON CAST(td.ts_utc AS DATE) BETWEEN s.anchor - 6 AND s.anchor - 4
      WHERE NOT EXISTS (SELECT 1 FROM c_best i WHERE i.meter_id = x.meter_id AND i.read_ts = td.ts_utc))"""
PARTS["c_fhourly"] = PARTS["c_hourly"].replace("c_reads", "c_filled")
PARTS["c_fdaily"] = PARTS["c_daily"].replace("c_hourly", "c_fhourly")
PARTS["c_ftag"] = PARTS["c_tag"].replace("c_reads", "c_filled")
PARTS["c_fline"] = PARTS["c_line"].replace("c_tag", "c_ftag")
S["filled_reads"] = """
SELECT meter_id, CAST(read_ts AS DATE) AS read_date, count(*) AS reads, count(*) FILTER (made) AS filled,
       count(*) FILTER (vee_status = 'ESTIMATED' AND NOT made) AS sent_estimates, sum(kwh_delivered)::DOUBLE AS kwh_delivered
FROM c_filled GROUP BY ALL"""
S["filled_daily"] = f"SELECT 'DAY' AS rollup_grain, {_REFRESHED} FROM c_fdaily"
S["filled_charges"] = S["charges_by_day"].replace("c_line", "c_fline")

# The log of two drained batches: what arrived until a week before the last day, and what arrived later.
PARTS["c_halves"] = """
SELECT c_sent.*, CAST(CASE WHEN ingested_at < CAST(anchor - 7 AS TIMESTAMP) THEN 0 ELSE 1 END AS BIGINT) AS batch FROM c_sent, c_span"""
PARTS["c_first"] = "SELECT * FROM c_halves WHERE batch = 0 QUALIFY row_number() OVER (PARTITION BY meter_id, read_ts ORDER BY ingested_at DESC, event_id DESC) = 1"
PARTS["c_hourly0"] = PARTS["c_hourly"].replace("c_reads", "c_first")
PARTS["c_daily0"] = PARTS["c_daily"].replace("c_hourly", "c_hourly0")
PARTS["c_monthly0"] = PARTS["c_monthly"].replace("c_daily", "c_daily0")
PARTS["c_days1"] = "SELECT DISTINCT CAST(read_ts AS DATE) AS day FROM c_halves WHERE batch = 1"
PARTS["c_log"] = """
SELECT 'READS_TO_CANONICAL' AS name, 'RAW' AS schema_name, 'BATCH' AS action, batch AS batch_id, count(*) AS n, 0::BIGINT AS errors,
       NULL AS message, batch AS turn, 0::BIGINT AS state_rows FROM c_halves GROUP BY batch
UNION ALL SELECT DISTINCT 'READS_TO_CANONICAL', 'RAW', 'STREAM', NULL::BIGINT, NULL::BIGINT, 0::BIGINT, NULL, batch, NULL::BIGINT FROM c_halves
UNION ALL SELECT 'MERGE_CANONICAL', 'CURATED', 'MERGE', batch, count(*), count(*) FILTER (vee_status = 'FAILED'),
       'newest arrival ' || CASE WHEN max(ingested_at) = date_trunc('second', max(ingested_at))
         THEN strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S')
         ELSE rtrim(strftime(max(ingested_at), '%Y-%m-%d %H:%M:%S.%f'), '0') END, batch, NULL FROM c_halves GROUP BY batch""" + "".join(
    f"""
UNION ALL SELECT 'REFRESH_{mart}', 'CURATED', 'FULL', NULL, count(*), 0, NULL, 0, NULL FROM {table}0
UNION ALL SELECT 'REFRESH_{mart}', 'CURATED', 'INCREMENTAL', NULL, count(*), 0, NULL, 1, NULL FROM {table}
WHERE {key} IN (SELECT {day} FROM c_days1)""" for mart, table, key, day in (
        ("HOURLY", "c_hourly", "CAST(rollup_ts AS DATE)", "day"), ("DAILY", "c_daily", "CAST(rollup_ts AS DATE)", "day"),
        ("MONTHLY", "c_monthly", "CAST(rollup_ts AS DATE)", "CAST(date_trunc('month', day) AS DATE)"),
    ))
S["refresh_history"] = """
SELECT name, schema_name, 'SUCCESS' AS state, action AS refresh_action, batch_id, n AS rows_processed, state_rows, TRUE AS is_timed
FROM c_log"""
S["latest_refresh"] = """
SELECT name, schema_name, 'SUCCESS' AS state, action AS refresh_action, n AS rows_processed FROM c_log
WHERE turn = 1 AND action <> 'BATCH'"""
S["audit_recent"] = """
SELECT name AS pipeline_name, 'SUCCESS' AS status, n AS rows_processed, errors AS error_count, message FROM c_log"""


def statements() -> dict[str, str]:
    """All statements with the common tables they need."""
    return {name: with_parts(sql.strip(), PARTS) for name, sql in S.items()}
