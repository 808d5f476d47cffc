"""Common tables of the oracle: feed, dimensions and marts in plain DuckDB SQL."""

from __future__ import annotations

from loadweave.operators import tariff
from loadweave.sources import reference
from oracle.sql import mean, mean_units, pad, pct, pct_units, values

PARTS: dict[str, str] = {}
HOLIDAY_LIST = ", ".join(f"DATE '{d}'" for d in reference.HOLIDAYS)

PARTS["c_span"] = """
SELECT min(ts) AS first_ts, max(ts) AS last_ts, CAST(min(ts) AS DATE) AS first_day, CAST(max(ts) AS DATE) AS anchor,
       CAST(date_trunc('month', min(ts)) AS DATE) AS month_start, last_day(CAST(max(ts) AS DATE)) AS month_end,
       time_bucket(INTERVAL 15 MINUTE, max(ts)) AS last_slot,
       CAST(max(ts) AS DATE) - 6 AS detect_from,
       CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 86399 SECOND AS anchor_end
FROM events"""

PARTS["c_ev"] = """
SELECT user_id, time_bucket(INTERVAL 15 MINUTE, ts) AS read_ts, event_id, ts,
       ts + to_seconds(CASE WHEN event_id % 50 = 0 THEN 1800 + (event_id * 7919) % 12600 ELSE 5 END) AS ingested_at,
       value, CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events"""

PARTS["c_kept"] = """
SELECT * FROM c_ev
QUALIFY row_number() OVER (PARTITION BY user_id, read_ts ORDER BY ingested_at DESC, event_id DESC) = 1"""

PARTS["c_acct"] = f"""
SELECT c_custkey AS meter_no, {pad('MTR-', 'c_custkey', 6)} AS meter_id, {pad('SP-', 'c_custkey', 6)} AS service_point_id,
       {pad('ADDR-', 'c_custkey', 6)} AS address_id, {pad('CUST-', 'c_custkey', 6)} AS customer_id,
       {pad('CIS-', 'c_custkey', 6)} AS cis_account_id,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'CNI' WHEN 'AUTOMOBILE' THEN 'SMB' ELSE 'RES' END AS premise_type,
       c_custkey % 10 = 3 AS has_der,
       CASE n_regionkey WHEN 0 THEN 'NE' WHEN 1 THEN 'SE' WHEN 2 THEN 'MW' ELSE 'W' END AS utility_territory,
       CASE n_regionkey WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'America/Chicago'
            ELSE 'America/Los_Angeles' END AS timezone,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'COMMERCIAL' WHEN 'AUTOMOBILE' THEN 'SMALL_BUSINESS'
            ELSE 'RESIDENTIAL' END AS segment,
       {pad('SUB-', 'n_regionkey', 4)} AS substation_id, {pad('FDR-', 'n_nationkey', 5)} AS feeder_id,
       n_nationkey * 4 + c_custkey % 4 AS transformer_no,
       {pad('XFM-', '(n_nationkey * 4 + c_custkey % 4)', 6)} AS transformer_id,
       CAST(30 + CAST((c_custkey * 37) % 1500 AS DECIMAL(9,2)) * 0.01 AS DECIMAL(9,6)) AS lat,
       CAST(-120 + CAST((c_custkey * 53) % 4500 AS DECIMAL(9,2)) * 0.01 AS DECIMAL(9,6)) AS lon,
       CASE WHEN c_custkey % 10 < 4 THEN 'RP-FLAT' WHEN c_custkey % 10 < 9 THEN 'RP-TOU3' ELSE 'RP-CPP' END AS rate_plan_id,
       c_custkey % 16 = 15 AS is_vacant,
       DATE '2024-01-01' - CAST(365 + (c_custkey * 37) % 3286 AS INTEGER) AS install_date
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

PARTS["c_metered"] = "SELECT * FROM c_acct WHERE meter_no IN (SELECT user_id FROM events)"
PARTS["c_meters"] = """
SELECT meter_id, service_point_id, premise_type AS meter_type, has_der, install_date, 'ACTIVE' AS status,
       utility_territory, timezone, 'FW-' || (meter_no % 4 + 1) || '.0' AS firmware_version
FROM c_metered"""
PARTS["c_sp"] = """
SELECT service_point_id, address_id, premise_type, feeder_id, transformer_id, utility_territory, lat, lon FROM c_metered"""
PARTS["c_cust"] = """
SELECT customer_id, cis_account_id, segment, rate_plan_id, DATE '2023-01-01' AS start_date, CAST(NULL AS DATE) AS end_date
FROM c_metered WHERE NOT is_vacant"""
PARTS["c_xfm"] = """
SELECT DISTINCT transformer_id, feeder_id,
       CAST(CASE transformer_no % 4 WHEN 0 THEN 25 WHEN 1 THEN 50 WHEN 2 THEN 100 ELSE 250 END AS DECIMAL(8,2)) AS kva_rating,
       CASE transformer_no % 2 WHEN 0 THEN 'SINGLE' ELSE 'THREE' END AS phase
FROM c_acct"""
PARTS["c_feeders"] = f"""
SELECT {pad('FDR-', 'n_nationkey', 5)} AS feeder_id, {pad('SUB-', 'n_regionkey', 4)} AS substation_id,
       CASE n_regionkey WHEN 0 THEN 'NE' WHEN 1 THEN 'SE' WHEN 2 THEN 'MW' ELSE 'W' END AS utility_territory,
       CAST(CASE n_nationkey % 3 WHEN 0 THEN 4.16 WHEN 1 THEN 13.2 ELSE 34.5 END AS DECIMAL(6,2)) AS voltage_kv
FROM nation"""
PARTS["c_subs"] = f"""
SELECT {pad('SUB-', 'r_regionkey', 4)} AS substation_id, 'Substation ' || r_name AS substation_name,
       CASE r_regionkey WHEN 0 THEN 'NE' WHEN 1 THEN 'SE' WHEN 2 THEN 'MW' ELSE 'W' END AS utility_territory,
       CAST(30 + CAST((r_regionkey * 37) % 1500 AS DECIMAL(9,2)) * 0.01 AS DECIMAL(9,6)) AS lat,
       CAST(-120 + CAST((r_regionkey * 53) % 4500 AS DECIMAL(9,2)) * 0.01 AS DECIMAL(9,6)) AS lon
FROM region"""
PARTS["c_links"] = """
SELECT meter_id, service_point_id, CASE WHEN NOT is_vacant THEN customer_id END AS customer_id,
       CASE WHEN meter_no % 7 = 0 THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2023-01-01' END AS effective_from,
       CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM c_metered
UNION ALL
SELECT meter_id, service_point_id, CASE WHEN NOT is_vacant THEN customer_id END,
       TIMESTAMP '2023-01-01', TIMESTAMP '2024-01-15', FALSE
FROM c_metered WHERE meter_no % 7 = 0"""


def typed(source: str) -> str:
    return f"""
SELECT a.meter_id, e.read_ts, (e.read_ts AT TIME ZONE 'UTC') AT TIME ZONE a.timezone AS read_local_ts,
       CAST(e.value AS DECIMAL(14,4)) AS kwh_delivered,
       CAST(CASE WHEN a.has_der THEN CAST(e.value / 10 AS DECIMAL(14,4)) ELSE 0 END AS DECIMAL(14,4)) AS kwh_received,
       CAST(e.value * 4 AS DECIMAL(10,4)) AS demand_kw,
       CAST(234 + (e.event_id * 31) % 13 AS DECIMAL(6,2)) AS voltage_v,
       CASE WHEN k = 0 THEN 'F' WHEN k IN (1, 2) THEN 'E' ELSE 'A' END AS quality_flag,
       CASE WHEN k = 0 THEN 'FAILED' WHEN k IN (1, 2) THEN 'ESTIMATED' ELSE 'VALID' END AS vee_status,
       CASE WHEN k IN (1, 2) THEN 'LOAD_PROFILE' END AS estimation_method,
       e.event_id, a.utility_territory, 'feed-' || strftime(e.ingested_at, '%Y%m%d') AS source_file,
       e.ingested_at, datesub('second', e.read_ts, e.ingested_at) AS ingestion_lag_sec, a.meter_no, a.has_der
FROM {source} e JOIN c_acct a ON e.user_id = a.meter_no"""


PARTS["c_sent"] = typed("c_ev")
PARTS["c_reads"] = typed("c_kept")
PARTS["c_mevents"] = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, {pad('MTR-', 'user_id', 6)} AS meter_id, ts AS event_ts,
       CASE event_type WHEN 'error' THEN 'OUTAGE' WHEN 'signup' THEN 'RESTORE' WHEN 'purchase' THEN 'TAMPER'
            ELSE 'COMMS_LOSS' END AS event_type,
       CAST(json_extract(props, '$.k') AS BIGINT) AS payload_k, props
FROM events WHERE event_type IN ('error', 'signup', 'purchase', 'click')"""

PARTS["c_catalog"] = values(reference.CHANNELS, [
    ("channel_code", "VARCHAR"), ("channel_number", "BIGINT"), ("uom", "VARCHAR"), ("direction", "VARCHAR"),
    ("flow_type", "VARCHAR"), ("aggregation", "VARCHAR"), ("description", "VARCHAR"), ("is_active", "BOOLEAN")])
PARTS["c_mch"] = """
SELECT m.meter_id || '-' || k.channel_code AS channel_id, m.meter_id, k.channel_code, k.channel_number, k.uom, k.direction,
       k.aggregation, 15 AS interval_min, 1.0 AS scale_factor, 'ACTIVE' AS status, m.install_date AS effective_from
FROM c_meters m CROSS JOIN c_catalog k
WHERE k.is_active AND (k.channel_code <> 'KWH_REC' OR m.has_der)"""


def unpivot(source: str) -> str:
    out = []
    for code, column, uom in (
        ("KWH_DEL", "kwh_delivered", "KWH"), ("KW_DEM", "demand_kw", "KW"),
        ("VOLT_AVG", "voltage_v", "V"), ("KWH_REC", "kwh_received", "KWH"),
    ):
        keep = " WHERE has_der OR coalesce(kwh_received, 0) <> 0" if code == "KWH_REC" else ""
        out.append(
            f"SELECT meter_id, meter_id || '-{code}' AS channel_id, '{code}' AS channel_code, read_ts, "
            f"CAST({column} AS DECIMAL(14,4)) AS value, '{uom}' AS uom, quality_flag, vee_status, estimation_method, "
            f"event_id, utility_territory, source_file, ingested_at, ingestion_lag_sec FROM {source}{keep}"
        )
    return "\nUNION ALL\n".join(out)


PARTS["c_chan"] = unpivot("c_reads")

PARTS["c_hourly"] = f"""
SELECT meter_id, date_trunc('hour', read_ts) AS rollup_ts, utility_territory, sum(kwh_delivered) AS kwh_delivered,
       sum(kwh_received) AS kwh_received, sum(kwh_delivered - kwh_received) AS kwh_net, max(demand_kw) AS max_demand_kw,
       min(voltage_v) AS min_voltage, max(voltage_v) AS max_voltage, {mean_units('voltage_v', 6)} AS voltage_u,
       count(*) AS n, {pct_units('count(*)', '1')} AS complete_u,
       {pct_units("count(*) FILTER (vee_status = 'VALID')", 'count(*)')} AS pass_u
FROM c_reads GROUP BY ALL"""


def daily(source: str) -> str:
    return f"""
SELECT meter_id, date_trunc('day', rollup_ts) AS rollup_ts, utility_territory, sum(kwh_delivered) AS kwh_delivered,
       sum(kwh_received) AS kwh_received, sum(kwh_net) AS kwh_net, max(max_demand_kw) AS max_demand_kw,
       min(min_voltage) AS min_voltage, max(max_voltage) AS max_voltage, {mean_units('voltage_u', 0)} AS voltage_u,
       CAST(sum(n) AS BIGINT) AS n, {pct_units('sum(n)', '2')} AS complete_u, {mean_units('pass_u', 0)} AS pass_u
FROM {source} GROUP BY meter_id, date_trunc('day', rollup_ts), utility_territory"""


PARTS["c_daily"] = daily("c_hourly")
PARTS["c_monthly"] = f"""
SELECT meter_id, date_trunc('month', rollup_ts) AS rollup_ts, utility_territory, sum(kwh_delivered) AS kwh_delivered,
       sum(kwh_received) AS kwh_received, sum(kwh_net) AS kwh_net, max(max_demand_kw) AS max_demand_kw,
       min(min_voltage) AS min_voltage, max(max_voltage) AS max_voltage, CAST(sum(n) AS BIGINT) AS n,
       {mean_units('complete_u', 0)} AS complete_u, {mean_units('pass_u', 0)} AS pass_u
FROM c_daily GROUP BY meter_id, date_trunc('month', rollup_ts), utility_territory"""

PARTS["c_chour"] = f"""
SELECT c.meter_id, c.channel_code, c.uom, date_trunc('hour', read_ts) AS rollup_ts, c.utility_territory, k.aggregation,
       sum(value) AS total, max(value) AS highest, min(value) AS lowest, {mean_units('value', 4)} AS average_u,
       count(*) AS n, {pct_units('count(*)', '1')} AS complete_u,
       {pct_units("count(*) FILTER (vee_status = 'VALID')", 'count(*)')} AS pass_u
FROM c_chan c JOIN c_mch k ON k.meter_id = c.meter_id AND k.channel_code = c.channel_code
GROUP BY c.meter_id, c.channel_code, c.uom, date_trunc('hour', read_ts), c.utility_territory, k.aggregation"""

PARTS["c_slots"] = """
SELECT unnest(generate_series(CAST(month_start AS TIMESTAMP),
       CAST(month_end AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS ts_utc
FROM c_span"""


def calendar(source: str) -> str:
    return f"""
SELECT ts_utc, CAST(ts_utc AS DATE) AS local_date, hour(ts_utc) * 60 + minute(ts_utc) AS local_minute,
       hour(ts_utc) AS hour_local, dayofweek(ts_utc) AS day_of_week,
       CASE WHEN CAST(ts_utc AS DATE) IN ({HOLIDAY_LIST}) THEN 'HOLIDAY' WHEN dayofweek(ts_utc) IN (0, 6) THEN 'WEEKEND'
            ELSE 'WEEKDAY' END AS day_type,
       month(ts_utc) AS month,
       CASE WHEN month(ts_utc) IN (6, 7, 8, 9) THEN 'SUMMER' WHEN month(ts_utc) IN (12, 1, 2) THEN 'WINTER'
            ELSE 'SHOULDER' END AS season,
       CAST(ts_utc AS DATE) IN ({HOLIDAY_LIST}) AS is_holiday
FROM {source}"""


PARTS["c_cal"] = calendar("c_slots")
PARTS["c_wslots"] = """
SELECT unnest(generate_series(CAST(month_start AS TIMESTAMP) - INTERVAL 1 DAY,
       CAST(month_end AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS ts_utc
FROM c_span"""
PARTS["c_wcal"] = calendar("c_wslots")
PARTS["c_win"] = values(
    [(f"{p}-{d}-{f}", p, d, f, t, b, e, k) for p, d, f, t, b, e, k in reference.RATE_BANDS],
    [("rate_window_id", "VARCHAR"), ("rate_plan_id", "VARCHAR"), ("day_type", "VARCHAR"), ("start_minute", "INTEGER"),
     ("end_minute", "INTEGER"), ("tou_bucket", "VARCHAR"), ("energy_rate_per_kwh", "DECIMAL(8,5)"),
     ("demand_rate_per_kw", "DECIMAL(8,4)")])


def tagged(cal: str, at: str) -> str:
    return f"""
SELECT i.meter_id, i.read_ts, i.kwh_delivered AS kwh, i.demand_kw, i.utility_territory, td.day_type, td.season,
       c.rate_plan_id, w.rate_window_id, w.tou_bucket, w.energy_rate_per_kwh, w.demand_rate_per_kw
FROM c_reads i JOIN c_links l ON l.meter_id = i.meter_id AND l.is_current JOIN c_cust c ON c.customer_id = l.customer_id
JOIN {cal} td ON td.ts_utc = i.{at}
JOIN c_win w ON w.rate_plan_id = c.rate_plan_id AND w.day_type = td.day_type
     AND td.local_minute BETWEEN w.start_minute AND w.end_minute
WHERE i.vee_status IN ('VALID', 'ESTIMATED')"""


PARTS["c_tag"] = tagged("c_cal", "read_ts")
PARTS["c_wtag"] = tagged("c_wcal", "read_local_ts")
PARTS["c_line"] = """
SELECT *, CAST(kwh * energy_rate_per_kwh AS DECIMAL(14,4)) AS energy_charge,
       CAST(((2 * CAST(CAST(demand_kw * demand_rate_per_kw AS DECIMAL(38,8)) * 100000000 AS HUGEINT) + 96 * 10000) // (2 * 96 * 10000))
            AS DECIMAL(18,0)) * 0.0001 AS demand_charge
FROM c_tag"""

PARTS["c_cycles"] = """
SELECT 'BP-' || cis_account_id || '-' || strftime(start_date, '%Y%m%d') AS billing_period_id, cis_account_id,
       service_point_id, 'CYCLE-' || (cycle + 1) AS bill_cycle, start_date, start_date + 9 AS end_date, meter_no, meter_id, cycle
FROM (SELECT m.*, CAST(s.month_start + CAST(g.cycle * 10 AS INTEGER) AS DATE) AS start_date, g.cycle
      FROM c_metered m CROSS JOIN c_span s CROSS JOIN generate_series(0, 1000) g(cycle)
      WHERE s.month_start + CAST(g.cycle * 10 AS INTEGER) <= s.anchor)"""
PARTS["c_billed"] = """
SELECT user_id AS meter_no, (CAST(ts AS DATE) - (SELECT month_start FROM c_span)) // 10 AS cycle,
       sum(CAST(value AS DECIMAL(14,4))) AS sent_kwh
FROM events GROUP BY ALL"""
PARTS["c_periods"] = """
SELECT p.billing_period_id, p.cis_account_id, p.service_point_id, p.bill_cycle, p.start_date, p.end_date,
       CASE WHEN p.meter_no % 20 = 0 THEN NULL WHEN p.meter_no % 20 = 1 THEN 0 ELSE b.sent_kwh END AS cis_billed_kwh
FROM c_cycles p LEFT JOIN c_billed b ON b.meter_no = p.meter_no AND b.cycle = p.cycle"""
PARTS["c_bpc"] = f"""
SELECT p.billing_period_id, p.cis_account_id, p.service_point_id, m.meter_id, p.start_date, p.end_date,
       sum(d.kwh_delivered) AS kwh_total, sum(d.kwh_received) AS kwh_received, sum(d.kwh_net) AS kwh_net,
       max(d.max_demand_kw) AS max_demand_kw, {mean_units('d.complete_u', 0)} AS complete_u,
       {mean_units('d.pass_u', 0)} AS pass_u,
       sum(d.complete_u) >= 9900 * count(*) AND sum(d.pass_u) >= 9700 * count(*) AS is_billing_ready
FROM c_cycles p JOIN c_meters m ON m.service_point_id = p.service_point_id
JOIN c_daily d ON d.meter_id = m.meter_id AND d.rollup_ts BETWEEN p.start_date AND p.end_date
GROUP BY p.billing_period_id, p.cis_account_id, p.service_point_id, m.meter_id, p.start_date, p.end_date"""


def sla(keys: str, group: str, source: str = "c_reads") -> str:
    return f"""
SELECT {keys}, count(*) AS total_reads, round(max(ingestion_lag_sec) / 60, 6) AS max_ingestion_lag_min,
       {pct_units('count(*) FILTER (ingestion_lag_sec <= 900)', 'count(*)')} AS on_time_u,
       count(*) FILTER (ingestion_lag_sec > 900) AS late_arrival_count,
       count(*) FILTER (ingestion_lag_sec > 3600) AS very_late_arrival_count
FROM {source} GROUP BY {group}"""


def dq(keys: str, group: str, source: str = "c_reads") -> str:
    return f"""
SELECT {keys}, count(*) AS total_reads, {pct_units("count(*) FILTER (vee_status = 'VALID')", 'count(*)')} AS pass_u,
       count(*) FILTER (vee_status = 'ESTIMATED') AS estimated_intervals,
       count(*) FILTER (vee_status = 'FAILED') AS failed_intervals,
       2 * count(DISTINCT meter_id) - count(*) AS missing_intervals,
       {pct_units('count(*)', '2 * count(DISTINCT meter_id)')} AS complete_u
FROM {source} GROUP BY {group}"""


DAY_KEY = "CAST(read_ts AS DATE) AS date_key, utility_territory"
DAY_GROUP = "CAST(read_ts AS DATE), utility_territory"
PARTS["c_sla"] = sla(DAY_KEY, DAY_GROUP)
PARTS["c_dq"] = dq(DAY_KEY, DAY_GROUP)
PARTS["c_placed"] = "SELECT meter_id, service_point_id, feeder_id, transformer_id, lat, lon, utility_territory FROM c_metered"


def load(key: str, where: str, source_join: str) -> str:
    return f"""
SELECT {key}, date_trunc('hour', i.read_ts) AS ts, CAST(sum(i.kwh_delivered) AS DECIMAL(18,4)) AS kwh
FROM c_reads i {source_join} CROSS JOIN c_span s WHERE {where} GROUP BY {key}, date_trunc('hour', i.read_ts)"""


TRAIN = "i.vee_status = 'VALID' AND i.read_ts < s.detect_from"
RECENT = "i.read_ts >= s.detect_from"
FEEDER_JOIN = "JOIN c_placed p ON p.meter_id = i.meter_id"
CNI_JOIN = "JOIN c_meters p ON p.meter_id = i.meter_id AND p.meter_type = 'CNI'"
PARTS["c_ftrain"] = load("p.feeder_id", TRAIN, FEEDER_JOIN)
PARTS["c_frecent"] = load("p.feeder_id", RECENT, FEEDER_JOIN)
PARTS["c_mtrain"] = load("i.meter_id", TRAIN, CNI_JOIN)
PARTS["c_mrecent"] = load("i.meter_id", RECENT, CNI_JOIN)


def day_type(ts: str) -> str:
    return (
        f"CASE WHEN CAST({ts} AS DATE) IN ({HOLIDAY_LIST}) THEN 'HOLIDAY' "
        f"WHEN dayofweek({ts}) IN (0, 6) THEN 'WEEKEND' ELSE 'WEEKDAY' END"
    )


def baseline(series: str, train: str) -> str:
    moments = (
        "count(*) AS n, CAST(sum(kwh) AS DECIMAL(18,4)) AS s, "
        "CAST(sum(CAST(kwh AS DECIMAL(14,4)) * CAST(kwh AS DECIMAL(14,4))) AS DECIMAL(27,8)) AS q"
    )
    return f"""
SELECT {series}, day_type, hour, level, n AS points, round(CAST(s AS DOUBLE) / n, 6) AS forecast,
       greatest(coalesce(round(CASE WHEN n > 1 THEN sqrt(
           CAST(CAST(n AS DECIMAL(10,0)) * q - s * s AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE)) END, 6), 0.01::DOUBLE), 0.01::DOUBLE) AS sigma
FROM (
  SELECT g.{series}, g.day_type, g.hour,
         CASE WHEN a.n >= 3 THEN 'DAY_HOUR' WHEN b.n >= 3 THEN 'HOUR' ELSE 'SERIES' END AS level,
         CASE WHEN a.n >= 3 THEN a.n WHEN b.n >= 3 THEN b.n ELSE g.n END AS n,
         CASE WHEN a.n >= 3 THEN a.s WHEN b.n >= 3 THEN b.s ELSE g.s END AS s,
         CASE WHEN a.n >= 3 THEN a.q WHEN b.n >= 3 THEN b.q ELSE g.q END AS q
  FROM (SELECT t.*, d.day_type, h.hour FROM (SELECT {series}, {moments} FROM {train} GROUP BY {series}) t
        CROSS JOIN (VALUES ('WEEKDAY'), ('WEEKEND'), ('HOLIDAY')) d(day_type) CROSS JOIN generate_series(0, 23) h(hour)) g
  LEFT JOIN (SELECT {series}, hour(ts) AS hour, {moments} FROM {train} GROUP BY {series}, hour(ts)) b
       ON b.{series} = g.{series} AND b.hour = g.hour
  LEFT JOIN (SELECT {series}, {day_type('ts')} AS day_type, hour(ts) AS hour, {moments} FROM {train}
             GROUP BY {series}, {day_type('ts')}, hour(ts)) a
       ON a.{series} = g.{series} AND a.day_type = g.day_type AND a.hour = g.hour)"""


def detect(series: str, recent: str, base: str) -> str:
    return f"""
SELECT *, CAST(kwh AS DOUBLE) < lower_bound OR CAST(kwh AS DOUBLE) > upper_bound AS is_anomaly FROM (
  SELECT r.{series}, r.ts, CAST(r.kwh AS DECIMAL(14,4)) AS kwh, b.forecast,
         round(b.forecast - 3.0::DOUBLE * b.sigma, 6) AS lower_bound, round(b.forecast + 3.0::DOUBLE * b.sigma, 6) AS upper_bound,
         round((CAST(CAST(r.kwh AS DECIMAL(14,4)) AS DOUBLE) - b.forecast) / b.sigma, 6) AS distance
  FROM {recent} r JOIN {base} b ON b.{series} = r.{series} AND b.hour = hour(r.ts) AND b.day_type = {day_type('r.ts')})"""


PARTS["c_fbase"] = baseline("feeder_id", "c_ftrain")
PARTS["c_fev"] = detect("feeder_id", "c_frecent", "c_fbase")
PARTS["c_mbase"] = baseline("meter_id", "c_mtrain")
PARTS["c_mev"] = detect("meter_id", "c_mrecent", "c_mbase")
EXCESS = "greatest(CAST(kwh AS DECIMAL(18,6)) - CAST(forecast AS DECIMAL(18,6)), 0)"

PARTS["c_attr"] = f"""
SELECT x.transformer_id, x.feeder_id, x.kva_rating, x.meters, a.hours,
       round(CAST(x.kwh AS DOUBLE) / CAST(f.kwh AS DOUBLE) * 100, 4) AS share_pct,
       round(CAST(x.kwh AS DOUBLE) / CAST(f.kwh AS DOUBLE) * CAST(a.excess AS DOUBLE), 4) AS est_excess_kwh,
       round(CAST(x.kwh AS DOUBLE) / CAST(f.kwh AS DOUBLE) * CAST(a.excess AS DOUBLE) * 0.15::DOUBLE, 4) AS est_dollar_exposure,
       round(a.max_distance, 3) AS max_distance
FROM (SELECT t.transformer_id, t.feeder_id, t.kva_rating, count(DISTINCT p.service_point_id) AS meters,
             sum(d.kwh_delivered) AS kwh
      FROM c_daily d JOIN c_placed p ON p.meter_id = d.meter_id JOIN c_xfm t ON t.transformer_id = p.transformer_id
      CROSS JOIN c_span s WHERE d.rollup_ts >= s.anchor - 30 GROUP BY ALL) x
JOIN (SELECT p.feeder_id, sum(d.kwh_delivered) AS kwh FROM c_daily d JOIN c_placed p ON p.meter_id = d.meter_id
      CROSS JOIN c_span s WHERE d.rollup_ts >= s.anchor - 30 GROUP BY ALL) f ON f.feeder_id = x.feeder_id
JOIN (SELECT feeder_id, count(*) AS hours, sum({EXCESS}) AS excess, max(distance) AS max_distance
      FROM c_fev WHERE is_anomaly GROUP BY ALL) a ON a.feeder_id = x.feeder_id"""

PARTS["c_dup"] = f"""
SELECT meter_id || '|' || strftime(read_ts, '%Y-%m-%d %H:%M') AS duplicate_id, meter_id, utility_territory, read_ts,
       count(*) AS copies, arg_min(kwh_delivered, (ingested_at, event_id)) AS value_first,
       arg_max(kwh_delivered, (ingested_at, event_id)) AS value_second, min(ingested_at) AS received_first,
       max(ingested_at) AS received_second, date_diff('minute', min(ingested_at), max(ingested_at)) AS gap_min,
       '{reference.DUPLICATE_RESOLUTION}' AS resolution, 'KWH_DEL' AS channel_code
FROM c_sent GROUP BY meter_id, utility_territory, read_ts HAVING count(*) > 1"""

PARTS["c_shape"] = f"""
SELECT i.meter_id, m.meter_type,
       {mean('CASE WHEN hour(i.read_ts) BETWEEN 17 AND 21 THEN i.kwh_delivered END', 6)} AS eve,
       {mean('CASE WHEN hour(i.read_ts) BETWEEN 9 AND 16 THEN i.kwh_delivered END', 6)} AS day,
       {mean('CASE WHEN hour(i.read_ts) BETWEEN 0 AND 5 THEN i.kwh_delivered END', 6)} AS night,
       {mean('i.kwh_delivered', 6)} AS overall
FROM c_reads i JOIN c_meters m ON m.meter_id = i.meter_id CROSS JOIN c_span s
WHERE i.read_ts >= s.last_slot - INTERVAL 7 DAY GROUP BY i.meter_id, m.meter_type"""
PARTS["c_wrong"] = """
SELECT row_number() OVER (ORDER BY separation DESC, meter_id) AS rank, * FROM (
  SELECT *, CASE WHEN day / nullif(eve, 0) > 1.15 AND overall >= 0.8 THEN 'CNI'
                 WHEN day / nullif(eve, 0) > 1.05 AND overall < 0.8 THEN 'SMB'
                 WHEN eve / nullif(day, 0) > 1.10 THEN 'RES' ELSE meter_type END AS suggested_type,
         round(abs(eve - day) / nullif(greatest(eve, day), 0), 6) AS separation
  FROM c_shape WHERE eve IS NOT NULL AND day IS NOT NULL AND night IS NOT NULL)
WHERE meter_type <> suggested_type"""
PARTS["c_partial"] = """
SELECT p.meter_id, m.utility_territory, m.meter_type, p.n AS intervals_24h, 2 - p.n AS missing_24h
FROM (SELECT i.meter_id, count(*) AS n FROM c_reads i CROSS JOIN c_span s
      WHERE i.read_ts >= s.last_slot - INTERVAL 1 DAY GROUP BY i.meter_id) p
JOIN c_meters m ON m.meter_id = p.meter_id WHERE p.n < 2"""
PARTS["c_streaks"] = """
SELECT meter_id, min(day) AS first_day, max(day) AS last_day, count(*) AS days, CAST(sum(n) AS BIGINT) AS estimated_intervals
FROM (SELECT meter_id, day, n, day - CAST(row_number() OVER (PARTITION BY meter_id ORDER BY day) AS INTEGER) AS island
      FROM (SELECT meter_id, CAST(read_ts AS DATE) AS day, count(*) AS n FROM c_reads WHERE vee_status = 'ESTIMATED' GROUP BY ALL))
GROUP BY meter_id, island"""


def completeness(where: str) -> str:
    return f"""
SELECT p.feeder_id, count(DISTINCT i.meter_id) AS meters, {mean_units('p.lat', 6)} AS lat_u, {mean_units('p.lon', 6)} AS lon_u,
       {pct_units('count(*)', '2 * 7 * count(DISTINCT i.meter_id)')} AS complete_u
FROM c_reads i JOIN c_placed p ON p.meter_id = i.meter_id CROSS JOIN c_span s WHERE {where} GROUP BY p.feeder_id"""


PARTS["c_fcomp"] = completeness("i.read_ts >= s.anchor - 7 AND i.read_ts <= s.anchor_end")
PARTS["c_froll"] = completeness("i.read_ts >= s.anchor_end - INTERVAL 7 DAY")

# -- tariff ---------------------------------------------------------------------------------------

PARTS["c_comp"] = values(tariff.COMPONENTS, [
    ("component_id", "VARCHAR"), ("schedule_id", "VARCHAR"), ("component_type", "VARCHAR"), ("tou_bucket", "VARCHAR"),
    ("component_day", "VARCHAR"), ("start_minute", "INTEGER"), ("end_minute", "INTEGER"),
    ("tier_from_kwh", "DECIMAL(14,4)"), ("tier_to_kwh", "DECIMAL(14,4)"), ("rate", "DECIMAL(10,5)"), ("unit", "VARCHAR")])
PARTS["c_riders"] = values(tariff.RIDERS, [
    ("rider_code", "VARCHAR"), ("applies_to", "VARCHAR"), ("rate", "DECIMAL(10,5)"), ("unit", "VARCHAR")])
PARTS["c_nem"] = """
SELECT s.schedule_id, s.nem_version, r.export_rate FROM ({}) s JOIN ({}) r ON r.nem_version = s.nem_version""".format(
    values(tariff.SCHEDULE_EXPORT, [("schedule_id", "VARCHAR"), ("nem_version", "VARCHAR")]),
    values(tariff.EXPORT_RATES, [("nem_version", "VARCHAR"), ("export_rate", "DECIMAL(10,5)")]))
PARTS["c_assign"] = """
SELECT meter_id, CASE rate_plan_id WHEN 'RP-FLAT' THEN 'S-TIERED' WHEN 'RP-TOU3' THEN 'S-TOU' ELSE 'S-LARGE' END AS schedule_id,
       TIMESTAMP '2023-01-01' AS effective_from,
       CASE WHEN meter_no % 5 = 0 AND rate_plan_id = 'RP-FLAT' THEN TIMESTAMP '2024-01-16' END AS effective_to
FROM c_metered WHERE NOT is_vacant
UNION ALL
SELECT meter_id, 'S-TOU', TIMESTAMP '2024-01-16', NULL FROM c_metered
WHERE NOT is_vacant AND meter_no % 5 = 0 AND rate_plan_id = 'RP-FLAT'"""
PARTS["c_rated"] = """
SELECT i.meter_id, i.read_ts, i.kwh_delivered, i.kwh_received, i.demand_kw, a.schedule_id, p.billing_period_id,
       td.day_type, td.local_minute
FROM c_reads i
JOIN c_assign a ON a.meter_id = i.meter_id AND i.read_ts >= a.effective_from
     AND (a.effective_to IS NULL OR i.read_ts < a.effective_to)
JOIN c_cycles p ON p.meter_id = i.meter_id AND CAST(i.read_ts AS DATE) BETWEEN p.start_date AND p.end_date
JOIN c_cal td ON td.ts_utc = i.read_ts
WHERE i.vee_status IN ('VALID', 'ESTIMATED')"""
MATCH = (
    "(c.component_day = 'ALL' OR c.component_day = r.day_type) AND r.local_minute BETWEEN c.start_minute AND c.end_minute"
)


def energy(schedule: str) -> str:
    return f"""
SELECT *, CAST(quantity * rate AS DECIMAL(14,4)) AS charge FROM (
  SELECT r.meter_id, r.billing_period_id, r.read_ts, c.schedule_id, c.component_id, c.component_type, c.tou_bucket,
         c.tier_from_kwh, c.rate,
         CAST(least(r.after, coalesce(c.tier_to_kwh, r.after)) - greatest(r.after - r.kwh_delivered, c.tier_from_kwh)
              AS DECIMAL(14,4)) AS quantity
  FROM (SELECT *, sum(kwh_delivered) OVER (PARTITION BY meter_id, billing_period_id ORDER BY read_ts
               ROWS UNBOUNDED PRECEDING) AS after FROM c_rated) r
  JOIN c_comp c ON c.schedule_id = {schedule} AND c.component_type = 'ENERGY' AND {MATCH})
WHERE quantity > 0"""


PARTS["c_energy"] = energy("r.schedule_id")
PARTS["c_shadow"] = energy("'S-TOU'")
PARTS["c_demand"] = f"""
SELECT r.meter_id, r.billing_period_id, r.schedule_id, c.component_id, c.component_type, max(r.demand_kw) AS peak_kw,
       CAST(max(r.demand_kw * c.rate) AS DECIMAL(14,4)) AS charge
FROM c_rated r JOIN c_comp c ON c.schedule_id = r.schedule_id AND c.component_type IN ('DEMAND', 'DEMAND_FACILITY') AND {MATCH}
GROUP BY ALL"""
# Cumulative amounts in units of 10^-4, rounded half up; rates have five decimals.
_UPTO = "((2 * CAST(c.rate * 100000 AS HUGEINT) * ({i}) + 10 * n) // (2 * 10 * n))"
PARTS["c_fixed"] = f"""
SELECT r.meter_id, r.billing_period_id, r.read_ts, r.schedule_id, c.component_id, 'FIXED' AS component_type,
       round(1.0::DOUBLE / n, 6) AS quantity, c.rate,
       CAST({_UPTO.format(i='i')} - {_UPTO.format(i='i - 1')} AS DECIMAL(18,0)) * 0.0001 AS charge
FROM (SELECT *, row_number() OVER (PARTITION BY meter_id, billing_period_id, schedule_id ORDER BY read_ts) AS i,
             count(*) OVER (PARTITION BY meter_id, billing_period_id) AS n FROM c_rated) r
JOIN c_comp c ON c.schedule_id = r.schedule_id AND c.component_type = 'FIXED'"""
PARTS["c_credit"] = """
SELECT r.meter_id, r.billing_period_id, r.read_ts, r.schedule_id, x.nem_version, 'EXPORT_CREDIT' AS component_type,
       r.kwh_received AS quantity, x.export_rate AS rate, CAST(-(r.kwh_received * x.export_rate) AS DECIMAL(14,4)) AS charge
FROM c_rated r JOIN c_nem x ON x.schedule_id = r.schedule_id WHERE r.kwh_received > 0"""
PARTS["c_rcharge"] = """
SELECT *, CAST(quantity * rate AS DECIMAL(14,4)) AS charge FROM (
  SELECT u.meter_id, u.billing_period_id, k.rider_code, k.applies_to, k.unit, k.rate,
         CAST(CASE k.unit WHEN 'KWH' THEN CASE k.applies_to WHEN 'RECEIVED' THEN u.received ELSE u.delivered END
                   WHEN 'METER_DAY' THEN CAST(u.days AS DECIMAL(18,4))
                   ELSE CAST(coalesce(e.charge, 0) AS DECIMAL(18,4)) * 0.01 END AS DECIMAL(18,6)) AS quantity
  FROM (SELECT meter_id, billing_period_id, CAST(sum(kwh_delivered) AS DECIMAL(18,4)) AS delivered,
               CAST(sum(kwh_received) AS DECIMAL(18,4)) AS received, count(DISTINCT CAST(read_ts AS DATE)) AS days
        FROM c_rated GROUP BY ALL) u
  LEFT JOIN (SELECT meter_id, billing_period_id, sum(charge) AS charge FROM c_energy GROUP BY ALL) e
       ON e.meter_id = u.meter_id AND e.billing_period_id = u.billing_period_id
  CROSS JOIN c_riders k)"""
PARTS["c_versions"] = values(tariff.RIDER_VERSIONS, [
    ("rider_code", "VARCHAR"), ("applies_to", "VARCHAR"), ("rate", "DECIMAL(10,5)"), ("unit", "VARCHAR"),
    ("rider_from", "DATE"), ("rider_to", "DATE")])
PARTS["c_drider"] = """
SELECT *, CAST(quantity * rate AS DECIMAL(14,4)) AS charge FROM (
  SELECT u.meter_id, u.billing_period_id, k.rider_code, k.applies_to, k.unit, k.rider_from, k.rate, count(*) AS days,
         CAST(CASE k.unit WHEN 'KWH' THEN CAST(sum(CASE k.applies_to WHEN 'RECEIVED' THEN u.received ELSE u.delivered END) AS DECIMAL(18,4))
                   WHEN 'KW' THEN CAST(max(u.peak) AS DECIMAL(18,4)) WHEN 'METER_DAY' THEN CAST(count(*) AS DECIMAL(18,4))
                   ELSE CAST(coalesce(sum(e.charge), 0) AS DECIMAL(18,4)) * 0.01 END AS DECIMAL(18,6)) AS quantity
  FROM (SELECT meter_id, billing_period_id, CAST(read_ts AS DATE) AS day, sum(kwh_delivered) AS delivered,
               sum(kwh_received) AS received, max(demand_kw) AS peak FROM c_rated GROUP BY ALL) u
  LEFT JOIN (SELECT meter_id, billing_period_id, CAST(read_ts AS DATE) AS day, sum(charge) AS charge FROM c_energy GROUP BY ALL) e
       ON e.meter_id = u.meter_id AND e.billing_period_id = u.billing_period_id AND e.day = u.day
  JOIN c_versions k ON u.day >= k.rider_from AND (k.rider_to IS NULL OR u.day < k.rider_to)
  GROUP BY u.meter_id, u.billing_period_id, k.rider_code, k.applies_to, k.unit, k.rider_from, k.rate)"""
PARTS["c_fload"] = load("p.feeder_id", "TRUE", FEEDER_JOIN)
PARTS["c_expo"] = """
SELECT feeder_id, hour_local, day_of_week, season, count(*) AS hours, count(*) FILTER (ts = peak_ts) AS peaks,
       round(count(*) FILTER (ts = peak_ts) / count(*), 6) AS exposure
FROM (SELECT l.feeder_id, l.ts, td.hour_local, td.day_of_week, td.season,
             first_value(l.ts) OVER (PARTITION BY l.feeder_id, (CAST(l.ts AS DATE) - s.month_start) // 10
                                     ORDER BY l.kwh DESC, l.ts) AS peak_ts
      FROM c_fload l JOIN c_cal td ON td.ts_utc = l.ts CROSS JOIN c_span s)
GROUP BY ALL"""
PARTS["c_issues"] = """
SELECT f.*, a.customer_id, a.has_der, v.schedule_id, 'OPEN' AS status, a.segment AS customer_class,
       a.meter_no % 8 = 0 AS is_protected, td.day_type, td.season FROM (
  SELECT 'EV-' || event_id AS issue_id, event_type AS issue_type, 'METER_EVENT' AS issue_source, meter_id,
         date_trunc('second', event_ts) AS detected_at
  FROM c_mevents, c_span WHERE event_type <> 'RESTORE' AND event_ts >= detect_from
  UNION ALL
  SELECT 'AN-' || meter_id || '-' || strftime(ts, '%Y%m%d%H'), 'ANOMALY', 'METER_ANOMALY', meter_id, ts
  FROM c_mev WHERE is_anomaly
  UNION ALL
  SELECT 'ES-' || meter_id || '-' || strftime(c_streaks.first_day, '%Y%m%d'), 'SUSTAINED_ESTIMATION', 'DATA_QUALITY', meter_id,
         CAST(last_day AS TIMESTAMP)
  FROM c_streaks, c_span WHERE days > 1 AND last_day >= detect_from) f
JOIN c_acct a ON a.meter_id = f.meter_id
LEFT JOIN c_assign v ON v.meter_id = f.meter_id AND f.detected_at >= v.effective_from
     AND (v.effective_to IS NULL OR f.detected_at < v.effective_to)
JOIN c_cal td ON td.ts_utc = date_trunc('hour', f.detected_at)"""
PARTS["c_usual"] = f"""
SELECT i.meter_id, hour(i.read_ts) AS hour, {mean('i.kwh_delivered', 6)} AS usual_kwh,
       {mean('i.kwh_received', 6)} AS usual_export, max(i.demand_kw) AS usual_kw
FROM c_reads i CROSS JOIN c_span s WHERE {TRAIN} GROUP BY i.meter_id, hour(i.read_ts)"""
PARTS["c_var"] = """
SELECT issue_id, issue_type, issue_source, feeder_id, meter_id, customer_id, customer_class, is_protected, has_der, schedule_id, status,
       detected_at, var_hourly,
       round(var_hourly * resolve_hours, 4) AS var_cumulative
FROM (
  SELECT i.*, p.feeder_id,
         CASE i.issue_type WHEN 'OUTAGE' THEN 4.0 WHEN 'TAMPER' THEN 48.0 WHEN 'COMMS_LOSS' THEN 24.0 WHEN 'ANOMALY' THEN 24.0
              ELSE 72.0 END::DOUBLE AS resolve_hours,
         round(coalesce(u.usual_kwh, 0::DOUBLE) * coalesce(CAST(w.energy_rate_per_kwh AS DOUBLE), 0::DOUBLE)
           - coalesce(u.usual_export, 0::DOUBLE) * coalesce(CAST(x.export_rate AS DOUBLE), 0::DOUBLE)
           + coalesce(CAST(u.usual_kw AS DOUBLE), 0::DOUBLE) * coalesce(CAST(w.demand_rate_per_kw AS DOUBLE), 0::DOUBLE)
             * coalesce(e.exposure, 0::DOUBLE) / 240.0::DOUBLE
           + CASE i.issue_type WHEN 'OUTAGE' THEN 5.0 WHEN 'TAMPER' THEN 1.0 WHEN 'COMMS_LOSS' THEN 0.5 WHEN 'ANOMALY' THEN 0.0
                  ELSE 0.25 END::DOUBLE, 4) AS var_hourly
  FROM c_issues i
  JOIN c_placed p ON p.meter_id = i.meter_id
  LEFT JOIN c_usual u ON u.meter_id = i.meter_id AND u.hour = hour(i.detected_at)
  LEFT JOIN c_metered m ON m.meter_id = i.meter_id AND NOT m.is_vacant
  LEFT JOIN c_win w ON w.rate_plan_id = m.rate_plan_id AND w.day_type = i.day_type
       AND hour(i.detected_at) * 60 BETWEEN w.start_minute AND w.end_minute
  LEFT JOIN c_expo e ON e.feeder_id = p.feeder_id AND e.hour_local = hour(i.detected_at)
       AND e.day_of_week = dayofweek(i.detected_at) AND e.season = i.season
  LEFT JOIN (SELECT a.meter_id, n.export_rate FROM c_assign a JOIN c_nem n ON n.schedule_id = a.schedule_id
             WHERE a.effective_to IS NULL) x ON x.meter_id = i.meter_id)
UNION ALL
SELECT 'FA-' || feeder_id || '-' || strftime(ts, '%Y%m%d%H'), 'ANOMALY', 'FEEDER_ANOMALY', feeder_id, NULL, NULL, NULL, FALSE, NULL,
       NULL, 'OPEN', ts, CAST(CAST(forecast AS DECIMAL(18,6)) * 0.15 AS DECIMAL(18,4))::DOUBLE,
       (CAST(CAST(forecast AS DECIMAL(18,6)) * 0.15 AS DECIMAL(18,4)) * 24)::DOUBLE
FROM c_fev WHERE is_anomaly"""
PARTS["c_scored"] = """
SELECT v.*, datesub('hour', detected_at, anchor_end) AS duration_hours,
       round(log10(1.0::DOUBLE + greatest(var_cumulative, 0.0::DOUBLE))
         * (1.0::DOUBLE + 0.5::DOUBLE * least(1.0::DOUBLE, datesub('hour', detected_at, anchor_end) / 4.0::DOUBLE))
         * CASE customer_class WHEN 'COMMERCIAL' THEN 1.0 WHEN 'SMALL_BUSINESS' THEN 0.85 ELSE 0.7 END::DOUBLE
         + CASE WHEN is_protected THEN 0.5 ELSE 0.0 END::DOUBLE, 4) AS priority_score
FROM c_var v CROSS JOIN c_span"""

__all__ = ["PARTS", "completeness", "dq", "mean", "pct", "sla", "typed", "unpivot"]
