"""Arrival SLA, data quality, table metrics and the run log."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loadweave.functions import pct, seconds_between
from loadweave.sources.reference import (
    ON_TIME_LIMIT_SEC, SLA_BREACH_MESSAGE, SLA_THRESHOLD_PCT, VERY_LATE_LIMIT_SEC,
)
from loadweave.sources.schemas import RUN_AUDIT


def sla(reads: DataFrame, keys: list[Column | str] | None = None) -> DataFrame:
    """Arrival lag per day and territory (or any keys).

    An unknown lag is not on time for the percentage, and not late for the counts.
    """
    lag, n = F.col("ingestion_lag_sec"), F.count(F.lit(1))
    keys = keys or [F.to_date("read_ts").alias("date_key"), "utility_territory"]
    return reads.groupBy(*keys).agg(
        n.alias("total_reads"),
        F.round(F.max(lag) / 60, 6).alias("max_ingestion_lag_min"),
        pct(F.count_if(lag <= ON_TIME_LIMIT_SEC), n).alias("pct_arrived_within_15min"),
        F.count_if(lag > ON_TIME_LIMIT_SEC).alias("late_arrival_count"),
        F.count_if(lag > VERY_LATE_LIMIT_SEC).alias("very_late_arrival_count"),
    )


def data_quality(
    reads: DataFrame, expected_per_day: int = 96, keys: list[Column | str] | None = None
) -> DataFrame:
    """Validation mix and completeness per day and territory (or any keys).

    Meters are counted in two steps: per key and meter first, then per key. Four territories would
    otherwise send a day's reads to four tasks.
    """
    keys = keys or [F.to_date("read_ts").alias("date_key"), "utility_territory"]
    status = F.col("vee_status")
    keyed = reads.select(*keys, F.col("meter_id").alias("counted_meter"), "vee_status")
    names = [c for c in keyed.columns if c not in ("counted_meter", "vee_status")]
    per_meter = keyed.groupBy(*names, "counted_meter").agg(
        F.count(F.lit(1)).alias("reads"),
        *[F.count_if(status == s).alias(s.lower()) for s in ("VALID", "ESTIMATED", "FAILED")],
    )
    n, expected = F.sum("reads"), F.lit(expected_per_day) * F.count(F.lit(1))
    return per_meter.groupBy(*names).agg(
        n.alias("total_reads"),
        pct(F.sum("valid"), n).alias("vee_pass_rate"),
        F.sum("estimated").alias("estimated_intervals"),
        F.sum("failed").alias("failed_intervals"),
        (expected - n).alias("missing_intervals"),
        pct(n, expected).alias("completeness_pct"),
    )


def unified(sla_rows: DataFrame, dq_rows: DataFrame, coalesce_keys: bool = False) -> DataFrame:
    """SLA and quality side by side.

    By default keys come from the SLA side alone, so a day known only to the quality side shows null
    keys; ``coalesce_keys`` fills them.
    """
    s, q = sla_rows.alias("s"), dq_rows.alias("q")
    same = (F.col("s.date_key") == F.col("q.date_key")) & (
        F.col("s.utility_territory") == F.col("q.utility_territory")
    )

    def key(name: str) -> Column:
        own = F.col(f"s.{name}")
        return (F.coalesce(own, F.col(f"q.{name}")) if coalesce_keys else own).alias(name)

    return s.join(q, same, "full_outer").select(
        key("date_key"), key("utility_territory"),
        "s.total_reads", "s.max_ingestion_lag_min", "s.pct_arrived_within_15min", "s.late_arrival_count",
        "q.vee_pass_rate", "q.estimated_intervals", "q.failed_intervals", "q.missing_intervals",
        "q.completeness_pct",
    )


def observability(reads: DataFrame, expected_per_day: int = 96) -> DataFrame:
    """SLA and quality per day and territory, from one aggregation of the reads.

    Meters first, then the key, as in ``data_quality``; the arrival figures add up over meters.
    """
    lag, status, one = F.col("ingestion_lag_sec"), F.col("vee_status"), F.lit(1)
    per_meter = reads.groupBy(F.to_date("read_ts").alias("date_key"), "utility_territory", "meter_id").agg(
        F.count(one).alias("reads"), F.max(lag).alias("longest"),
        F.count_if(lag <= ON_TIME_LIMIT_SEC).alias("on_time"), F.count_if(lag > ON_TIME_LIMIT_SEC).alias("late"),
        *[F.count_if(status == s).alias(s.lower()) for s in ("VALID", "ESTIMATED", "FAILED")],
    )
    n, expected = F.sum("reads"), F.lit(expected_per_day) * F.count(one)
    return per_meter.groupBy("date_key", "utility_territory").agg(
        n.alias("total_reads"), F.round(F.max("longest") / 60, 6).alias("max_ingestion_lag_min"),
        pct(F.sum("on_time"), n).alias("pct_arrived_within_15min"), F.sum("late").alias("late_arrival_count"),
        pct(F.sum("valid"), n).alias("vee_pass_rate"), F.sum("estimated").alias("estimated_intervals"),
        F.sum("failed").alias("failed_intervals"), (expected - n).alias("missing_intervals"),
        pct(n, expected).alias("completeness_pct"),
    )


def breach_alerts(
    sla_rows: DataFrame, as_of: Column, threshold: float = SLA_THRESHOLD_PCT, now: Column | None = None
) -> DataFrame:
    """One audit row if any territory of the day ``as_of`` arrived below the threshold, else none."""
    now = (now if now is not None else as_of).cast("timestamp_ntz")
    hit = sla_rows.filter(
        (F.col("date_key") == as_of) & (F.col("pct_arrived_within_15min") < threshold)
    ).agg(F.count(F.lit(1)).alias("breaches")).filter("breaches > 0")
    return hit.select(
        F.lit("SLA_BREACH_ALERT").alias("pipeline_name"),
        F.sha2(F.concat(F.lit("SLA_BREACH_ALERT"), now.cast("string")), 256).alias("run_id"),
        now.alias("start_time"), now.alias("end_time"),
        F.lit("ALERT").alias("status"),
        F.lit(0).cast("bigint").alias("rows_processed"),
        F.lit(1).cast("bigint").alias("error_count"),
        F.lit(SLA_BREACH_MESSAGE.format(f"{threshold:g}")).alias("message"),
    )


def _rows(df: DataFrame) -> Column:
    """Number of rows; of a frame that was counted before (``n_rows``), the rows it stands for."""
    return F.coalesce(F.sum("n_rows"), F.lit(0)) if "n_rows" in df.columns else F.count(F.lit(1))


def table_metrics(tables: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """Row count and freshness in seconds of each table, long form."""
    parts = []
    for name, df in tables.items():
        one = df.agg(_rows(df).alias("n"), F.max("ingested_at").alias("newest"))
        parts.append(one.select(
            F.lit(name).alias("table_name"),
            F.explode(F.create_map(
                F.lit("ROW_COUNT"), F.col("n"),
                F.lit("FRESHNESS_SEC"), seconds_between(F.col("newest"), as_of),
            )).alias("metric", "value"),
            as_of.alias("measured_at"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def metric_history(df: DataFrame, table_name: str) -> DataFrame:
    """Row count and arrival freshness of a table per ingestion day."""
    day = F.to_date("ingested_at")
    per_day = df.groupBy(day.alias("metric_date")).agg(
        _rows(df).alias("n"), F.max("ingested_at").alias("newest")
    )
    day_end = F.date_add("metric_date", 1).cast("timestamp_ntz")
    return per_day.select(
        F.lit(table_name).alias("table_name"), "metric_date",
        F.explode(F.create_map(
            F.lit("ROW_COUNT"), F.col("n"),
            F.lit("FRESHNESS_SEC"), seconds_between(F.col("newest"), day_end),
        )).alias("metric", "value"),
    )


def metric_anomalies(history: DataFrame, window: int = 28, min_points: int = 7, k: float = 3.0) -> DataFrame:
    """Days on which a metric leaves the band of its preceding ``window`` measurements.

    Sums stay integral, so the band is exact. The history has one row per metric and day.
    """
    w = Window.partitionBy("table_name", "metric").orderBy("metric_date").rowsBetween(-window, -1)
    v = F.col("value").cast("decimal(18,0)")
    n, s, q = F.count("value").over(w), F.sum(v).over(w), F.sum(v * v).over(w)
    banded = history.select(
        "table_name", "metric", "metric_date", "value", n.alias("n"), s.alias("s"), q.alias("q")
    ).filter(F.col("n") >= min_points)
    spread = F.sqrt(
        (F.col("n") * F.col("q") - F.col("s") * F.col("s")).cast("double") / (F.col("n") * (F.col("n") - 1))
    )
    return (
        banded.withColumn("expected", F.round(F.col("s").cast("double") / F.col("n"), 6))
        .withColumn("sigma", F.round(spread, 6))
        .select(
            "table_name", "metric", "metric_date", "value", "expected", "sigma",
            (F.abs(F.col("value") - F.col("expected")) > k * F.col("sigma")).alias("is_anomaly"),
        )
    )


# -- run log --------------------------------------------------------------------------------------


class RunLog:
    """Append-only log of job runs and stream batches; the newest row of a run is its state."""

    def __init__(self, spark: SparkSession, path: str, schema_name: str = "CURATED"):
        self.spark, self.path, self.schema_name = spark, path, schema_name
        #: Two appends at once would clear each other's unfinished files.
        self._writing = threading.Lock()

    def append(self, *rows: dict) -> None:
        """Rows by column name; columns that are not named are null."""
        made = [tuple({"schema_name": self.schema_name, **row}.get(f.name) for f in RUN_AUDIT) for row in rows]
        with self._writing:
            self.spark.createDataFrame(made, RUN_AUDIT).coalesce(1).write.mode("append").parquet(self.path)

    def run(self, pipeline: str, job: Callable[[], int | dict], action: str | None = None) -> int:
        """Run ``job`` between a start and an end record.

        It returns its number of rows, or a row of the log with ``rows_processed`` and what else it knows.
        """
        start = dt.datetime.now()
        known = {"pipeline_name": pipeline, "run_id": uuid.uuid4().hex, "start_time": start, "refresh_action": action}
        self.append({**known, "status": "RUNNING"})
        try:
            done = job()
        except Exception as error:
            self.append({**known, "end_time": dt.datetime.now(), "status": "FAILED", "error_count": 1, "message": str(error)})
            raise
        told = done if isinstance(done, dict) else {"rows_processed": done}
        self.append({**known, "end_time": dt.datetime.now(), "status": "SUCCESS", "error_count": 0, **told})
        return told["rows_processed"]

    def read(self) -> DataFrame:
        """One row per run, in its latest state."""
        rows = self.spark.read.schema(RUN_AUDIT).parquet(self.path)
        finished = F.when(F.col("end_time").isNull(), 0).otherwise(1)
        return rows.groupBy("pipeline_name", "run_id").agg(
            F.max_by(F.struct(*[c for c in rows.columns if c not in ("pipeline_name", "run_id")]), finished).alias("s")
        ).select("pipeline_name", "run_id", "s.*")


def refresh_history(runs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    since = as_of - F.make_dt_interval(days=F.lit(days))
    return runs.filter(F.col("start_time").between(since, as_of)).select(
        F.col("pipeline_name").alias("name"), "run_id", F.col("status").alias("state"),
        "start_time", "end_time",
        F.timestamp_diff("SECOND", "start_time", "end_time").alias("duration_sec"),
        "rows_processed", "schema_name", "refresh_action", "batch_id", "state_rows", "state_bytes",
    )


def latest_per_name(history: DataFrame) -> DataFrame:
    rest = [c for c in history.columns if c != "name"]
    return history.groupBy("name").agg(
        F.max_by(F.struct(*rest), F.struct("end_time", "run_id")).alias("latest")
    ).select("name", "latest.*")
