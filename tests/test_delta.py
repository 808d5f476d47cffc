"""Rollups that take changes equal rollups that are computed again, and read no more than the changes."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loadweave.operators import billing, ingest, quality, rollups
from loadweave.sources import tables
from loadweave.streaming import delta, pipeline
from loadweave.streaming.progress import ProgressLog
from loadweave.streaming.refresh import Dimensions

SCHEMA = (
    "meter_id string, read_ts timestamp_ntz, kwh_delivered decimal(14,4), kwh_received decimal(14,4), demand_kw decimal(10,4),"
    " voltage_v decimal(6,2), vee_status string, utility_territory string, ingested_at timestamp_ntz, event_id bigint, read_date date"
)
T0 = dt.datetime(2024, 1, 30)


def made(rng, n, first_id):
    def number(low, high, scale):
        return None if rng.random() < 0.2 else Decimal(rng.randint(low, high)).scaleb(-scale)

    rows = []
    for k in range(n):
        ts = T0 + dt.timedelta(days=rng.randint(0, 3), minutes=15 * rng.randint(0, 11))
        rows.append((
            f"M{rng.randint(0, 3)}", ts, number(0, 99_999, 4), number(0, 9_999, 4), number(0, 5, 1), number(2_300, 2_305, 1),
            rng.choice(["VALID", "VALID", "ESTIMATED", "FAILED"]), rng.choice(["NE", "NE", "SE"]),
            T0 + dt.timedelta(hours=rng.randint(0, 500)), first_id + k, ts.date(),
        ))
    return rows


@pytest.fixture(scope="module")
def dims(spark):
    periods = spark.createDataFrame(
        [(f"P{m}{k}", f"C{m}", f"S{m}", first, first + dt.timedelta(days=days)) for m in range(4)
         for k, (first, days) in enumerate([(dt.date(2024, 1, 29), 2), (dt.date(2024, 2, 1), 9), (dt.date(2024, 1, 31), 1)])],
        "billing_period_id string, cis_account_id string, service_point_id string, start_date date, end_date date",
    )
    meters = spark.createDataFrame([(f"M{m}", f"S{m}") for m in range(4)], "meter_id string, service_point_id string")
    return Dimensions(meters, meters, meters, meters, meters, periods)


def full(spark, rows, dims):
    reads = ingest.last_write_wins(spark.createDataFrame(rows, SCHEMA), pipeline.READ_KEYS, pipeline.NEWEST)
    hours = rollups.hourly(reads, 4)
    days = rollups.daily(hours, 96)
    return {
        "hourly": hours, "daily": days, "monthly": rollups.monthly(days),
        "billing": billing.consumption(dims.periods, dims.meters, days),
    }


def take(spark, marts, rows, staging):
    frame = spark.createDataFrame(rows, SCHEMA)
    tables.upsert(frame, marts.canonical, staging, pipeline.READ_KEYS, pipeline.NEWEST, "read_date")
    changed = tables.changes_of(spark, staging, "read_date")
    if changed is not None:
        marts.take(changed, staging)


def same(marts, want):
    for name, frame in want.items():
        got = marts.read(name).select(*frame.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, frame.collect())), name


@pytest.mark.parametrize("seed", [1])
def test_any_order_of_batches_gives_the_full_computation(spark, tmp_path, dims, seed):
    rng = random.Random(seed)
    batches = [made(rng, n, 1_000 * k) for k, n in enumerate((60, 25, 25))]
    rng.shuffle(batches)
    marts = delta.DeltaMarts(spark, str(tmp_path / "marts"), 4, 96, dims, wider=("billing",))
    for k, rows in enumerate(batches):
        take(spark, marts, rows, str(tmp_path / f"s{k}"))
    same(marts, full(spark, [r for b in batches for r in b], dims))
    take(spark, marts, batches[0], str(tmp_path / "again"))  # nothing in it is newer
    same(marts, full(spark, [r for b in batches for r in b], dims))


def test_new_reads_need_no_other_reads_and_lost_extremes_only_their_days(spark, tmp_path, dims, monkeypatch):
    marts = delta.DeltaMarts(spark, str(tmp_path / "marts"), 4, 96, dims, wider=("billing",))
    asked = []
    below = delta.DeltaMarts._below
    monkeypatch.setattr(delta.DeltaMarts, "_below", lambda self, name: lambda days: (asked.append((name, sorted(days))), below(self, name)(days))[1])

    def read(minute, kw, arrived, day=0):
        ts = T0 + dt.timedelta(days=day, minutes=minute)
        return ("M0", ts, Decimal(1), Decimal(0), Decimal(kw), Decimal(230), "VALID", "NE", T0 + dt.timedelta(hours=arrived), arrived, ts.date())

    rows = [read(0, 5, 1), read(0, 5, 1, 1)]
    take(spark, marts, rows, str(tmp_path / "s0"))
    rows += [read(15, 3, 2), read(0, 6, 3)]  # a new read, and one whose greatest value replaces the old one
    take(spark, marts, rows[2:], str(tmp_path / "s1"))
    assert asked == []
    rows.append(read(0, 2, 4))  # the greatest demand of the hour, day, month and period is gone
    take(spark, marts, rows[4:], str(tmp_path / "s2"))
    assert asked[0] == ("hourly", [T0.date()]) and [a for a, _ in asked] == ["hourly", "daily", "monthly", "billing"]
    same(marts, full(spark, rows, dims))


@pytest.mark.parametrize("at", ["daily"])
def test_a_refresh_that_died_is_repeated_without_counting_twice(spark, tmp_path, dims, monkeypatch, at):
    marts = delta.DeltaMarts(spark, str(tmp_path / "marts"), 4, 96, dims, wider=("billing",))
    rng = random.Random(5)
    first, second = made(rng, 40, 0), made(rng, 20, 1_000)
    take(spark, marts, first, str(tmp_path / "s0"))
    real, left = tables._move, [1]

    def die(session, source, target):
        if f"{at}_state" in target and left[0] == 0:
            raise RuntimeError("driver lost")
        left[0] -= f"{at}_state" in target
        real(session, source, target)

    monkeypatch.setattr(tables, "_move", die)
    with pytest.raises(RuntimeError):
        take(spark, marts, second, str(tmp_path / "s1"))
    monkeypatch.setattr(tables, "_move", real)
    take(spark, marts, second, str(tmp_path / "s1"))
    same(marts, full(spark, first + second, dims))


def test_an_emptied_group_and_partition_go(spark, tmp_path, dims):
    """A meter that moves to another territory leaves its old group; a level's last group takes its partition along."""
    level = delta.daily(96)
    hour = lambda territory, kwh: spark.createDataFrame(
        [("M", T0, territory, Decimal(kwh), Decimal(0), Decimal(kwh), Decimal(1), Decimal(230), Decimal(230), Decimal(230), 4, Decimal(100))],
        "meter_id string, rollup_ts timestamp_ntz, utility_territory string, kwh_delivered decimal(24,4), kwh_received decimal(24,4),"
        " kwh_net decimal(25,4), max_demand_kw decimal(10,4), min_voltage decimal(6,2), max_voltage decimal(6,2),"
        " avg_voltage decimal(18,6), source_interval_count bigint, vee_pass_pct decimal(12,2)",
    )
    path = str(tmp_path / "daily_state")
    steps = [[("NE", 5, 1)], [("NE", 5, -1), ("SE", 6, 1)], [("SE", 6, -1)]]
    seen = []
    for k, rows in enumerate(steps):
        frame = None
        for territory, kwh, sign in rows:
            one = hour(territory, kwh).withColumn("sign", F.lit(sign))
            frame = one if frame is None else frame.unionByName(one)
        delta.apply(spark, level, frame, path, str(tmp_path / f"s{k}"), lambda days: hour("NE", 1).limit(0))
        held = tables.partition_days(spark, path, "part_date")
        seen.append(sorted(r["utility_territory"] for r in spark.read.parquet(path).collect()) if held else held)
    assert seen == [["NE"], ["SE"], []]


def test_a_levels_changes_need_no_join(spark, tmp_path, dims):
    rows = spark.createDataFrame(made(random.Random(3), 30, 0), SCHEMA).withColumn("sign", F.lit(1))
    path = str(tmp_path / "hourly_state")
    found = delta.apply(spark, delta.hourly(4), rows, path, str(tmp_path / "s"), lambda days: rows.limit(0))
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = found.filter("sign = 1").drop("sign")
    want = delta.hourly(4).mart(spark.read.parquet(path)).drop("part_date")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect())) != []


def test_unique_batches_are_not_deduplicated_and_few_days_are_shared_out(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(made(random.Random(4), 30, 0), SCHEMA).dropDuplicates(pipeline.READ_KEYS)
    rows = tables.snapshot(rows, str(tmp_path / "rows"))
    monkeypatch.setattr(tables, "last_write_wins", None)
    path = str(tmp_path / "table")
    tables.upsert(rows, path, str(tmp_path / "s"), pipeline.READ_KEYS, pipeline.NEWEST, "read_date", unique=True, days=4)
    got = spark.read.parquet(path).select(*rows.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, rows.collect()))
    plan = lambda days: tables._laid_out(rows, "read_date", [], days)._jdf.queryExecution().optimizedPlan().toString()
    cores = spark.sparkContext.defaultParallelism
    assert "pmod" in plan(cores - 1) and "pmod" not in plan(cores) and "pmod" not in plan(0)


def test_streams_are_logged_with_their_batches_and_errors(spark, tmp_path):
    log = quality.RunLog(spark, str(tmp_path / "log"), "RAW")
    listener = ProgressLog(log)
    source = tmp_path / "in"
    spark.range(5).write.parquet(str(source))
    spark.streams.addListener(listener)
    try:
        def stream(name, bad):
            rows = spark.readStream.schema("id long").parquet(str(source))
            rows = rows.withColumn("x", F.raise_error(F.lit("no good"))) if bad else rows.groupBy("id").count()
            mode = "append" if bad else "complete"
            query = rows.writeStream.queryName(name).format("memory").outputMode(mode).option(
                "checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
            try:
                query.awaitTermination()
            except Exception:  # the failing stream's error is what the log must tell
                assert bad
            listener.wait(query)

        stream("good", False)
        stream("bad", True)
    finally:
        spark.streams.removeListener(listener)
    rows = log.read().collect()
    good = {r.refresh_action: r for r in rows if r.pipeline_name == "good"}
    assert (good["BATCH"].rows_processed, good["BATCH"].batch_id, good["BATCH"].state_rows, good["BATCH"].schema_name) == (5, 0, 5, "RAW")
    assert good["BATCH"].end_time >= good["BATCH"].start_time and good["STREAM"].status == "SUCCESS"
    (bad,) = [r for r in rows if r.pipeline_name == "bad" and r.refresh_action == "STREAM"]
    assert bad.status == "FAILED" and bad.error_count == 1 and "no good" in bad.message
