"""Merges and refreshes: lateness, replays, crashes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadweave.operators import ingest
from loadweave.plans import catalog, reports
from loadweave.plans.marts import Marts
from loadweave.sources import tables
from loadweave.streaming import hot, pipeline
from loadweave.streaming.refresh import Dimensions, MartTables, at_once, score_pass

SCHEMA = "meter_id string, read_ts timestamp_ntz, value int, ingested_at timestamp_ntz, event_id bigint, read_date date"
T0 = dt.datetime(2024, 1, 3)


def batch(spark, *rows):
    out = []
    for meter, day, value, arrived in rows:
        ts = T0 + dt.timedelta(days=day)
        out.append((meter, ts, value, T0 + dt.timedelta(hours=arrived), arrived, ts.date()))
    return spark.createDataFrame(out, SCHEMA)


def merge(frame, path, staging):
    return tables.upsert(frame, path, staging, pipeline.READ_KEYS, pipeline.NEWEST, "read_date")


def values(spark, path):
    return {(r.meter_id, r.read_date.day): r.value for r in spark.read.parquet(path).collect()}


def test_late_rows_win_and_stale_replays_do_not(spark, tmp_path):
    path, work = str(tmp_path / "t"), str(tmp_path / "s")
    merge(batch(spark, ("A", 0, 1, 1), ("B", 0, 2, 1), ("A", 1, 3, 1)), path, f"{work}/0")
    days = merge(batch(spark, ("A", 0, 10, 900), ("B", 0, 99, 0)), path, f"{work}/1")
    assert days == [T0.date()]
    assert values(spark, path) == {("A", 3): 10, ("B", 3): 2, ("A", 4): 3}


def test_a_batch_that_died_while_replacing_is_repeated_from_staging(spark, tmp_path, monkeypatch):
    path, work = str(tmp_path / "t"), str(tmp_path / "s")
    merge(batch(spark, ("A", 0, 1, 1), ("B", 0, 2, 1)), path, f"{work}/0")
    second = batch(spark, ("A", 0, 10, 5))
    real = tables._move

    def die(session, source, target):
        # The worst moment: the live partition is gone, its replacement has not arrived.
        fs, live = tables._fs(session, target)
        fs.delete(live, True)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "_move", die)
    with pytest.raises(RuntimeError):
        merge(second, path, f"{work}/1")
    monkeypatch.setattr(tables, "_move", real)
    merge(second, path, f"{work}/1")
    assert values(spark, path) == {("A", 3): 10, ("B", 3): 2}


def test_a_merge_tells_what_it_changed(spark, tmp_path):
    path, work = str(tmp_path / "t"), str(tmp_path / "s")
    merge(batch(spark, ("A", 0, 1, 1), ("B", 0, 2, 1), ("C", 2, 7, 1)), path, f"{work}/0")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    days = merge(batch(spark, ("A", 0, 10, 5), ("A", 0, 9, 4), ("B", 0, 99, 0), ("C", 2, 7, 1), ("D", 3, 4, 2)), path, f"{work}/1")
    assert [d.day for d in days] == [3, 5, 6]
    rows = {r.meter_id: (r.before and r.before.value, r.after.value) for r in tables.changes_of(spark, f"{work}/1", "read_date").collect()}
    assert rows == {"A": (1, 10), "D": (None, 4)}  # stale and repeated rows change nothing
    kept = [p for p in (tmp_path / "t").rglob("*.parquet") if p in before]
    assert all("read_date=2024-01-05" in str(p) for p in kept) and kept  # the day without a change was not written
    assert values(spark, path) == {("A", 3): 10, ("B", 3): 2, ("C", 5): 7, ("D", 6): 4}


def test_an_actual_outranks_an_estimate_whenever_it_arrived(spark, tmp_path):
    schema = "meter_id string, read_ts timestamp_ntz, vee_status string, ingested_at timestamp_ntz, event_id bigint, read_date date"

    def rows(*given):
        made = [(m, T0, status, T0 + dt.timedelta(hours=h), h, T0.date()) for m, status, h in given]
        return spark.createDataFrame(made, schema)

    path = str(tmp_path / "t")
    for k, given in enumerate((
        [("A", "ESTIMATED", 50), ("B", "VALID", 1), ("C", "ESTIMATED", 5)], [("A", "VALID", 2), ("B", "ESTIMATED", 60)],
        [("A", "ESTIMATED", 70), ("C", "ESTIMATED", 6)], [("B", "FAILED", 3)],
    )):
        tables.upsert(rows(*given), path, str(tmp_path / f"s{k}"), pipeline.READ_KEYS, [ingest.precedence(), *pipeline.NEWEST], "read_date")
    got = {r.meter_id: (r.vee_status, r.event_id) for r in spark.read.parquet(path).collect()}
    assert got == {"A": ("VALID", 2), "B": ("FAILED", 3), "C": ("ESTIMATED", 6)}


def test_incremental_refresh_equals_full_recompute(spark, root, tmp_path):
    m = Marts(spark, root)
    f = m.feed
    dims = Dimensions(f.meters, m.meter_channels, f.links, f.customers, m.windows,
                      m.cycles.drop("meter_no", "meter_id"))
    marts = MartTables(spark, str(tmp_path), 1, 2, dims)
    rows = m.reads.selectExpr("*", "to_date(read_ts) as read_date")
    merge(rows.filter("event_id % 3 <> 0"), marts.canonical, str(tmp_path / "s0"))
    marts.refresh(tables.touched(rows.filter("event_id % 3 <> 0"), "read_date"))
    late = rows.filter("event_id % 3 = 0")
    marts.refresh(merge(late, marts.canonical, str(tmp_path / "s1")))
    for mart, full in (
        ("hourly", m.hourly), ("daily", m.daily), ("monthly", m.monthly), ("channel_hourly", m.channel_hourly),
        ("channel_daily", m.channel_daily), ("charges", m.charges), ("sla", m.sla), ("dq", m.dq),
        ("billing", m.consumption),
    ):
        got = marts.read(mart).select(*full.columns)
        assert got.count() == full.count()
        assert got.exceptAll(full).isEmpty() and full.exceptAll(got).isEmpty()


def test_an_emptied_day_and_scattered_late_days(spark, root, tmp_path):
    """A day whose reads all turn FAILED has no charges left; far days refresh their own months and periods only."""
    m = Marts(spark, root)
    f = m.feed
    dims = Dimensions(f.meters, m.meter_channels, f.links, f.customers, m.windows, m.cycles.drop("meter_no", "meter_id"))
    marts = MartTables(spark, str(tmp_path), 1, 2, dims, wider=("charges", "billing", "sla"))
    rows = m.reads.selectExpr("*", "to_date(read_ts) as read_date")
    merge(rows, marts.canonical, str(tmp_path / "s0"))
    marts.refresh(tables.touched(rows, "read_date"))
    far = [m.first_day, m.anchor]
    before = {r[0] for r in marts.read("charges").select("part_date").distinct().collect()}
    stamps = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "sla").glob("part_date=*")}
    resent = rows.filter(F.col("read_date").isin(far)).withColumn("vee_status", F.lit("FAILED")).withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("interval 400 days"))
    marts.refresh(merge(resent, marts.canonical, str(tmp_path / "s1")))
    after = {r[0] for r in marts.read("charges").select("part_date").distinct().collect()}
    assert before - after == set(far) & before and far[0] in before
    moved = {p.name for p in (tmp_path / "sla").glob("part_date=*") if stamps.get(p.name) != p.stat().st_mtime_ns}
    assert moved == {f"part_date={d}" for d in far}
    known = marts.read("billing").agg(F.count("*"), F.sum("kwh_total")).first()
    assert known[0] == m.consumption.count()


def test_a_second_scoring_pass_with_new_scores(spark, tmp_path):
    def scores(value, hours):
        rows = [("S", T0 + dt.timedelta(hours=h), value) for h in hours]
        return spark.createDataFrame(rows, "series string, ts timestamp_ntz, distance double")

    path, staging = str(tmp_path / "events"), str(tmp_path / "staging")
    score_pass(scores(1.0, range(0, 6)), path, staging, "series")
    score_pass(scores(2.0, range(3, 9)), path, staging, "series")
    got = {r.ts.hour: r.distance for r in spark.read.parquet(path).collect()}
    assert got == {**dict.fromkeys(range(0, 3), 1.0), **dict.fromkeys(range(3, 9), 2.0)}
    assert not list((tmp_path / "staging").iterdir())


def test_a_stream_with_a_trigger_keeps_running(spark, root, tmp_path):
    feed = Marts(spark, root).feed
    pipeline.land_bronze(feed.payloads, str(tmp_path / "bronze"))
    query = pipeline.append_stream(
        pipeline.normalised_stream(pipeline.bronze_stream(spark, str(tmp_path / "bronze")), feed.lookup.meters),
        str(tmp_path / "typed"), str(tmp_path / "checkpoint"), {"processingTime": "1 second"},
    )
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(str(tmp_path / "typed")).count() == feed.events.count()
    finally:
        query.stop()


def test_a_restarted_stream_does_not_repeat_work(spark, root, tmp_path):
    work = str(tmp_path)
    feed = Marts(spark, root).feed
    pipeline.land_bronze(feed.payloads, f"{work}/bronze")
    meters = feed.lookup.meters

    def go():
        stream = pipeline.normalised_stream(pipeline.bronze_stream(spark, f"{work}/bronze"), meters)
        pipeline.append_stream(stream, f"{work}/typed", f"{work}/checkpoint")
        return spark.read.parquet(f"{work}/typed").count()

    assert go() == go() == feed.events.count()


@pytest.mark.parametrize("hold_ms,left", [(0, 0), (10**9, 15)])
def test_hot_state_is_bounded_and_loses_no_late_read(spark, root, tmp_path, hold_ms, left):
    """With any hold the table is the batch result; without one, state is empty once the stream is drained."""
    work, m = str(tmp_path), Marts(spark, root)
    pipeline.keep_state_on_disk(spark)
    late = m.feed.payloads.filter(F.col("event_id") % 5 == 0).withColumns({
        "event_id": F.col("event_id") + 10_000_000, "ingested_at": F.col("ingested_at") + F.expr("interval 90 days"),
    })
    pipeline.land_bronze(m.feed.payloads.unionByName(m.feed.payloads), f"{work}/bronze")  # every read twice
    meters = m.feed.lookup.meters

    def go():
        stream = pipeline.normalised_stream(pipeline.bronze_stream(spark, f"{work}/bronze", None), meters)
        return pipeline.merge_stream(hot.newest_only(stream, hold_ms), f"{work}/canonical", f"{work}/merge")

    go()
    pipeline.land_bronze(late, f"{work}/bronze")
    query = go()
    newest = ["ingested_at", "event_id"]
    want = ingest.latest_reads(ingest.land(m.feed.payloads.unionByName(late)), meters, newest, ["event_id"])
    got = spark.read.parquet(f"{work}/canonical").select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    state = [p.stateOperators[0].numRowsTotal for p in query.recentProgress][-1]
    assert state == (m.reads.select("meter_id").distinct().count() if left else 0)


def test_stored_scores_answer_reports(spark, root, tmp_path):
    fed = Marts(spark, root)
    kept = catalog._scored(fed)
    assert sorted(map(repr, reports.anomaly_board(kept).collect())) == sorted(map(repr, reports.anomaly_board(fed).collect()))
    for report in (reports.anomaly_kpi, reports.top_meter_anomalies, reports.anomalies_per_day, reports.forecast_band):
        files = "".join(report(kept).inputFiles())
        assert "_scores/" in files and "/canonical/" not in files and "events.parquet" not in files


def test_a_batch_of_new_days_is_compared_with_nothing(spark, tmp_path, monkeypatch):
    path, work = str(tmp_path / "t"), str(tmp_path / "s")
    frame = batch(spark, ("A", 0, 1, 1), ("A", 0, 2, 2), ("B", 1, 3, 1))
    joined = []
    real = type(frame).join
    monkeypatch.setattr(type(frame), "join", lambda self, *a, **k: joined.append(1) or real(self, *a, **k))
    merge(frame, path, f"{work}/0")
    merge(batch(spark, ("A", 2, 5, 1)), path, f"{work}/1")
    assert not joined and values(spark, path) == {("A", 3): 2, ("B", 4): 3, ("A", 5): 5}
    found = tables.changes_of(spark, f"{work}/0", "read_date").collect()
    assert sorted(r.after.value for r in found) == [2, 3] and all(r.before is None for r in found)
    merge(batch(spark, ("A", 2, 6, 2), ("C", 3, 7, 1)), path, f"{work}/2")
    assert joined and values(spark, path) == {("A", 3): 2, ("B", 4): 3, ("A", 5): 6, ("C", 6): 7}


def test_dealt_rows_lie_by_day_and_share(spark):
    days = [T0.date() + dt.timedelta(days=d) for d in range(3)]
    frame = spark.range(3000).selectExpr("cast(id as string) meter_id", f"date_add(date'{days[0]}', cast(id % 3 as int)) as day")
    shares = {days[0]: 1, days[1]: 4, days[2]: 1}
    dealt = tables.deal(frame, "day", ["meter_id"], shares)
    placed = dealt.withColumn("part", F.spark_partition_id())
    lie = placed.groupBy("day", tables.SHARE).agg(F.count_distinct("part").alias("parts"), F.count("*").alias("n")).collect()
    assert all(r.parts == 1 for r in lie) and sum(r.n for r in lie) == 3000
    assert {d: sum(r.day == d for r in lie) for d in days} == shares
    grouped = dealt.groupBy("meter_id", "day", tables.SHARE).count()
    assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_refreshes_side_by_side_are_all_done_before_an_error_is_raised(spark):
    done = []

    def fails():
        raise ValueError("one mart")

    with pytest.raises(ValueError):
        at_once(spark, fails, lambda: done.append(spark.range(3).count()), lambda: done.append(2))
    assert sorted(done) == [2, 3]
