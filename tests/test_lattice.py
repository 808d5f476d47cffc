"""Metrics from stored summaries: equal on every path, and from the coarsest table that can answer."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadweave.operators import distinct
from loadweave.plans import catalog
from loadweave.plans.lattice import standard_lattice
from loadweave.plans.marts import Marts
from loadweave.plans.metrics import standard_model
from loadweave.plans.stored import StoredMarts


@pytest.fixture(scope="module")
def kept(spark, root, tmp_path_factory):
    fed = Marts(spark, root)
    marts = catalog._tables(fed, str(tmp_path_factory.mktemp("lattice")), "charges", "billing", "sla")
    marts.build(fed.reads)
    return StoredMarts(spark, marts, fed.feed)


@pytest.fixture(scope="module")
def lattice(spark, kept):
    numbers = kept.feed.accounts.select("meter_id", "meter_no")
    return standard_lattice(spark, standard_model(kept), f"{kept.stored.root}/summaries", numbers, lambda: kept.monthly)


def rows(frame):
    return sorted(map(repr, (tuple(float(v) if hasattr(v, "as_tuple") else v for v in r) for r in frame.collect())))


CASES = [
    (["total_kwh", "meter_count", "total_energy_charge"], ["meter.territory"], None, "daily_by_territory", "daily"),
    (["total_kwh_net", "avg_completeness"], ["daily_rollup.rollup_date", "meter.territory"], None, "daily_by_territory", "daily"),
    (["total_kwh", "meter_count"], [], None, "daily_by_territory", "daily"),
    (["total_kwh", "meter_count"], ["meter.has_der", "service_point.premise"], None, "daily_by_premise", "daily"),
    (["total_kwh", "meter_count"], ["meter.territory"], "meter_territory = 'NE'", "daily_by_territory", "daily"),
    (["billing_ready_pct", "total_billed_kwh"], ["service_point.premise"], None, "billing_by_start", "billing"),
    (["avg_energy_rate", "total_demand_charge"], ["charge_line.tou_bucket"], None, "charges_by_bucket", "charges"),
    (["avg_pct_on_time"], ["sla.territory"], None, "sla_by_territory", "sla"),
    (["total_kwh", "meter_count"], ["meter.meter_type"], None, "monthly", "daily"),
    (["avg_completeness"], ["meter.meter_type"], None, "daily", None),  # an average of averages is not that of the days
    (["total_kwh"], [], "kwh_delivered > 1", "daily", None),  # a filter on the rows themselves
    (["avg_energy_rate"], ["charge_line.rate_plan"], None, "charges", None),
]


@pytest.mark.parametrize("metrics,dimensions,where,scanned,spared", CASES)
def test_the_coarsest_table_answers(kept, lattice, metrics, dimensions, where, scanned, spared):
    routed = lattice.query(metrics, dimensions, where)
    assert rows(routed) == rows(standard_model(kept).query(metrics, dimensions, where))
    text = routed._jdf.queryExecution().optimizedPlan().toString() + "".join(routed.inputFiles())
    assert f"/{scanned}/part" in text.replace(f"/{scanned}_meters/", "/")
    if spared:
        assert f"{kept.stored.root}/{spared}/".replace("//", "/") not in text.replace("file://", "")


def test_a_summary_is_refreshed_by_days(spark, kept, lattice):
    day = dt.datetime.combine(kept.anchor, dt.time())
    model = standard_model(kept)
    real = model.tables["daily_rollup"]
    lattice.model.tables["daily_rollup"] = lambda: real().withColumn("kwh_delivered", F.when(F.col("rollup_ts") < day, F.col("kwh_delivered")).otherwise(F.lit(0).cast("decimal(24,4)")))
    dims = ["daily_rollup.rollup_date", "daily_rollup.territory", "meter.territory"]
    lattice.summarise("daily_by_territory", "daily_rollup", dims, "daily_rollup.rollup_date", [kept.anchor])
    found = {r[0]: r[1] for r in lattice.query(["total_kwh"], ["daily_rollup.rollup_date"]).collect()}
    want = {r[0]: r[1] for r in lattice.model.query(["total_kwh"], ["daily_rollup.rollup_date"]).collect()}
    assert found == want and found[day] == 0 and len(found) > 5


def test_bitmaps_count_what_is_distinct(spark):
    rows_ = spark.range(2_000).selectExpr("id % 700 * 97 + 1 AS n", "id % 3 AS g", "cast(id % 5 as int) AS d").withColumn(
        "day", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("d")))
    maps = distinct.bitmaps(rows_, ["day", "g"], "n")
    assert maps.select("bucket").distinct().count() == 3
    for keys in ([], ["g"], ["day"], ["day", "g"]):
        want = rows_.groupBy(*keys).agg(F.countDistinct("n").alias("members"))
        assert rows(distinct.counted(maps, keys).select(*keys, "members")) == rows(want)
    rolled = {(r.day.day, r.g): r.members for r in distinct.rolling(maps, "day", ["g"], 2).collect()}
    held = {}
    for r in rows_.collect():
        for ahead in (0, 1):
            held.setdefault((r.day.day + ahead, r.g), set()).add(r.n)
    assert rolled == {k: len(v) for k, v in held.items() if k[0] <= 5}
    assert distinct.counted(distinct.bitmaps(rows_.limit(0), ["g"], "n"), ["g"]).count() == 0
