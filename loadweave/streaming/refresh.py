"""Keeping marts current: after a merge, only what its days touch is computed again."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from loadweave.operators import billing, channels, quality, rollups, tou
from loadweave.sources import tables

# How long each mart may lag behind its source, in minutes; callers schedule by it.
TARGET_LAG_MIN = {
    "normalised": 1, "hourly": 5, "daily": 10, "monthly": 60, "channel_hourly": 15, "channel_daily": 30,
    "tou": 15, "charges": 15, "billing": 30, "sla": 15, "dq": 30,
}


@dataclass
class Dimensions:
    """What the marts beyond the rollups look up."""

    meters: DataFrame
    meter_channels: DataFrame
    links: DataFrame
    customers: DataFrame
    windows: DataFrame
    periods: DataFrame


WIDER = ("channels", "charges", "sla", "dq", "billing")


def at_once(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Run refreshes that do not need each other side by side, so that one fills the cores another's last tasks leave idle.

    All are waited for; the first error, if any, is raised then.
    """
    if len(jobs) == 1:
        return jobs[0]()
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()


@dataclass
class MartTables:
    """Materialised canonical reads and marts below one folder.

    With ``log``, every refresh of a mart is a run in that log. With ``dims``, channel rollups, charges, arrival and quality metrics and billing are kept as well,
    or those of them that ``wider`` names.
    Every mart is partitioned by the day, month or period start its rows belong to, and a refresh
    replaces whole partitions, so repeating one changes nothing.
    """

    spark: SparkSession
    root: str
    expected_per_hour: int = 4
    expected_per_day: int = 96
    dims: Dimensions | None = None
    wider: tuple[str, ...] = WIDER
    log: quality.RunLog | None = None

    @property
    def canonical(self) -> str:
        return f"{self.root}/canonical"

    def path(self, mart: str) -> str:
        return f"{self.root}/{mart}"

    def read(self, mart: str) -> DataFrame:
        return self.spark.read.parquet(self.path(mart))

    def days(self, mart: str, part: str = "read_date") -> list[dt.date]:
        """The days a table has, from its list of partitions."""
        return tables.partition_days(self.spark, self.path(mart), part)

    def build(self, reads: DataFrame) -> None:
        """Everything from canonical reads, at once."""
        dated = reads.withColumn("read_date", F.to_date("read_ts"))
        tables.write_partitioned(dated, self.canonical, "read_date", mode="overwrite", cluster=["meter_id", "read_ts"])
        self.refresh(self.days("canonical"))

    def _store(self, mart: str, df: DataFrame, day: str, days: list[dt.date]) -> None:
        """Replace the partitions ``days`` of a mart, also those that are empty now."""

        dealt = tables.SHARE in df.columns
        dated = df.drop(tables.SHARE) if dealt else df.withColumn("part_date", F.to_date(day))
        if not self.log:
            return tables.replace_partitions(dated, self.path(mart), "part_date", expected=days, dealt=dealt)

        def job() -> int:
            # Counted while it is written, not read back.
            seen = Observation()
            counted = dated.observe(seen, F.count(F.lit(1)).alias("rows"))
            tables.replace_partitions(counted, self.path(mart), "part_date", expected=days, dealt=dealt)
            return seen.get["rows"]

        action = "INCREMENTAL" if tables.exists(self.spark, self.path(mart)) else "FULL"
        self.log.run(f"REFRESH_{mart.upper()}", job, action)

    def score(self, mart: str, events: DataFrame, series: str, pass_id: str | None = None) -> None:
        """Keep the scores of a pass (``feeder_scores`` or ``meter_scores``), from which reports answer."""
        score_pass(events, self.path(mart), f"{self.root}/scoring/{mart}", series, pass_id)

    def _days(self, mart: str, days: list[dt.date]) -> DataFrame:
        """A stored mart's partitions of the touched days."""
        return self.read(mart).filter(F.col("part_date").isin(days)).drop("part_date")

    def refresh(self, days: list[dt.date]) -> None:
        """Recompute what the touched days reach: days, then their months and billing periods.

        Each level reads the one below from its table, so its rounding is the stored one, and each
        scan is limited to the partitions concerned.
        """
        reads = self.read("canonical").filter(F.col("read_date").isin(days))

        def rolled() -> None:
            self._store("hourly", rollups.hourly(reads, self.expected_per_hour), "rollup_ts", days)
            self._store("daily", rollups.daily(self._days("hourly", days), self.expected_per_day), "rollup_ts", days)
            firsts = sorted({d.replace(day=1) for d in days})
            months = self.read("daily").filter(F.trunc("part_date", "month").isin(firsts))
            self._store("monthly", rollups.monthly(months.drop("part_date")), "rollup_ts", firsts)
            if self.dims is not None and "billing" in self.wider:
                self._refresh_billing(days, self.dims)

        at_once(self.spark, rolled, *self._wider_jobs(reads, days))

    def _wider_jobs(self, reads: DataFrame, days: list[dt.date]) -> list[Callable[[], None]]:
        """Refreshes of marts that are computed from reads alone, none of which needs another."""
        if self.dims is None:
            return []
        d = self.dims

        def channel_marts() -> None:
            # An hour's reads are fewer and narrower than the channel rows it makes, so they are dealt, and the rows stay.
            ruled = channels.with_rules(reads, d.meters, d.meter_channels).withColumn("part_date", F.to_date("read_ts"))
            dealt = tables.deal(ruled, "part_date", ["meter_id"], tables.shares_of(self.spark, self.canonical, "read_date", days))
            hours = channels.channel_hours(dealt, self.expected_per_hour, ("part_date", tables.SHARE))
            self._store("channel_hourly", hours, "rollup_ts", days)
            per_day = channels.channel_daily(self._days("channel_hourly", days), self.expected_per_day)
            self._store("channel_daily", per_day, "rollup_date", days)

        def charges() -> None:
            lines = tou.charge(tou.tag(reads, tou.current_plans(d.links, d.customers), d.windows))
            self._store("charges", lines, "read_ts", days)

        jobs = {
            "channels": channel_marts, "charges": charges,
            "sla": lambda: self._store("sla", quality.sla(reads), "date_key", days),
            "dq": lambda: self._store("dq", quality.data_quality(reads, self.expected_per_day), "date_key", days),
        }
        return [jobs[w] for w in jobs if w in self.wider]

    def _refresh_billing(self, days: list[dt.date], d: Dimensions) -> None:
        """Every period that shares its start with one the touched days reach."""
        touched = F.array(*map(F.lit, days))
        reached = F.exists(touched, lambda day: day.between(F.col("start_date"), F.col("end_date")))
        starts = tables.touched(d.periods.filter(reached), "start_date")
        if not starts:
            return
        periods = d.periods.filter(F.col("start_date").isin(starts))
        # The ranges that these periods span: one for each distinct start and end, never rows of meters.
        spans = [tuple(r) for r in periods.select("start_date", "end_date").distinct().collect()]
        part = F.col("part_date")
        inside = reduce(or_, [part.between(F.lit(first), F.lit(last)) for first, last in spans])
        daily = self.read("daily").filter(inside).drop("part_date")
        self._store("billing", billing.consumption(periods, d.meters, daily), "start_date", starts)


def backfill_channels(
    reads: DataFrame, meters: DataFrame, path: str, first: dt.date, last: dt.date
) -> None:
    """Channel rows of a range of days as one job; a second run replaces the first one's partitions."""
    day = F.to_date("read_ts")
    inside = reads.filter(day.between(F.lit(first), F.lit(last)))
    tables.replace_partitions(
        channels.unpivot(inside, meters).withColumn("read_date", F.to_date("read_ts")), path, "read_date",
        cluster=["meter_id", "channel_code"],
    )


def score_pass(events: DataFrame, path: str, staging: str, series: str, pass_id: str | None = None) -> None:
    """One scoring pass: upsert scores by series and hour, stamped with the time of the pass.

    The scored window overlaps the last pass's; a plain append would store its hours again and again. Each pass stages
    below ``staging`` in a folder of its own, which is deleted when the pass is done. A scheduler that repeats a pass
    that died gives its ``pass_id`` again.
    """
    folder = f"{staging}/{pass_id or uuid.uuid4().hex}"
    stamped = events.withColumn("detected_at", F.localtimestamp()).withColumn("event_date", F.to_date("ts"))
    tables.upsert(stamped, path, folder, [series, "ts"], ["detected_at"], by="event_date")
    tables.drop(events.sparkSession, folder)
