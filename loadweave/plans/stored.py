"""The mart graph over stored tables: what the refresh jobs keep, instead of the raw feed.

Every report and the metric model take ``Marts``; this variant answers from ``MartTables``. Facts come from their
partitions, so a report over days reads those days, and nothing is deduplicated or rolled up again. Dimensions are
frames of the caller.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadweave.plans.marts import Marts, ntz
from loadweave.session import tune
from loadweave.sources import tables
from loadweave.streaming.refresh import MartTables


class StoredMarts(Marts):
    """Marts over stored tables. ``dims`` has the dimension frames by name (placed, transformers, feeders, meters,
    meter_events, ...), as ``MeterFeed`` does; ``dims.lookup`` those that facts look up."""

    def __init__(self, spark: SparkSession, stored: MartTables, dims):
        self.spark = tune(spark)
        self.stored, self.feed = stored, dims
        self.per_hour, self.per_day = stored.expected_per_hour, stored.expected_per_day

    @property
    def now(self) -> Column:
        return F.localtimestamp()

    @property
    def runs(self) -> DataFrame:
        if self.stored.log is None:
            raise LookupError("these tables keep no run log")
        return self.stored.log.read()

    def _mart(self, name: str) -> DataFrame:
        return self.stored.read(name).drop("part_date")

    def _part(self, name: str, first: dt.date, last: dt.date) -> DataFrame:
        days = F.col("part_date").between(F.lit(_day(first)), F.lit(_day(last)))
        return self.stored.read(name).filter(days).drop("part_date")

    @cached_property
    def span(self) -> tuple[dt.datetime, dt.datetime]:
        """First and last read: the days from the list of partitions, the times from those two days."""
        days = self.stored.days("canonical")
        edge = self.stored.read("canonical").filter(F.col("read_date").isin(days[0], days[-1]))
        row = edge.agg(F.min("read_ts").alias("first"), F.max("read_ts").alias("last")).first()
        return row["first"], row["last"]

    @cached_property
    def reads(self) -> DataFrame:
        return self.stored.read("canonical").drop("read_date")

    def reads_between(self, first, last) -> DataFrame:
        whole = lambda t: t if isinstance(t, dt.datetime) else dt.datetime.combine(t, dt.time())
        low, high = whole(first), whole(last)
        return self.stored.read("canonical").filter(
            F.col("read_date").between(F.lit(low.date()), F.lit(high.date())) & F.col("read_ts").between(ntz(low), ntz(high))
        ).drop("read_date")

    hourly = cached_property(lambda self: self._mart("hourly"))
    daily = cached_property(lambda self: self._mart("daily"))
    monthly = cached_property(lambda self: self._mart("monthly"))
    channel_hourly = cached_property(lambda self: self._mart("channel_hourly"))
    channel_daily = cached_property(lambda self: self._mart("channel_daily"))
    charges = cached_property(lambda self: self._mart("charges"))
    sla = cached_property(lambda self: self._mart("sla"))
    dq = cached_property(lambda self: self._mart("dq"))
    consumption = cached_property(lambda self: self._mart("billing"))

    def _stored_scores(self, name: str) -> DataFrame | None:
        """What the scoring passes stored, if there were any."""
        if not tables.exists(self.spark, self.stored.path(name)):
            return None
        return self.stored.read(name).drop("detected_at", "event_date")

    @cached_property
    def feeder_events(self) -> DataFrame:
        stored = self._stored_scores("feeder_scores")
        return super().feeder_events if stored is None else stored

    @cached_property
    def meter_events(self) -> DataFrame:
        stored = self._stored_scores("meter_scores")
        return super().meter_events if stored is None else stored

    def daily_between(self, first, last) -> DataFrame:
        return self._part("daily", first, last)

    def sla_between(self, first, last) -> DataFrame:
        return self._part("sla", first, last)

    def dq_between(self, first, last) -> DataFrame:
        return self._part("dq", first, last)

    def charges_between(self, first, last) -> DataFrame:
        low, high = (ntz(t) for t in (first, last))
        return self._part("charges", first, last).filter(F.col("read_ts").between(low, high))


def _day(value: dt.date | dt.datetime) -> dt.date:
    return value.date() if isinstance(value, dt.datetime) else value
