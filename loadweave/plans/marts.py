"""The mart graph: canonical reads and everything derived from them, as lazy frames.

Nothing is computed until a caller acts on a frame, and a frame that is not asked for is never
planned. The only values brought to the driver are the first and last read time (one row), which
become literals so that every date range below is pushed into the scans.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadweave.functions import hour_floor, mean
from loadweave.operators import (
    anomaly, billing, calendar, channels, edge, priority, quality, rollups, tariff, topology, tou,
)
from loadweave.operators.ranking import global_rank
from loadweave.session import fresh_folder, tune
from loadweave.sources import reference
from loadweave.sources.feed import MeterFeed

DETECT_DAYS = 6
#: Days before the anchor from which baselines are trained.
TRAIN_DAYS = 180
CYCLE = "10 days"
CYCLE_DAYS = 10


def ntz(value: str | dt.datetime | dt.date) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


class Marts:
    """Marts over one feed. The sample feed transmits about two reads per meter and day, hence the
    defaults for expected counts; dense 15-minute data uses 4 and 96."""

    def __init__(
        self, spark: SparkSession, root: str, expected_per_hour: int = 1, expected_per_day: int = 2
    ):
        self.spark = tune(spark)
        self.feed = MeterFeed(spark, root)
        self.per_hour, self.per_day = expected_per_hour, expected_per_day

    # -- time frame ---------------------------------------------------------------------------

    @cached_property
    def span(self) -> tuple[dt.datetime, dt.datetime]:
        """First and last transmission time: one row, from one column of the fact."""
        row = self.feed.events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
        return row["first"], row["last"]

    @property
    def anchor(self) -> dt.date:
        return self.span[1].date()

    @property
    def first_day(self) -> dt.date:
        return self.span[0].date()

    @property
    def month_start(self) -> dt.date:
        return self.first_day.replace(day=1)

    @property
    def month_end(self) -> dt.date:
        nxt = (self.anchor.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return nxt - dt.timedelta(days=1)

    @property
    def months(self) -> list[int]:
        """Numbers (1 to 12) of the months that have a day of the span."""
        first, last = (d.year * 12 + d.month - 1 for d in (self.first_day, self.anchor))
        return sorted({m % 12 + 1 for m in range(first, last + 1)})

    @property
    def last_slot(self) -> dt.datetime:
        t = self.span[1]
        return t.replace(minute=t.minute // 15 * 15, second=0, microsecond=0)

    def day(self, back: int = 0) -> dt.date:
        return self.anchor - dt.timedelta(days=back)

    def end_of_anchor(self, back: int = 0) -> dt.datetime:
        return dt.datetime.combine(self.day(back), dt.time(23, 59, 59))

    # -- facts --------------------------------------------------------------------------------

    @cached_property
    def reads(self) -> DataFrame:
        return self.feed.reads

    def reads_between(self, first: dt.date | dt.datetime, last: dt.date | dt.datetime) -> DataFrame:
        """Canonical reads of a closed range; a plain date means its midnight."""

        def moment(value: dt.date | dt.datetime) -> dt.datetime:
            return value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())

        return self.feed.reads_between(moment(first), moment(last))

    def reads_of_days(self, first: dt.date, last: dt.date) -> DataFrame:
        return self.reads_between(first, dt.datetime.combine(last, dt.time(23, 59, 59)))

    # -- dimensions ---------------------------------------------------------------------------

    @cached_property
    def placed(self) -> DataFrame:
        return self.feed.lookup.placed

    @cached_property
    def topology(self) -> DataFrame:
        f = self.feed
        return topology.meter_topology(f.meters, f.service_points, f.transformers, f.feeders, f.substations)

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar.slot_calendar(self.spark, self.month_start, self.month_end)

    @cached_property
    def windows(self) -> DataFrame:
        return reference.rate_windows(self.spark)

    @cached_property
    def catalog(self) -> DataFrame:
        return reference.channel_catalog(self.spark)

    @cached_property
    def meter_channels(self) -> DataFrame:
        return channels.instantiate_channels(self.feed.meters, self.catalog)

    @cached_property
    def roles(self) -> DataFrame:
        return reference.role_territories(self.spark)

    # -- channel and rollup marts -------------------------------------------------------------

    @cached_property
    def channel_reads(self) -> DataFrame:
        return channels.unpivot(self.reads, self.feed.lookup.meters)

    @cached_property
    def counted_channels(self) -> DataFrame:
        """Reads with the number of channel rows each stands for."""
        return channels.channel_rows(self.reads, self.feed.lookup.meters)

    @cached_property
    def channel_hourly(self) -> DataFrame:
        rules = channels.instantiate_channels(self.feed.lookup.meters, self.catalog)
        return channels.channel_hourly(self.channel_reads, rules, self.per_hour)

    @cached_property
    def channel_daily(self) -> DataFrame:
        return channels.channel_daily(self.channel_hourly, self.per_day)

    @cached_property
    def hourly(self) -> DataFrame:
        # Dealt by meter once: hours, days, months and billing periods are groups within a meter, and a meter has at
        # most 96 canonical reads a day.
        return rollups.hourly(self.reads.repartition("meter_id"), self.per_hour)

    @cached_property
    def daily(self) -> DataFrame:
        return rollups.daily(self.hourly, self.per_day)

    @cached_property
    def monthly(self) -> DataFrame:
        return rollups.monthly(self.daily)

    def daily_between(self, first, last) -> DataFrame:
        """Daily rollups of whole days, from the reads of those days only."""
        reads = self.reads_of_days(first, last)
        return rollups.daily(rollups.hourly(reads, self.per_hour), self.per_day)

    # -- charges and billing ------------------------------------------------------------------

    @cached_property
    def tagged(self) -> DataFrame:
        return tou.tag(self.reads, self.meter_plans, self.windows)

    @cached_property
    def tagged_local(self) -> DataFrame:
        return tou.tag(self.reads, self.meter_plans, self.windows, tz_mode="meter")

    @cached_property
    def charges(self) -> DataFrame:
        return tou.charge(self.tagged)

    def charges_between(self, first, last) -> DataFrame:
        return tou.charge(
            tou.tag(self.reads_between(first, last), self.meter_plans, self.windows)
        )

    @cached_property
    def billed(self) -> DataFrame:
        """What the billing system charged: kWh as transmitted, per meter and cycle."""
        e = self.feed.events
        cycle = F.floor(F.datediff(F.to_date("ts"), F.lit(str(self.month_start)).cast("date")) / CYCLE_DAYS)
        return e.groupBy(F.col("user_id").alias("meter_no"), cycle.cast("int").alias("cycle")).agg(
            F.sum(F.col("value").cast("decimal(14,4)")).cast("decimal(14,4)").alias("sent_kwh")
        )

    def _cycles(self, feed: MeterFeed) -> DataFrame:
        accounts = feed.metered_accounts.select("cis_account_id", "service_point_id", "meter_no", "meter_id")
        return calendar.billing_cycles(accounts, self.month_start, self.anchor, CYCLE)

    @cached_property
    def cycles(self) -> DataFrame:
        """Cycles of every meter."""
        return self._cycles(self.feed)

    @cached_property
    def known_cycles(self) -> DataFrame:
        """The same, to be looked up from facts."""
        return self._cycles(self.feed.lookup)

    def _with_billed(self, cycles: DataFrame) -> DataFrame:
        number = F.col("meter_no")
        cycle = (F.regexp_extract("bill_cycle", r"(\d+)$", 1).cast("int") - 1).alias("cycle")
        joined = cycles.select("*", cycle).join(self.billed, ["meter_no", "cycle"], "left")
        billed = (
            F.when(number % 20 == 0, F.lit(None).cast("decimal(14,4)"))
            .when(number % 20 == 1, F.lit(0).cast("decimal(14,4)"))
            .otherwise(F.col("sent_kwh"))
        )
        return joined.select(
            "billing_period_id", "cis_account_id", "service_point_id", "bill_cycle", "start_date", "end_date",
            billed.alias("cis_billed_kwh"),
        )

    @cached_property
    def periods(self) -> DataFrame:
        return self._with_billed(self.cycles)

    @cached_property
    def consumption(self) -> DataFrame:
        # The billed quantity plays no part here, so the plain cycles do.
        return billing.consumption(
            self.known_cycles.drop("meter_no", "meter_id"), self.feed.lookup.meters, self.daily
        )

    @cached_property
    def reconciliation(self) -> DataFrame:
        return billing.reconcile(self.consumption, self._with_billed(self.known_cycles))

    # -- quality ------------------------------------------------------------------------------

    @cached_property
    def sla(self) -> DataFrame:
        return quality.sla(self.reads)

    def sla_between(self, first, last) -> DataFrame:
        return quality.sla(self.reads_of_days(first, last))

    @cached_property
    def dq(self) -> DataFrame:
        return quality.data_quality(self.reads, self.per_day)

    def dq_between(self, first, last) -> DataFrame:
        return quality.data_quality(self.reads_of_days(first, last), self.per_day)

    @cached_property
    def observability(self) -> DataFrame:
        return quality.observability(self.reads, self.per_day)

    @property
    def now(self) -> Column:
        """The moment reports look back from."""
        return ntz(self.end_of_anchor())

    @property
    def runs(self) -> DataFrame:
        """Runs of the refresh jobs and streams."""
        raise LookupError("a feed has no runs; StoredMarts reads the log of its tables")

    @cached_property
    def duplicates(self) -> DataFrame:
        return edge.duplicate_audit(self.feed.repeated)

    @cached_property
    def week_shape(self) -> DataFrame:
        since = self.last_slot - dt.timedelta(days=7)
        recent = self.reads_between(since, self.span[1])
        return edge.load_shape(recent, self.feed.lookup.meters, ntz(since))

    @cached_property
    def mismatches(self) -> DataFrame:
        return edge.premise_mismatch(self.week_shape)

    @property
    def ranked_mismatches(self) -> DataFrame:
        order = [F.desc("separation"), F.col("meter_id")]
        return global_rank(self.mismatches, order, fresh_folder(self.spark, "mismatches")).drop("separation")

    # -- anomalies ----------------------------------------------------------------------------

    @property
    def detect_from(self) -> dt.date:
        return self.day(DETECT_DAYS)

    @cached_property
    def training_reads(self) -> DataFrame:
        before = dt.datetime.combine(self.detect_from, dt.time()) - dt.timedelta(minutes=15)
        return self.reads_between(max(self.first_day, self.day(TRAIN_DAYS)), before).filter(F.col("vee_status") == "VALID")

    @cached_property
    def recent_reads(self) -> DataFrame:
        return self.reads_between(self.detect_from, self.span[1])

    @cached_property
    def feeder_training(self) -> DataFrame:
        return topology.feeder_load(self.training_reads, self.placed)

    @cached_property
    def feeder_recent(self) -> DataFrame:
        return topology.feeder_load(self.recent_reads, self.placed)

    @cached_property
    def feeder_baseline(self) -> DataFrame:
        return anomaly.fit_baseline(self.feeder_training, "feeder_id", reference.HOLIDAYS)

    @cached_property
    def feeder_events(self) -> DataFrame:
        return anomaly.detect(self.feeder_recent, self.feeder_baseline, "feeder_id", reference.HOLIDAYS)

    def _meter_load(self, reads: DataFrame) -> DataFrame:
        commercial = self.feed.lookup.meters.filter(F.col("meter_type") == "CNI").select("meter_id")
        return reads.join(commercial, "meter_id", "left_semi").groupBy(
            "meter_id", hour_floor("read_ts").alias("ts")
        ).agg(F.sum("kwh_delivered").cast("decimal(18,4)").alias("kwh"))

    @cached_property
    def meter_training(self) -> DataFrame:
        return self._meter_load(self.training_reads)

    @cached_property
    def meter_events(self) -> DataFrame:
        base = anomaly.fit_baseline(self.meter_training, "meter_id", reference.HOLIDAYS)
        return anomaly.detect(self._meter_load(self.recent_reads), base, "meter_id", reference.HOLIDAYS)

    @cached_property
    def attribution(self) -> DataFrame:
        days = self.daily_between(self.day(30), self.anchor)
        return anomaly.transformer_attribution(self.feeder_events, days, self.placed, self.feed.transformers)

    # -- tariff -------------------------------------------------------------------------------

    @cached_property
    def assignments(self) -> DataFrame:
        """Schedule history per meter: every fifth meter on the tiered schedule moved mid-January."""
        number, plan = F.col("meter_no"), F.col("rate_plan_id")
        moved = (number % 5 == 0) & (plan == "RP-FLAT")
        own = F.when(plan == "RP-FLAT", "S-TIERED").when(plan == "RP-TOU3", "S-TOU").otherwise("S-LARGE")

        def version(schedule: Column, first: str, last: str | None) -> Column:
            end = F.lit(None).cast("timestamp_ntz") if last is None else ntz(last)
            return F.struct(
                schedule.alias("schedule_id"), ntz(first).alias("effective_from"), end.alias("effective_to")
            )

        history = F.when(
            moved,
            F.array(version(own, "2023-01-01", "2024-01-16"), version(F.lit("S-TOU"), "2024-01-16", None)),
        ).otherwise(F.array(version(own, "2023-01-01", None)))
        return self.feed.accounts.filter(~F.col("is_vacant")).select(
            "meter_id", "customer_id", F.explode(history).alias("v")
        ).select("meter_id", "customer_id", "v.*")

    @cached_property
    def rated(self) -> DataFrame:
        return tariff.rated_reads(self.reads, self.assignments, self.known_cycles)

    @cached_property
    def components(self) -> DataFrame:
        return tariff.components(self.spark)

    @cached_property
    def energy_components(self) -> DataFrame:
        return tariff.energy_charges(self.rated, self.components)

    @cached_property
    def demand_components(self) -> DataFrame:
        return tariff.demand_charges(self.rated, self.components)

    @cached_property
    def fixed_components(self) -> DataFrame:
        return tariff.fixed_charges(self.rated, self.components)

    @cached_property
    def rider_components(self) -> DataFrame:
        return tariff.rider_charges(self.rated, self.energy_components)

    @cached_property
    def export_components(self) -> DataFrame:
        return tariff.export_credits(self.rated, tariff.export_rates(self.spark))

    @cached_property
    def tariff_documents(self) -> DataFrame:
        """A published tariff document per account, in the public utility-rate JSON layout."""
        u = F.col("meter_no")
        step = ((u % 7).cast("decimal(4,0)") / 100).cast("decimal(6,2)")
        off, on = (F.lit("0.08").cast("decimal(6,2)") + step), (F.lit("0.25").cast("decimal(6,2)") + step)
        evening = (F.lit(15) + u % 3).cast("int")

        def hours(first: Column) -> Column:
            on_peak = F.transform(F.sequence(F.lit(0), F.lit(23)),
                                  lambda h: F.when(h.between(first, F.lit(20)), F.lit(1)).otherwise(F.lit(0)))
            return F.concat(F.lit("["), F.concat_ws(",", F.transform(on_peak, lambda x: x.cast("string"))), F.lit("]"))

        def year(row: Column) -> Column:
            return F.concat(F.lit("["), F.concat_ws(",", F.array_repeat(row, 12)), F.lit("]"))

        flat = F.lit("[" + ",".join(["0"] * 24) + "]")
        text = F.concat(
            F.lit('{"label":"SCH-'), u.cast("string"),
            F.lit('","energyratestructure":[[{"rate":'), off.cast("string"),
            F.lit(',"max":200},{"rate":'), (off + F.lit("0.04").cast("decimal(6,2)")).cast("string"),
            F.lit('}],[{"rate":'), on.cast("string"),
            F.lit('}]],"energyweekdayschedule":'), year(hours(evening)),
            F.lit(',"energyweekendschedule":'), year(flat),
            F.lit(',"demandratestructure":[[{"rate":8.0}]],"fixedchargefirstmeter":10.0}'),
        )
        # Meter numbers are few bytes, their documents kilobytes: dealt before, so that a small table is many tasks' work.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self.feed.accounts.select("meter_no").repartition(tasks, "meter_no").select("meter_no", text.alias("document"))

    # -- service issues -----------------------------------------------------------------------

    @cached_property
    def issues(self) -> DataFrame:
        """Open issues of the last days from events, scores and estimation runs, one row each."""
        since = ntz(self.detect_from)
        events = self.feed.meter_events.filter((F.col("event_type") != "RESTORE") & (F.col("event_ts") >= since)).select(
            F.concat(F.lit("EV-"), F.col("event_id")).alias("issue_id"), F.col("event_type").alias("issue_type"),
            F.lit("METER_EVENT").alias("issue_source"), "meter_id",
            F.date_trunc("second", "event_ts").cast("timestamp_ntz").alias("detected_at"),
        )
        stamp = F.date_format("ts", "yyyyMMddHH")
        scored = self.meter_events.filter("is_anomaly").select(
            F.concat_ws("-", F.lit("AN"), "meter_id", stamp).alias("issue_id"),
            F.lit("ANOMALY").alias("issue_type"), F.lit("METER_ANOMALY").alias("issue_source"),
            "meter_id", F.col("ts").alias("detected_at"),
        )
        runs = edge.estimation_streaks(self.reads, longer_than=1).filter("is_sustained").select(
            F.concat_ws("-", F.lit("ES"), "meter_id", F.date_format("first_day", "yyyyMMdd")).alias("issue_id"),
            F.lit("SUSTAINED_ESTIMATION").alias("issue_type"), F.lit("DATA_QUALITY").alias("issue_source"),
            "meter_id", F.col("last_day").cast("timestamp_ntz").alias("detected_at"),
        ).filter(F.col("detected_at") >= since)
        accounts = self.feed.accounts.select(
            "meter_id", "customer_id", "has_der", F.col("segment").alias("customer_class"),
            (F.col("meter_no") % 8 == 0).alias("is_protected"),
        )
        versions = self.assignments.select(
            F.col("meter_id").alias("version_meter"), "schedule_id", "effective_from", "effective_to"
        )
        valid = (
            (F.col("meter_id") == F.col("version_meter")) & (F.col("detected_at") >= F.col("effective_from"))
            & (F.col("effective_to").isNull() | (F.col("detected_at") < F.col("effective_to")))
        )
        found = events.unionByName(scored).unionByName(runs).join(accounts, "meter_id")
        scheduled = found.join(versions, valid, "left").drop("version_meter", "effective_from", "effective_to")
        return calendar.dated(scheduled, F.col("detected_at")).drop("hour_local", "day_of_week")

    @cached_property
    def usual_by_hour(self) -> DataFrame:
        return self.training_reads.groupBy("meter_id", F.hour("read_ts").alias("hour")).agg(
            mean("kwh_delivered", 6).alias("usual_kwh"), mean("kwh_received", 6).alias("usual_export"),
            F.max("demand_kw").alias("usual_kw"),
        )

    @cached_property
    def meter_plans(self) -> DataFrame:
        """Current plan of each occupied meter, from the accounts alone, so that its size can be estimated."""
        return self.feed.accounts.filter(~F.col("is_vacant")).select("meter_id", "rate_plan_id")

    @cached_property
    def exposure_factors(self) -> DataFrame:
        return priority.peak_exposure(
            topology.feeder_load(self.reads, self.placed), CYCLE_DAYS, str(self.month_start)
        )

    @cached_property
    def at_risk(self) -> DataFrame:
        current = self.assignments.filter("effective_to is null").select("meter_id", "schedule_id")
        export = current.join(tariff.export_rates(self.spark), "schedule_id").select("meter_id", "export_rate")
        of_meters = priority.value_at_risk(
            self.issues, self.usual_by_hour, self.meter_plans, self.windows, self.exposure_factors, self.placed, export,
            hours_in_period=CYCLE_DAYS * 24,
        )
        return of_meters.unionByName(priority.feeder_risk(self.feeder_events))

    @cached_property
    def scored_issues(self) -> DataFrame:
        return priority.score_issues(self.at_risk, ntz(self.end_of_anchor()))
