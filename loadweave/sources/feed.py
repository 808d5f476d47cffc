"""Meter feed derived from the driver's ``events``, ``customer``, ``nation`` and ``region`` tables.

An event is one transmitted read, a user is a meter, a nation a feeder, a region a substation
(FIXTURES.md, part B). Nothing here is needed in a deployment with real reads and dimensions: the
operators take those frames directly.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadweave.operators.edge import repeated_slots
from loadweave.operators.ingest import last_write_wins
from loadweave.sources.reference import SEGMENTS, TERRITORY_ZONES


def padded(prefix: str, number: str, width: int) -> str:
    """SQL of a zero-padded id that never truncates a longer number."""
    text = f"cast({number} as string)"
    return f"concat('{prefix}', if(length({text}) < {width}, lpad({text}, {width}, '0'), {text}))"


def coordinate(number: str, base: int, step: int, span: int) -> str:
    """SQL that spreads a number over a coordinate range in hundredths of a degree."""
    return f"cast({base} + cast(({number} * {step}) % {span} as decimal(9,2)) / 100 as decimal(9,6))"


def lookup(key: str, table: dict[str, str]) -> str:
    return f"case {key} " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + " end"


TERRITORY = "case {} when 0 then 'NE' when 1 then 'SE' when 2 then 'MW' else 'W' end"


def _slot(t: dt.datetime) -> dt.datetime:
    return t.replace(minute=t.minute // 15 * 15, second=0, microsecond=0)


def event_columns(events: DataFrame) -> DataFrame:
    """One transmitted read per event, compact: nothing that the meter's dimensions determine."""
    delay = "if(event_id % 50 = 0, 1800 + (event_id * 7919) % 12600, 5)"
    return events.selectExpr(
        "user_id", "window(ts, '15 minutes').start as read_ts", "event_id",
        f"ts + make_dt_interval(0, 0, 0, {delay}) as ingested_at", "value",
        "cast(get_json_object(props, '$.k') as int) as k",
    )


class MeterFeed:
    """Lazy frames over one data folder.

    A meter is an account that ever transmitted, and finding those takes a pass over the facts.
    Frames that are only looked up from facts need no such pass, as every read has its account:
    ``lookup`` gives the same dimensions over all accounts for that purpose.
    """

    def __init__(self, spark: SparkSession, root: str, only_metered: bool = True):
        self.spark, self.root, self.only_metered = spark, root.rstrip("/"), only_metered

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    # -- dimensions ---------------------------------------------------------------------------

    @cached_property
    def lookup(self) -> MeterFeed:
        twin = MeterFeed(self.spark, self.root, only_metered=False)
        twin.accounts = self.accounts
        return twin

    @cached_property
    def accounts(self) -> DataFrame:
        """Everything a meter number determines, for every customer row.

        The territory of a nation is looked up in a map of one row (the nation table is a list of countries) instead of
        joined: the planner takes a join for the product of its sides, and would never broadcast what comes out.
        """
        pairs = F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n_regionkey")))
        regions = self.table("nation").agg(pairs.alias("regions")).scalar()
        found = self.table("customer").withColumn("n_regionkey", F.element_at(regions, F.col("c_nationkey")))
        base = found.filter(F.col("n_regionkey").isNotNull()).selectExpr(
            "c_custkey as meter_no", "n_regionkey", "c_nationkey as n_nationkey",
            "case c_mktsegment when 'MACHINERY' then 'CNI' when 'AUTOMOBILE' then 'SMB' else 'RES' end as premise_type",
            TERRITORY.format("n_regionkey") + " as utility_territory",
        )
        u, xfm = "meter_no", "(n_nationkey * 4 + meter_no % 4)"
        return base.selectExpr(
            u, padded("MTR-", u, 6) + " as meter_id", padded("SP-", u, 6) + " as service_point_id",
            padded("ADDR-", u, 6) + " as address_id", padded("CUST-", u, 6) + " as customer_id",
            padded("CIS-", u, 6) + " as cis_account_id", "premise_type", "meter_no % 10 = 3 as has_der",
            "utility_territory", padded("SUB-", "n_regionkey", 4) + " as substation_id",
            padded("FDR-", "n_nationkey", 5) + " as feeder_id", f"{xfm} as transformer_no",
            padded("XFM-", xfm, 6) + " as transformer_id",
            coordinate(u, 30, 37, 1500) + " as lat", coordinate(u, -120, 53, 4500) + " as lon",
            "case when meter_no % 10 < 4 then 'RP-FLAT' when meter_no % 10 < 9 then 'RP-TOU3' else 'RP-CPP' end as rate_plan_id",
            "meter_no % 16 = 15 as is_vacant",
            "date_sub(date'2024-01-01', cast(365 + (meter_no * 37) % 3286 as int)) as install_date",
            lookup("utility_territory", TERRITORY_ZONES) + " as timezone",
            lookup("premise_type", SEGMENTS) + " as segment",
        )

    @cached_property
    def metered_accounts(self) -> DataFrame:
        """Accounts that ever transmitted; tasks reduce the facts to distinct meter numbers first."""
        if not self.only_metered:
            return self.accounts
        seen = self.events.selectExpr("user_id as meter_no").distinct()
        return self.accounts.join(seen, "meter_no", "left_semi")

    @cached_property
    def meters(self) -> DataFrame:
        return self.metered_accounts.selectExpr(
            "meter_id", "service_point_id", "premise_type as meter_type", "has_der", "install_date",
            "'ACTIVE' as status", "utility_territory", "timezone",
            "concat('FW-', cast(meter_no % 4 + 1 as string), '.0') as firmware_version",
        )

    @cached_property
    def service_points(self) -> DataFrame:
        return self.metered_accounts.select(
            "service_point_id", "address_id", "premise_type", "feeder_id", "transformer_id",
            "utility_territory", "lat", "lon",
        )

    @cached_property
    def placed(self) -> DataFrame:
        """Meter to network position, the pre-joined topology that facts look up."""
        return self.metered_accounts.select(
            "meter_id", "service_point_id", "feeder_id", "transformer_id", "lat", "lon", "utility_territory"
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.metered_accounts.filter("not is_vacant").selectExpr(
            "customer_id", "cis_account_id", "segment", "rate_plan_id",
            "date'2023-01-01' as start_date", "cast(null as date) as end_date",
        )

    @cached_property
    def transformers(self) -> DataFrame:
        return self.accounts.select("transformer_no", "transformer_id", "feeder_id").distinct().selectExpr(
            "transformer_id", "feeder_id",
            "cast(case transformer_no % 4 when 0 then 25 when 1 then 50 when 2 then 100 else 250 end as decimal(8,2)) as kva_rating",
            "if(transformer_no % 2 = 0, 'SINGLE', 'THREE') as phase",
        )

    @cached_property
    def feeders(self) -> DataFrame:
        return self.table("nation").selectExpr(
            padded("FDR-", "n_nationkey", 5) + " as feeder_id", padded("SUB-", "n_regionkey", 4) + " as substation_id",
            TERRITORY.format("n_regionkey") + " as utility_territory",
            "cast(case n_nationkey % 3 when 0 then 4.16 when 1 then 13.2 else 34.5 end as decimal(6,2)) as voltage_kv",
        )

    @cached_property
    def substations(self) -> DataFrame:
        return self.table("region").selectExpr(
            padded("SUB-", "r_regionkey", 4) + " as substation_id", "concat('Substation ', r_name) as substation_name",
            TERRITORY.format("r_regionkey") + " as utility_territory",
            coordinate("r_regionkey", 30, 37, 1500) + " as lat", coordinate("r_regionkey", -120, 53, 4500) + " as lon",
        )

    @cached_property
    def links(self) -> DataFrame:
        """Service-point history: every seventh meter changed customer on 2024-01-15."""
        change, start = "timestamp_ntz'2024-01-15 00:00:00'", "timestamp_ntz'2023-01-01 00:00:00'"
        current = (
            f"named_struct('effective_from', if(meter_no % 7 = 0, {change}, {start}), "
            "'effective_to', cast(null as timestamp_ntz), 'is_current', true)"
        )
        closed = f"named_struct('effective_from', {start}, 'effective_to', {change}, 'is_current', false)"
        return self.metered_accounts.selectExpr(
            "meter_id", "service_point_id", "if(not is_vacant, customer_id, null) as customer_id",
            f"explode(if(meter_no % 7 = 0, array({closed}, {current}), array({current}))) as span",
        ).select("meter_id", "service_point_id", "customer_id", "span.*")

    # -- facts --------------------------------------------------------------------------------

    def _typed(self, compact: DataFrame) -> DataFrame:
        """Join the meter's dimensions to compact reads and spell out the canonical columns."""
        a = self.accounts.select("meter_no", "meter_id", "utility_territory", "timezone", "has_der")
        return compact.join(a, compact.user_id == a.meter_no).selectExpr(
            "meter_id", "read_ts", "convert_timezone('UTC', timezone, read_ts) as read_local_ts",
            "cast(value as decimal(14,4)) as kwh_delivered",
            "if(has_der, cast(value / 10 as decimal(14,4)), cast(0 as decimal(14,4))) as kwh_received",
            "cast(value * 4 as decimal(10,4)) as demand_kw",
            "cast(234 + (event_id * 31) % 13 as decimal(6,2)) as voltage_v",
            "case when k = 0 then 'F' when k in (1, 2) then 'E' else 'A' end as quality_flag",
            "case when k = 0 then 'FAILED' when k in (1, 2) then 'ESTIMATED' else 'VALID' end as vee_status",
            "if(k in (1, 2), 'LOAD_PROFILE', null) as estimation_method",
            "event_id", "utility_territory",
            "concat('feed-', date_format(ingested_at, 'yyyyMMdd')) as source_file",
            "ingested_at", "timestampdiff(SECOND, read_ts, ingested_at) as ingestion_lag_sec",
        )

    @cached_property
    def transmitted(self) -> DataFrame:
        """Every typed read as sent, duplicates included."""
        return self._typed(event_columns(self.events))

    @cached_property
    def arrivals(self) -> DataFrame:
        """What arrived per meter and ingestion hour: n_rows, n_failed, first_arrival, ingested_at (the last).

        Raw copies are combined on the raw meter number before the accounts are joined, so a meter that
        retransmits without end is one row an hour and task.
        """
        hour = F.date_trunc("hour", "ingested_at").cast("timestamp_ntz").alias("batch")
        counted = event_columns(self.events).groupBy("user_id", hour).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("k") == 0).alias("n_failed"),
            F.min("ingested_at").alias("first_arrival"), F.max("ingested_at").alias("ingested_at"),
        )
        return self._named(counted)

    @cached_property
    def repeated(self) -> DataFrame:
        """Slots that were sent more than once, told on raw rows, then named."""
        raw = event_columns(self.events).withColumn("kwh_delivered", F.expr("cast(value as decimal(14,4))"))
        return self._named(repeated_slots(raw, ["user_id", "read_ts"]))

    def _named(self, counted: DataFrame) -> DataFrame:
        a = self.accounts.select("meter_no", "meter_id", "utility_territory")
        return counted.join(a, counted.user_id == a.meter_no).drop("meter_no", "user_id")

    @cached_property
    def reads(self) -> DataFrame:
        """Canonical reads, one per meter and slot.

        Duplicates go before the dimension join: the shuffle then carries five narrow columns, and
        a meter that retransmits without end is down to one row per slot when the join sees it.
        """
        compact = last_write_wins(
            event_columns(self.events), keys=["user_id", "read_ts"], newest=["ingested_at", "event_id"]
        )
        return self._typed(compact)

    def reads_between(self, first: dt.datetime, last: dt.datetime) -> DataFrame:
        """Canonical reads whose slot lies in a closed range.

        The slot is computed, so the range is put on the transmission time whose slot it is: that
        reaches the Parquet scan, and whole slots stay together, so deduplication is unaffected.
        """
        step = dt.timedelta(minutes=15)
        low, high = _slot(first + step - dt.timedelta(microseconds=1)), _slot(last) + step
        ts = F.col("ts")
        inside = self.events.filter(
            (ts >= F.lit(str(low)).cast("timestamp_ntz")) & (ts < F.lit(str(high)).cast("timestamp_ntz"))
        )
        return self._typed(last_write_wins(
            event_columns(inside), keys=["user_id", "read_ts"], newest=["ingested_at", "event_id"]
        ))

    @cached_property
    def meter_events(self) -> DataFrame:
        kind = F.col("event_type")
        return self.events.filter(kind.isin("error", "signup", "purchase", "click")).select(
            F.col("event_id").cast("string").alias("event_id"),
            F.expr(padded("MTR-", "user_id", 6)).alias("meter_id"),
            F.col("ts").alias("event_ts"),
            F.when(kind == "error", "OUTAGE").when(kind == "signup", "RESTORE")
            .when(kind == "purchase", "TAMPER").otherwise("COMMS_LOSS").alias("event_type"),
            F.parse_json(F.col("props")).alias("event_payload"), F.col("props").alias("payload_text"),
        )

    @cached_property
    def payloads(self) -> DataFrame:
        """The reads as the JSON text a head end would send."""
        t = self.transmitted

        def text(name: str) -> Column:
            return F.concat(F.lit(f'"{name}":"'), F.col(name), F.lit('"'))

        def number(name: str) -> Column:
            return F.concat(F.lit(f'"{name}":'), F.col(name).cast("string"))

        stamp = F.date_format("read_ts", "yyyy-MM-dd'T'HH:mm:ss")
        method = F.when(F.col("estimation_method").isNull(), F.lit('"estimation_method":null')).otherwise(
            text("estimation_method")
        )
        fields = F.concat_ws(
            ",", text("meter_id"), F.concat(F.lit('"read_ts":"'), stamp, F.lit('"')),
            number("kwh_delivered"), number("kwh_received"), number("demand_kw"), number("voltage_v"),
            text("quality_flag"), text("vee_status"), method, F.lit('"event_id":null'),
            F.concat(F.lit('"territory":"'), F.col("utility_territory"), F.lit('"')),
        )
        return t.select(
            F.concat(F.lit("{"), fields, F.lit("}")).alias("payload_text"),
            "source_file", "ingested_at", "event_id",
        )
