"""Rollups that take changes instead of being computed again.

A merge tells the rows it changed, as they were and as they are (``tables.changes_of``). A level (hours of reads, days of
hours, months and billing periods of days) keeps, per group, sums with the number of values in them, and greatest and
least values; the rollup's own columns are worked out of these when it is read. A change takes the old row's values off
and adds the new row's, so what is read is the changes and the groups' own rows. Only a group that lost its greatest or
least value is computed again from the level below, which is read for such groups alone. The groups that changed are
changes of the next level, so its rounding follows the stored one, as in a full computation.

Each level of a batch is staged: the signed sums, the changed groups, then the new content of the touched partitions,
which is moved in. A refresh that dies is repeated from what is finished; changes are never applied twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadweave.functions import day_floor, hour_floor, month_floor, pct
from loadweave.sources import tables
from loadweave.sources.reference import READY_COMPLETENESS_PCT, READY_VEE_PCT
from loadweave.streaming.refresh import MartTables, at_once

PART = "part_date"


class Level(NamedTuple):
    """A rollup of the rows below it: its keys and values as expressions of such a row, and its columns as expressions of
    its state (``n`` rows, ``s_x`` the sum and ``c_x`` the number of values x, and the greatest and least by name)."""

    name: str
    part: str
    keys: dict[str, Column]
    sums: dict[str, Column]
    most: dict[str, Column]
    least: dict[str, Column]
    columns: dict[str, Column]
    #: What else is done to rows before they are grouped, such as a join with their periods.
    spread: Callable[[DataFrame], DataFrame] = lambda rows: rows

    def valued(self, rows: DataFrame, *kept: str) -> DataFrame:
        values = {**self.keys, **{f"v_{k}": v for k, v in (self.sums | self.most | self.least).items()}}
        return self.spread(rows).select(*[v.alias(k) for k, v in values.items()], *kept)

    def state(self, rows: DataFrame) -> DataFrame:
        """The level's state from the rows below."""
        return self._totals(self.valued(rows).withColumn("sign", F.lit(1)), "s_{}", "c_{}", "n", "{}", None).withColumn(
            PART, F.to_date(self.part)
        )

    def deltas(self, rows: DataFrame) -> DataFrame:
        """What rows with a sign add to each group: sums and counts, and the extremes that come and go."""
        return self._totals(self.valued(rows, "sign"), "s_{}", "c_{}", "n", "in_{}", "out_{}").withColumn(
            PART, F.to_date(self.part)
        )

    def _totals(self, rows: DataFrame, total: str, count: str, n: str, comes: str, goes: str | None) -> DataFrame:
        sign = F.col("sign")
        out = [F.sum(sign).cast("bigint").alias(n)]
        for name in self.sums:
            x = F.col(f"v_{name}")
            out += [
                F.sum(F.when(sign > 0, x).otherwise(-x)).alias(total.format(name)),
                F.coalesce(F.sum(F.when(x.isNotNull(), sign)), F.lit(0)).cast("bigint").alias(count.format(name)),
            ]
        for names, best in ((self.most, F.max), (self.least, F.min)):
            for name in names:
                x = F.col(f"v_{name}")
                out.append(best(F.when(sign > 0, x)).alias(comes.format(name)))
                if goes:
                    out.append(best(F.when(sign < 0, x)).alias(goes.format(name)))
        return rows.groupBy(*self.keys).agg(*out)

    def mart(self, state: DataFrame, *kept: str) -> DataFrame:
        return state.select(*self.keys, *[c.alias(name) for name, c in self.columns.items()], *kept, PART)


def same_keys(left: str, right: str, keys) -> Column:
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def total(name: str) -> Column:
    """A sum that is null without values, as SUM is."""
    return F.when(F.col(f"c_{name}") > 0, F.col(f"s_{name}"))


def average(name: str, scale: int) -> Column:
    return (F.col(f"s_{name}") / F.nullif(F.col(f"c_{name}"), F.lit(0))).cast(f"decimal(18,{scale})")


_ENERGY = ("kwh_delivered", "kwh_received", "kwh_net")
_MOST, _LEAST = {"max_demand_kw": "max_demand_kw", "max_voltage": "max_voltage"}, {"min_voltage": "min_voltage"}


def _by_name(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def hourly(expected: int) -> Level:
    count = F.col("n")
    return Level(
        "hourly", "rollup_ts",
        {"meter_id": F.col("meter_id"), "rollup_ts": hour_floor("read_ts"), "utility_territory": F.col("utility_territory")},
        {**_by_name("kwh_delivered", "kwh_received"), "kwh_net": F.col("kwh_delivered") - F.col("kwh_received"),
         "voltage": F.col("voltage_v"), "valid": F.when(F.col("vee_status") == "VALID", F.lit(1).cast("bigint"))},
        {"max_demand_kw": F.col("demand_kw"), "max_voltage": F.col("voltage_v")}, {"min_voltage": F.col("voltage_v")},
        {
            "rollup_grain": F.lit("HOUR"), **{k: total(k) for k in _ENERGY},
            **_by_name("max_demand_kw", "min_voltage", "max_voltage"), "avg_voltage": average("voltage", 6),
            "source_interval_count": count, "expected_interval_count": F.lit(expected),
            "completeness_pct": pct(count, F.lit(expected)), "vee_pass_pct": pct(F.col("c_valid"), count),
        },
    )


def daily(expected: int) -> Level:
    count = F.col("s_source_interval_count")
    return Level(
        "daily", "rollup_ts",
        {"meter_id": F.col("meter_id"), "rollup_ts": day_floor("rollup_ts"), "utility_territory": F.col("utility_territory")},
        _by_name(*_ENERGY, "avg_voltage", "source_interval_count", "vee_pass_pct"),
        _by_name(*_MOST), _by_name(*_LEAST),
        {
            "rollup_grain": F.lit("DAY"), **{k: total(k) for k in _ENERGY},
            **_by_name("max_demand_kw", "min_voltage", "max_voltage"), "avg_voltage": average("avg_voltage", 6),
            "source_interval_count": count, "expected_interval_count": F.lit(expected),
            "completeness_pct": pct(count, F.lit(expected)), "vee_pass_pct": average("vee_pass_pct", 2),
        },
    )


def monthly() -> Level:
    return Level(
        "monthly", "rollup_ts",
        {"meter_id": F.col("meter_id"), "rollup_ts": month_floor("rollup_ts"), "utility_territory": F.col("utility_territory")},
        _by_name(*_ENERGY, "source_interval_count", "completeness_pct", "vee_pass_pct"), _by_name(*_MOST), _by_name(*_LEAST),
        {
            "rollup_grain": F.lit("MONTH"), **{k: total(k) for k in _ENERGY},
            **_by_name("max_demand_kw", "min_voltage", "max_voltage"),
            "source_interval_count": F.col("s_source_interval_count"),
            "completeness_pct": average("completeness_pct", 2), "vee_pass_pct": average("vee_pass_pct", 2),
        },
    )


def billing(periods: DataFrame, meters: DataFrame) -> Level:
    """Billing periods of daily rows; a day counts in every period of its meter that it lies in."""
    own = ("billing_period_id", "cis_account_id", "service_point_id", "start_date", "end_date")
    metered = periods.select(*own).join(meters.select("service_point_id", "meter_id"), "service_point_id")

    def spread(days: DataFrame) -> DataFrame:
        return days.join(metered, "meter_id").filter(F.to_date("rollup_ts").between(F.col("start_date"), F.col("end_date")))

    def reached(name: str, threshold: float) -> Column:
        return F.when(F.col(f"c_{name}") > 0, F.col(f"s_{name}") >= F.col("n") * F.lit(threshold))

    ready = [F.coalesce(reached(*x), F.lit(False)) for x in (
        ("completeness_pct", READY_COMPLETENESS_PCT), ("vee_pass_pct", READY_VEE_PCT))]
    return Level(
        "billing", "start_date", _by_name("billing_period_id", "cis_account_id", "service_point_id", "meter_id", "start_date", "end_date"),
        _by_name(*_ENERGY, "completeness_pct", "vee_pass_pct"), _by_name("max_demand_kw"), {},
        {
            "kwh_total": total("kwh_delivered"), "kwh_received": total("kwh_received"), "kwh_net": total("kwh_net"),
            "max_demand_kw": F.col("max_demand_kw"), "completeness_pct": average("completeness_pct", 2),
            "vee_pass_pct": average("vee_pass_pct", 2), "is_billing_ready": ready[0] & ready[1],
        },
        spread,
    )


def signed(changes: DataFrame, *beside: str) -> DataFrame:
    """Rows to take off (sign -1) and to add (sign 1), of a frame with before and after."""
    row = lambda sign, of: F.struct(F.lit(sign).alias("sign"), F.col(of).alias("row"))
    both = F.explode(F.array(row(-1, "before"), row(1, "after"))).alias("x")
    return changes.select(*beside, both).filter("x.row is not null").select(*beside, "x.sign", "x.row.*")


def apply(
    spark: SparkSession, level: Level, rows: DataFrame, path: str, staging: str, below: Callable[[list[dt.date]], DataFrame],
) -> DataFrame | None:
    """Add signed rows to a level's stored state; returns the level's own changes, as signed rows of its mart.

    ``below`` gives the rows below of whole partitions; it is only asked where an extreme was taken off.
    """
    work, keys = f"{staging}/{level.name}", list(level.keys)
    tables.stage(level.deltas(rows), f"{work}/deltas", PART)
    parts = tables.partition_days(spark, f"{work}/deltas", PART)
    if not parts:
        return None
    delta = spark.read.parquet(f"{work}/deltas")
    whole = [c for c in delta.columns if c == "n" or c[:2] in ("s_", "c_")]
    extremes = [*level.most, *level.least]

    def stored() -> DataFrame | None:
        return spark.read.parquet(path).filter(F.col(PART).isin(parts)) if tables.exists(spark, path) else None

    if not tables.exists(spark, f"{work}/merged/_SUCCESS"):
        tables.stage(_changed(level, delta, stored(), keys, whole, extremes), f"{work}/first", PART, days=len(parts))
        changed = spark.read.parquet(f"{work}/first")
        stale = changed.filter("stale").select(*keys, PART)
        days = [r[0] for r in stale.select(PART).distinct().collect()]  # partitions, never rows
        if days:
            lost = stale.alias("l")
            again = level.state(below(days)).alias("a").join(lost, same_keys("a", "l", keys), "left_semi")
            redone = changed.filter("stale").drop("after").alias("c").join(again, same_keys("c", "a", keys), "left").select(
                *[f"c.{k}" for k in keys], "c.before",
                F.when(F.col("a.n").isNotNull(), F.struct(*[F.col(f"a.{c}").alias(c) for c in (*whole, *extremes)])).alias("after"),
                "c.stale", f"c.{PART}",
            )
            kept = changed.filter("not stale").select(*keys, "before", "after", "stale", PART)
            tables.stage(kept.unionByName(redone), f"{work}/changed", PART, days=len(parts))
        new = _new(spark, work)
        content = new.filter("after is not null").select(*keys, "after.*", PART)
        old = stored()
        if old is not None:
            kept = old.alias("o").join(new.alias("x"), same_keys("o", "x", [*keys, PART]), "left_anti")
            content = kept.select(*content.columns).unionByName(content)
        tables.stage(content, f"{work}/merged", PART, cluster=keys[:1], days=len(parts))
    tables.publish(spark, f"{work}/merged", path, PART, parts)
    new = _new(spark, work)

    # Before and after lie in one row, so the mart's rows need no join.
    return level.mart(signed(new, *keys, PART), "sign").drop(PART)


def _new(spark: SparkSession, work: str) -> DataFrame:
    """The changed groups: as first worked out, or with those that were computed again."""
    return spark.read.parquet(f"{work}/{'changed' if tables.exists(spark, f'{work}/changed/_SUCCESS') else 'first'}")


def _changed(
    level: Level, delta: DataFrame, old: DataFrame | None, keys: list[str], whole: list[str], extremes: list[str],
) -> DataFrame:
    """Each touched group before and after, and whether it lost an extreme that nothing new replaces."""
    if old is None:
        after = F.struct(*whole, *[F.col(f"in_{x}").alias(x) for x in extremes])
        before = F.lit(None).cast(delta.select(after.alias("s")).schema["s"].dataType)
        return delta.select(*keys, before.alias("before"), after.alias("after"), F.lit(False).alias("stale"), PART)
    types = {f.name: f.dataType for f in old.schema}
    d, o = delta.alias("d"), old.alias("o")
    joined = d.join(o, same_keys("d", "o", [*keys, PART]), "left")
    values, lost = [], F.lit(False)
    for c in whole:
        added = F.coalesce(F.col(f"o.{c}"), F.lit(0)) + F.coalesce(F.col(f"d.{c}"), F.lit(0))
        values.append(added.cast(types[c]).alias(c))
    for names, best, beats in ((level.most, F.greatest, lambda a, b: a >= b), (level.least, F.least, lambda a, b: a <= b)):
        for x in names:
            comes, goes, had = F.col(f"d.in_{x}"), F.col(f"d.out_{x}"), F.col(f"o.{x}")
            values.append(best(had, comes).cast(types[x]).alias(x))
            replaced = F.coalesce(beats(comes, goes), F.lit(False))
            lost = lost | (F.coalesce(beats(goes, had), F.lit(False)) & ~replaced)
    left = F.coalesce(F.col("o.n"), F.lit(0)) + F.col("d.n")
    state = F.struct(*[F.col(f"o.{c}").alias(c) for c in (*whole, *extremes)])
    return joined.select(
        *[F.col(f"d.{k}").alias(k) for k in keys], F.when(F.col("o.n").isNotNull(), state).alias("before"),
        F.when(left > 0, F.struct(*values)).alias("after"), (lost & (left > 0)).alias("stale"), F.col(f"d.{PART}").alias(PART),
    )


class DeltaMarts(MartTables):
    """Mart tables whose rollups and billing periods take changes. Marts beyond them are computed again by day."""

    def levels(self) -> list[tuple[Level, str]]:
        """Each level, and what is below it."""
        out = [
            (hourly(self.expected_per_hour), "canonical"), (daily(self.expected_per_day), "hourly"), (monthly(), "daily"),
        ]
        if self.dims is not None and "billing" in self.wider:
            out.append((billing(self.dims.periods, self.dims.meters), "daily"))
        return out

    def _state(self, name: str) -> str:
        return f"{self.root}/{name}_state"

    def read(self, mart: str) -> DataFrame:
        for level, _ in self.levels():
            if level.name == mart:
                return level.mart(self.spark.read.parquet(self._state(mart)))
        return super().read(mart)

    def days(self, mart: str, part: str = "read_date") -> list[dt.date]:
        known = {level.name for level, _ in self.levels()}
        return tables.partition_days(self.spark, self._state(mart) if mart in known else self.path(mart), part)

    def refresh(self, days: list[dt.date]) -> None:
        """Every level from all canonical reads, and the other marts of the given days: how tables begin."""
        for level, below in self.levels():
            tables.write_partitioned(level.state(self.read(below)), self._state(level.name), PART, "overwrite", [next(iter(level.keys))])
        self._others(days)

    def _others(self, days: list[dt.date]) -> None:
        if jobs := self._wider_jobs(self.read("canonical").filter(F.col("read_date").isin(days)), days):
            at_once(self.spark, *jobs)

    def _below(self, name: str) -> Callable[[list[dt.date]], DataFrame]:
        """The rows below a level's partitions: of the same days, of the months' days, or of the periods' days."""

        def rows(parts: list[dt.date]) -> DataFrame:
            if name == "hourly":
                return self.read("canonical").filter(F.col("read_date").isin(parts))
            if name == "daily":
                return self.read("hourly").filter(F.col(PART).isin(parts))
            if name == "monthly":
                return self.read("daily").filter(F.trunc(PART, "month").isin(parts))
            ends = self.dims.periods.filter(F.col("start_date").isin(parts)).agg(F.max("end_date")).first()[0]
            return self.read("daily").filter(F.col(PART).between(F.lit(min(parts)), F.lit(ends)))

        return rows

    def take(self, changes: DataFrame, staging: str) -> None:
        """Bring all marts up to a merge's changes."""
        rows = {"canonical": signed(changes, "meter_id", "read_ts", "read_date")}
        for level, below in self.levels():
            if below not in rows:
                continue

            def job(level=level, below=below) -> int:
                found = apply(
                    self.spark, level, rows[below], self._state(level.name), f"{staging}/levels", self._below(level.name)
                )
                if found is not None:
                    rows[level.name] = found
                return self.spark.read.parquet(f"{staging}/levels/{level.name}/deltas").count() if self.log else 0

            self.log.run(f"REFRESH_{level.name.upper()}", job, "INCREMENTAL") if self.log else job()
        self._others(tables.partition_days(self.spark, f"{staging}/changes", "read_date"))
