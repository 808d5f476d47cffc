"""Stored summaries of the metric model, and the choice of the coarsest one that can answer a query.

A summary has one row per combination of some dimensions, with the sum and the number of values of every fact of its base
table, and what metrics need besides (counts under a condition, bitmaps of meters). A metric is declared on those parts, so it is
the same from any summary. A rollup by meter and month is a coarser grain of the daily one for the metrics that add up over
days, and still leads to the meter's dimensions.

``Lattice.query`` takes, for the metrics of each base table, the grains that hold all metrics and all dimensions (also those
that the filter names), and of these the one with the fewest dimensions; the model's own table is the finest grain. The
facts of the model say what a summary holds.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loadweave.functions import pct, ratio
from loadweave.operators import distinct
from loadweave.plans.metrics import MetricModel, public
from loadweave.sources import tables

def beside(base: str) -> dict[str, Column]:
    """Aggregates of a base table's rows that its metrics need besides sums and counts of facts."""
    return {
        "billing": {"ready": F.count_if(F.col("is_billing_ready"))},
        "anomalies": {"flagged": F.count_if(F.col("is_anomaly"))},
    }.get(base, {})


def _mean(fact: str) -> Column:
    return (F.sum(f"sum_{fact}") / F.nullif(F.sum(f"count_{fact}"), F.lit(0))).cast("decimal(18,6)")


def merged() -> dict[str, Column]:
    """Metrics on the parts of a summary. ``meter_count`` is counted from bitmaps."""
    return {
        "total_kwh": F.sum("sum_kwh_delivered"),
        "total_kwh_net": F.sum("sum_kwh_delivered") - F.sum("sum_kwh_received"),
        "avg_completeness": _mean("completeness"),
        "billing_ready_pct": pct(F.sum("ready"), F.sum("rows"), 6),
        "total_billed_kwh": F.sum("sum_kwh_total"),
        "total_energy_charge": F.sum("sum_energy_charge"),
        "total_demand_charge": F.sum("sum_demand_charge"),
        "avg_energy_rate": ratio(F.sum("sum_energy_charge"), F.sum("sum_kwh")),
        "anomaly_count": F.sum("flagged"),
        "avg_pct_on_time": _mean("pct_on_time"),
    }


@dataclass(frozen=True)
class Grain:
    """A table that can stand for a base table: its dimensions by column, and the metrics as aggregates of it.

    ``leads_on``: it still has the base table's keys, so dimensions of other tables can be joined.
    """

    name: str
    base: str
    table: Callable[[], DataFrame]
    dimensions: dict[str, str]
    metrics: dict[str, Column]
    leads_on: bool = False


@dataclass
class Lattice:
    """Summaries of a model below a folder."""

    spark: SparkSession
    model: MetricModel
    root: str
    #: meter_id and meter_no, a dense number; for distinct counts.
    numbers: DataFrame | None = None
    grains: list[Grain] = field(default_factory=list)

    def add(self, grain: Grain) -> None:
        self.grains.append(grain)

    def _facts(self, base: str) -> dict[str, str]:
        return {name.split(".")[1]: column for name, column in self.model.facts.items() if name.split(".")[0] == base}

    def summarise(self, name: str, base: str, dimensions: Sequence[str], date: str | None = None, days: Sequence[dt.date] = ()) -> None:
        """Store a summary, or only the given days of its dimension ``date``; from then on it answers queries."""
        names = [public(d) for d in dimensions]
        rows = self.model.attached(base, dimensions)
        if days:
            rows = rows.filter(F.to_date(public(date)).isin(list(days)))
        parts = [F.count(F.lit(1)).alias("rows")]
        for fact, column in self._facts(base).items():
            parts += [F.sum(column).alias(f"sum_{fact}"), F.count(column).alias(f"count_{fact}")]
        parts += [c.alias(k) for k, c in beside(base).items()]
        self._store(rows.groupBy(*names).agg(*parts), f"{self.root}/{name}", date, days)
        have = {k: c for k, c in merged().items() if self.model.metrics[k][0] == base}
        if self.numbers is not None and base == "daily_rollup":
            numbered = rows.join(self.numbers.select("meter_id", "meter_no"), "meter_id")
            self._store(distinct.bitmaps(numbered, names, "meter_no"), f"{self.root}/{name}_meters", date, days)
        if name not in {g.name for g in self.grains}:
            own = lambda: self.spark.read.parquet(f"{self.root}/{name}").drop("part_date")
            self.add(Grain(name, base, own, dict(zip(dimensions, names)), have))

    def _store(self, rows: DataFrame, path: str, date: str | None, days: Sequence[dt.date]) -> None:
        if date is None:
            rows.write.mode("overwrite").parquet(path)
            return
        dated = rows.withColumn("part_date", F.to_date(public(date)))
        if days:
            tables.replace_partitions(dated, path, "part_date", expected=days)
        else:
            tables.write_partitioned(dated, path, "part_date", mode="overwrite")

    def members(self, name: str) -> DataFrame:
        """The meters of each row of a summary, as bitmaps."""
        return self.spark.read.parquet(f"{self.root}/{name}_meters").drop("part_date")

    def choose(self, base: str, metrics: Sequence[str], dimensions: Sequence[str], where: str | None) -> Grain | None:
        """The coarsest grain for some metrics of a base table; None for the base table itself."""
        words = set(re.findall(r"[A-Za-z_]\w*", where or ""))
        wanted = {*dimensions, *(d for d in self.model.dimensions if public(d) in words)}
        # A filter on a plain column of the base table, such as a measure, needs that table.
        plain = words & set(self.model.tables[base]().columns) if where else set()

        def fits(grain: Grain) -> bool:
            counted = {"meter_count"} if not grain.leads_on and self.numbers is not None and base == "daily_rollup" else set()
            if grain.base != base or not set(metrics) <= {*grain.metrics, *counted} or not plain <= set(grain.dimensions.values()):
                return False
            return all(d in grain.dimensions or grain.leads_on and d.split(".")[0] != base for d in wanted)

        fitting = [g for g in self.grains if fits(g)]
        return min(fitting, key=lambda g: (g.leads_on, len(g.dimensions)), default=None)

    def query(self, metrics: Sequence[str], dimensions: Sequence[str] = (), where: str | None = None) -> DataFrame:
        """As ``MetricModel.query``, from the coarsest tables."""
        return self.model.query(metrics, dimensions, where, self._part)

    def _part(self, base: str, metrics: Sequence[str], dimensions: Sequence[str], where: str | None) -> DataFrame | None:
        grain = self.choose(base, metrics, dimensions, where)
        if grain is None:
            return None
        names = [public(d) for d in dimensions]
        if grain.leads_on:
            rows = self.model.attached(base, dimensions, where, grain.table(), grain.dimensions)
            return rows.groupBy(*names).agg(*[grain.metrics[m].alias(m) for m in metrics])
        rows, plain = grain.table(), [m for m in metrics if m != "meter_count"]
        rows = rows.filter(where) if where else rows
        out = rows.groupBy(*names).agg(*([grain.metrics[m].alias(m) for m in plain] or [F.count(F.lit(1)).alias("_rows")]))
        if "meter_count" in metrics:
            maps = self.members(grain.name)
            sizes = distinct.counted(maps.filter(where) if where else maps, names, "meter_count")
            if names:
                left, right = out.alias("l"), sizes.alias("r")
                same = F.lit(True)
                for n in names:
                    same = same & F.col(f"l.{n}").eqNullSafe(F.col(f"r.{n}"))
                out = left.join(right, same, "left").select("l.*", F.coalesce("r.meter_count", F.lit(0)).alias("meter_count"))
            else:
                one = F.lit(1).alias("_one")
                out = out.select("*", one).join(sizes.select(F.coalesce("meter_count", F.lit(0)).alias("meter_count"), one), "_one").drop("_one")
        return out.select(*names, *metrics)


def standard_lattice(spark: SparkSession, model: MetricModel, root: str, numbers: DataFrame, monthly: Callable[[], DataFrame]) -> Lattice:
    """Summaries by day and territory, by territory and premise, by bucket, and the monthly rollup as a coarser daily one."""
    lattice = Lattice(spark, model, root, numbers)
    lattice.summarise("daily_by_territory", "daily_rollup", ["daily_rollup.rollup_date", "daily_rollup.territory", "meter.territory"], "daily_rollup.rollup_date")
    lattice.summarise("daily_by_premise", "daily_rollup", ["daily_rollup.rollup_date", "meter.territory", "service_point.premise", "meter.has_der"], "daily_rollup.rollup_date")
    lattice.summarise("charges_by_bucket", "charge_line", ["charge_line.tou_bucket", "meter.territory"])
    lattice.summarise("billing_by_start", "billing", ["billing.start_date", "meter.territory", "service_point.premise"], "billing.start_date")
    lattice.summarise("sla_by_territory", "sla", ["sla.territory"])
    lattice.add(Grain("monthly", "daily_rollup", monthly, {}, {
        "total_kwh": F.sum("kwh_delivered"), "total_kwh_net": F.sum("kwh_delivered") - F.sum("kwh_received"),
        "meter_count": F.countDistinct("meter_id"),
    }, leads_on=True))
    return lattice
