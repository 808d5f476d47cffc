"""Metric layer: named metrics and dimensions over the marts, joined along many-to-one edges."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loadweave.functions import pct, ratio
from loadweave.plans.marts import Marts


@dataclass(frozen=True)
class Edge:
    """Many rows of ``child`` point at one row of ``parent``."""

    child: str
    parent: str
    key: str


@dataclass
class MetricModel:
    tables: dict[str, Callable[[], DataFrame]]
    edges: list[Edge]
    dimensions: dict[str, str]
    metrics: dict[str, tuple[str, Column]]
    facts: dict[str, str] = field(default_factory=dict)

    def path(self, base: str, target: str) -> list[Edge]:
        """Edges from ``base`` up to ``target``; there is none if rows would multiply."""
        frontier: list[tuple[str, list[Edge]]] = [(base, [])]
        while frontier:
            table, taken = frontier.pop(0)
            if table == target:
                return taken
            frontier += [(e.parent, taken + [e]) for e in self.edges if e.child == table]
        raise ValueError(f"{target} cannot be reached from {base} without fanning out")

    def attached(
        self, base: str, dims: Sequence[str], where: str | None = None, table: DataFrame | None = None,
        columns: dict[str, str] | None = None,
    ) -> DataFrame:
        """The base table with the wanted dimensions attached, each under its public name.

        ``table`` may stand for the base table if it has its keys; ``columns`` are its own dimensions.
        """
        edges: list[Edge] = []
        for dim in dims:
            for edge in self.path(base, dim.split(".")[0]):
                if edge not in edges:
                    edges.append(edge)
        frame = self.tables[base]() if table is None else table
        known = self.dimensions if columns is None else columns
        own = [d for d in dims if d.split(".")[0] == base]
        frame = frame.select("*", *[F.col(known[d]).alias(public(d)) for d in own])
        for edge in edges:
            parent = self.tables[edge.parent]()
            wanted = [d for d in dims if d.split(".")[0] == edge.parent]
            keys = {e.key for e in edges if e.child == edge.parent}
            cols = [F.col(edge.key)] + [F.col(k) for k in keys if k != edge.key and k not in frame.columns] + [
                F.col(self.dimensions[d]).alias(public(d)) for d in wanted
            ]
            frame = frame.join(parent.select(*cols), edge.key)
        return frame.filter(where) if where else frame

    def query(
        self, metrics: Sequence[str], dimensions: Sequence[str] = (), where: str | None = None,
        stored: Callable[[str, list[str], Sequence[str], str | None], DataFrame | None] = lambda *_: None,
    ) -> DataFrame:
        """Metrics by dimensions. Metrics of different tables are joined on equal dimension values.

        ``stored`` may answer the metrics of one base table from a summary (see ``plans.lattice``).
        """
        unknown = [m for m in metrics if m not in self.metrics] + [d for d in dimensions if d not in self.dimensions]
        if unknown:
            raise ValueError(f"unknown: {', '.join(unknown)}")
        names = [public(d) for d in dimensions]
        parts: dict[str, list[str]] = {}
        for metric in metrics:
            parts.setdefault(self.metrics[metric][0], []).append(metric)
        def part(base: str, wanted: list[str]) -> DataFrame:
            found = stored(base, wanted, dimensions, where)
            if found is not None:
                return found
            rows = self.attached(base, dimensions, where)
            return rows.groupBy(*names).agg(*[self.metrics[m][1].alias(m) for m in wanted])

        frames = [part(base, wanted) for base, wanted in parts.items()]

        def attach(left: DataFrame, right: DataFrame) -> DataFrame:
            if not names:
                one = F.lit(1).alias("one")
                return left.select("*", one).join(right.select("*", one), "one").drop("one")
            right = right.select([F.col(c).alias(f"{c}__r") if c in names else F.col(c) for c in right.columns])
            same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}__r")) for n in names])
            joined = left.join(right, same, "full_outer")
            rest = [c for c in joined.columns if c not in names and not c.endswith("__r")]
            return joined.select(*[F.coalesce(n, f"{n}__r").alias(n) for n in names], *rest)

        return reduce(attach, frames).select(*names, *metrics)


def public(dimension: str) -> str:
    return dimension.replace(".", "_")


def exact(name: str, scale: int = 6) -> Column:
    return (F.sum(name) / F.nullif(F.count(name), F.lit(0))).cast(f"decimal(18,{scale})")


def standard_model(m: Marts) -> MetricModel:
    tables = {
        "daily_rollup": lambda: m.daily,
        "billing": lambda: m.consumption,
        "charge_line": lambda: m.charges,
        "anomalies": lambda: m.feeder_events,
        "meter": lambda: m.feed.lookup.meters,
        "service_point": lambda: m.feed.lookup.service_points,
        "sla": lambda: m.sla,
    }
    edges = [
        Edge("daily_rollup", "meter", "meter_id"),
        Edge("billing", "meter", "meter_id"),
        Edge("charge_line", "meter", "meter_id"),
        Edge("meter", "service_point", "service_point_id"),
    ]
    dimensions = {
        "daily_rollup.rollup_date": "rollup_ts", "daily_rollup.territory": "utility_territory",
        "billing.start_date": "start_date", "billing.is_billing_ready": "is_billing_ready",
        "billing.cis_account": "cis_account_id",
        "charge_line.tou_bucket": "tou_bucket", "charge_line.rate_plan": "rate_plan_id",
        "anomalies.feeder": "feeder_id", "anomalies.ts": "ts", "anomalies.is_anomaly": "is_anomaly",
        "meter.meter_type": "meter_type", "meter.has_der": "has_der", "meter.territory": "utility_territory",
        "service_point.premise": "premise_type", "service_point.feeder": "feeder_id",
        "sla.date_key": "date_key", "sla.territory": "utility_territory",
    }
    facts = {
        "daily_rollup.kwh_delivered": "kwh_delivered", "daily_rollup.kwh_received": "kwh_received",
        "daily_rollup.max_demand": "max_demand_kw", "daily_rollup.completeness": "completeness_pct",
        "billing.kwh_total": "kwh_total", "billing.kwh_net": "kwh_net",
        "billing.completeness": "completeness_pct",
        "charge_line.energy_charge": "energy_charge", "charge_line.demand_charge": "demand_charge",
        "charge_line.kwh": "kwh", "anomalies.distance": "distance", "anomalies.kwh": "kwh",
        "sla.pct_on_time": "pct_arrived_within_15min", "sla.late_arrivals": "late_arrival_count",
    }
    n = F.count(F.lit(1))
    metrics = {
        "total_kwh": ("daily_rollup", F.sum("kwh_delivered")),
        "total_kwh_net": ("daily_rollup", F.sum("kwh_delivered") - F.sum("kwh_received")),
        "avg_completeness": ("daily_rollup", exact("completeness_pct")),
        "meter_count": ("daily_rollup", F.countDistinct("meter_id")),
        "billing_ready_pct": ("billing", pct(F.count_if(F.col("is_billing_ready")), n, 6)),
        "total_billed_kwh": ("billing", F.sum("kwh_total")),
        "total_energy_charge": ("charge_line", F.sum("energy_charge")),
        "total_demand_charge": ("charge_line", F.sum("demand_charge")),
        "avg_energy_rate": ("charge_line", ratio(F.sum("energy_charge"), F.sum("kwh"))),
        "anomaly_count": ("anomalies", F.count_if(F.col("is_anomaly"))),
        "avg_pct_on_time": ("sla", exact("pct_arrived_within_15min")),
    }
    return MetricModel(tables, edges, dimensions, metrics, facts)
