"""Tariff schedules made of components, and what each component charges.

The per-period windows below order a meter's reads inside one billing period. Canonical reads hold one
row per meter and slot, so such a group has at most 96 rows per day of the period.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from loadweave.functions import pct, ratio
from loadweave.operators.calendar import dated
from loadweave.sources.reference import HOLIDAYS, inline

# Component id, schedule, type, bucket, day type (ALL or one), first and last minute,
# tier from and to (null: unbounded), rate, unit.
COMPONENTS = [
    ("C-D-1", "S-TIERED", "ENERGY", "ALL_DAY", "ALL", 0, 1439, "0", "200", "0.10000", "KWH"),
    ("C-D-2", "S-TIERED", "ENERGY", "ALL_DAY", "ALL", 0, 1439, "200", "500", "0.14000", "KWH"),
    ("C-D-3", "S-TIERED", "ENERGY", "ALL_DAY", "ALL", 0, 1439, "500", None, "0.18000", "KWH"),
    ("C-D-F", "S-TIERED", "FIXED", None, "ALL", 0, 1439, None, None, "10.00000", "MONTH"),
    ("C-T-1", "S-TOU", "ENERGY", "OFF_PEAK", "WEEKDAY", 0, 959, "0", None, "0.09000", "KWH"),
    ("C-T-2", "S-TOU", "ENERGY", "ON_PEAK", "WEEKDAY", 960, 1259, "0", None, "0.30000", "KWH"),
    ("C-T-3", "S-TOU", "ENERGY", "OFF_PEAK", "WEEKDAY", 1260, 1439, "0", None, "0.09000", "KWH"),
    ("C-T-4", "S-TOU", "ENERGY", "OFF_PEAK", "WEEKEND", 0, 1439, "0", None, "0.09000", "KWH"),
    ("C-T-5", "S-TOU", "ENERGY", "OFF_PEAK", "HOLIDAY", 0, 1439, "0", None, "0.09000", "KWH"),
    ("C-T-D", "S-TOU", "DEMAND", "ON_PEAK", "WEEKDAY", 960, 1259, None, None, "8.00000", "KW"),
    ("C-T-F", "S-TOU", "FIXED", None, "ALL", 0, 1439, None, None, "15.00000", "MONTH"),
    ("C-L-1", "S-LARGE", "ENERGY", "ALL_DAY", "ALL", 0, 1439, "0", None, "0.07000", "KWH"),
    ("C-L-D", "S-LARGE", "DEMAND", "ALL_DAY", "ALL", 0, 1439, None, None, "12.00000", "KW"),
    ("C-L-X", "S-LARGE", "DEMAND_FACILITY", "ALL_DAY", "ALL", 0, 1439, None, None, "3.00000", "KW"),
    ("C-L-F", "S-LARGE", "FIXED", None, "ALL", 0, 1439, None, None, "100.00000", "MONTH"),
]
# Schedule and the export rule it follows.
SCHEDULE_EXPORT = [("S-TIERED", "NEM2"), ("S-TOU", "NEM3"), ("S-LARGE", "NEM3")]
# Export rule and credit per kWh.
EXPORT_RATES = [("NEM2", "0.12000"), ("NEM3", "0.05000")]
# Rider, what it applies to, rate, unit.
RIDERS = [
    ("PPP", "DELIVERED", "0.01200", "KWH"),
    ("WILDFIRE", "ALL", "0.00500", "KWH"),
    ("EXPORT_FEE", "RECEIVED", "0.00300", "KWH"),
    ("DWREC", "ALL", "0.02000", "METER_DAY"),
    ("TBSURCHG", "ALL", "2.50000", "PCT"),
]
# The same with the day each version begins and the day it ends (exclusive; none: in force).
RIDER_VERSIONS = [
    ("PPP", "DELIVERED", "0.01200", "KWH", "2023-01-01", "2024-01-16"),
    ("PPP", "DELIVERED", "0.01400", "KWH", "2024-01-16", None),
    ("WILDFIRE", "ALL", "0.00500", "KWH", "2024-01-07", None),
    ("DWREC", "ALL", "0.02000", "METER_DAY", "2023-01-01", "2024-01-25"),
    ("TBSURCHG", "ALL", "2.50000", "PCT", "2024-01-14", "2024-01-28"),
    ("PEAK", "DEMAND", "0.15000", "KW", "2024-01-05", "2024-01-15"),
]


def components(spark: SparkSession) -> DataFrame:
    return inline(spark, COMPONENTS, [
        ("component_id", "string"), ("schedule_id", "string"), ("component_type", "string"),
        ("tou_bucket", "string"), ("component_day", "string"), ("start_minute", "int"),
        ("end_minute", "int"), ("tier_from_kwh", "decimal(14,4)"), ("tier_to_kwh", "decimal(14,4)"),
        ("rate", "decimal(10,5)"), ("unit", "string"),
    ])


def export_rates(spark: SparkSession) -> DataFrame:
    rules = inline(spark, SCHEDULE_EXPORT, [("schedule_id", "string"), ("nem_version", "string")])
    rates = inline(spark, EXPORT_RATES, [("nem_version", "string"), ("export_rate", "decimal(10,5)")])
    return rules.join(rates, "nem_version")


def as_of(facts: DataFrame, history: DataFrame, key: str, ts: str = "read_ts") -> DataFrame:
    """Rows with the history version valid at their time; ends are exclusive, so at most one matches."""
    versions = history.withColumnRenamed(key, "version_key")
    return facts.join(
        versions,
        (F.col(key) == F.col("version_key"))
        & (F.col(ts) >= F.col("effective_from"))
        & (F.col("effective_to").isNull() | (F.col(ts) < F.col("effective_to"))),
    ).drop("version_key")


def as_of_long(facts: DataFrame, history: DataFrame, key: str, ts: str = "read_ts", per: str = "month") -> DataFrame:
    """The same for long histories: versions are carried along the facts instead of being compared with them.

    Facts and versions of a key are sorted by time together, and the last version before a fact is its own; no fact meets
    more than one version. A key's time is cut into pieces (``per`` a month, day, ...), each of which begins with the
    version that was in force, so that a key with very many facts is many groups. Versions of one key do not overlap.
    """
    piece = lambda at: F.date_trunc(per, at).cast("timestamp_ntz")
    columns = [c for c in history.columns if c != key]
    marks = history.filter(F.col("effective_from").isNotNull()).select(
        F.col(key).alias("_key"), F.col("effective_from").alias("_at"), F.struct(*columns).alias("_version")
    ).withColumn("_piece", piece("_at"))
    rows = facts.select(F.col(key).alias("_key"), F.col(ts).alias("_at"), F.struct("*").alias("_fact"), piece(ts).alias("_piece"))
    # One row per key and piece: the piece's last version, and whether it has facts.
    pieces = marks.select("_key", "_piece", "_at", "_version", F.lit(False).alias("_has")).unionByName(
        rows.select("_key", "_piece", F.lit(True).alias("_has")).distinct(), allowMissingColumns=True
    ).groupBy("_key", "_piece").agg(F.max_by("_version", "_at").alias("_version"), F.max("_has").alias("_has"))
    earlier = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    seeds = pieces.withColumn("_version", F.last("_version", True).over(earlier)).filter("_has and _version is not null").select(
        "_key", F.col("_piece").alias("_at"), "_version", "_piece", F.lit(0).alias("_turn")
    )
    together = seeds.unionByName(marks.withColumn("_turn", F.lit(1))).unionByName(
        rows.withColumn("_turn", F.lit(2)), allowMissingColumns=True
    )
    so_far = Window.partitionBy("_key", "_piece").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    found = together.withColumn("_version", F.last("_version", True).over(so_far)).filter("_turn = 2 and _version is not null")
    return found.filter(
        F.col("_version.effective_to").isNull() | (F.col("_at") < F.col("_version.effective_to"))
    ).select("_fact.*", "_version.*")


# -- tariff documents -----------------------------------------------------------------------------

TARIFF_DOC = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("energyratestructure", T.ArrayType(T.ArrayType(T.StructType([
        T.StructField("rate", T.DecimalType(10, 5)), T.StructField("max", T.DecimalType(14, 4)),
    ])))),
    T.StructField("energyweekdayschedule", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("energyweekendschedule", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("demandratestructure", T.ArrayType(T.ArrayType(T.StructType([
        T.StructField("rate", T.DecimalType(10, 5)), T.StructField("max", T.DecimalType(14, 4)),
    ])))),
    T.StructField("demandweekdayschedule", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("demandweekendschedule", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("fixedchargefirstmeter", T.DecimalType(8, 2)),
])


def flatten_documents(docs: DataFrame, text: str = "document") -> DataFrame:
    """Published tariff documents to component rows.

    Hours of one period are merged into windows inside the row: a window starts where the period
    differs from the hour before. No shuffle is involved. Scheduled rates come from one reading of a
    document; a second one, of its short fields alone, gives what holds at all hours.
    """
    scheduled = _scheduled(docs.select(F.from_json(text, TARIFF_DOC).alias("d")))
    short = T.StructType([f for f in TARIFF_DOC if not f.name.startswith("energy")])
    return scheduled.unionByName(_unscheduled(docs.select(F.from_json(text, short).alias("d"))))


def _unscheduled(docs: DataFrame) -> DataFrame:
    """Demand rates without a schedule, and fixed charges."""
    d = F.col("d")
    all_day = d["demandweekdayschedule"].isNull() & d["demandweekendschedule"].isNull()
    demand = F.transform(F.when(all_day, d["demandratestructure"]), lambda tiers, period: F.struct(
        F.lit("DEMAND").alias("component_type"), period.alias("period"), F.lit(1).alias("tier"),
        tiers[0]["rate"].alias("rate"), F.lit("KW").alias("unit"),
    ))
    no = F.lit(None).cast("int")
    fixed = F.when(d["fixedchargefirstmeter"].isNotNull(), F.array(F.struct(
        F.lit("FIXED").alias("component_type"), no.alias("period"), no.alias("tier"),
        d["fixedchargefirstmeter"].cast("decimal(10,5)").alias("rate"), F.lit("MONTH").alias("unit"),
    )))
    rows = F.concat(F.coalesce(demand, F.array()), F.coalesce(fixed, F.array()))
    return docs.select(d["label"].alias("schedule_id"), F.explode(rows).alias("c")).select(
        "schedule_id", "c.component_type", F.lit("ALL").alias("day_type"), no.alias("month"),
        F.lit(0).alias("start_hour"), F.lit(23).alias("end_hour"), "c.period", "c.tier",
        F.lit(None).cast("decimal(14,4)").alias("tier_from_kwh"), F.lit(None).cast("decimal(14,4)").alias("tier_to_kwh"),
        "c.rate", "c.unit",
    )


def _scheduled(docs: DataFrame) -> DataFrame:
    """Component rows of energy and demand rates, by the windows of their weekday and weekend schedules."""
    def kind(name: str, component_type: str, unit: str, day: str) -> Column:
        return F.struct(
            F.lit(component_type).alias("component_type"), F.lit(unit).alias("unit"), F.lit(day).alias("day_type"),
            F.col(f"d.{name}ratestructure").alias("structure"), F.col(f"d.{name}{day.lower()}schedule").alias("months"),
        )

    kinds = F.explode(F.array(*(
        kind(*of, day) for of in (("energy", "ENERGY", "KWH"), ("demand", "DEMAND", "KW")) for day in ("WEEKDAY", "WEEKEND")
    )))
    own = ["label", "component_type", "unit", "day_type", "structure"]
    monthly = docs.select(F.col("d.label").alias("label"), kinds.alias("s")).select("label", "s.*").select(
        *own, F.posexplode("months").alias("m", "hours")
    )
    starts = F.filter(
        F.sequence(F.lit(0), F.size("hours") - 1),
        lambda h: (h == 0) | (F.get(F.col("hours"), h) != F.get(F.col("hours"), h - 1)),
    )
    # Outer, as for an inner one the planner adds a filter that finds the starts twice more; a row without has no tiers below.
    windows = monthly.withColumn("starts", starts).select(
        *own, "m", "hours", "starts", F.posexplode_outer("starts").alias("i", "start_hour"),
    ).select(
        *own, (F.col("m") + 1).alias("month"), "start_hour",
        (F.coalesce(F.get("starts", F.col("i") + 1), F.size("hours")) - 1).alias("end_hour"),
        F.get("hours", F.col("start_hour")).alias("period"),
    )
    tiers = windows.withColumn("tiers", F.get("structure", F.col("period"))).select(
        "*", F.posexplode("tiers").alias("t", "tier_row")
    )
    return tiers.select(
        F.col("label").alias("schedule_id"), "component_type", "day_type", "month",
        "start_hour", "end_hour", "period", (F.col("t") + 1).alias("tier"),
        F.coalesce(F.get("tiers", F.col("t") - 1)["max"], F.lit(0).cast("decimal(14,4)")).alias("tier_from_kwh"),
        F.col("tier_row.max").alias("tier_to_kwh"), F.col("tier_row.rate").alias("rate"), "unit",
    )


def document_components(flat: DataFrame) -> DataFrame:
    """Flattened documents as components that the charges below can price, by month.

    Documents know weekdays and weekends; a holiday is priced as a weekend day.
    """
    weekend = F.explode(F.when(F.col("day_type") == "WEEKEND", F.array(F.lit("WEEKEND"), F.lit("HOLIDAY"))).otherwise(
        F.array("day_type")
    ))
    place = F.concat_ws("-", "schedule_id", "component_type", "day_type", "month", "start_hour", "tier")
    return flat.select("*", place.alias("component_id"), weekend.alias("component_day")).select(
        "component_id", "schedule_id", "component_type", F.concat(F.lit("PERIOD-"), F.col("period").cast("string")).alias("tou_bucket"),
        "component_day", F.col("month").alias("component_month"), (F.col("start_hour") * 60).alias("start_minute"),
        (F.col("end_hour") * 60 + 59).alias("end_minute"), "tier_from_kwh", "tier_to_kwh", "rate", "unit",
    )


# -- charges --------------------------------------------------------------------------------------


def rated_reads(
    reads: DataFrame, assignments: DataFrame, periods: DataFrame, holidays: Sequence[str] = HOLIDAYS
) -> DataFrame:
    """Billable reads with schedule, billing period, day type and minute, ready for any component.

    ``assignments`` is keyed by meter and versioned; ``periods`` gives meter, id, start and end.
    """
    billable = reads.filter(F.col("vee_status").isin("VALID", "ESTIMATED")).select(
        "meter_id", "read_ts", "kwh_delivered", "kwh_received", "demand_kw"
    )
    scheduled = as_of(billable, assignments.select("meter_id", "schedule_id", "effective_from", "effective_to"),
                      "meter_id").drop("effective_from", "effective_to")
    p = periods.select(F.col("meter_id").alias("period_meter"), "billing_period_id", "start_date", "end_date")
    inside = scheduled.join(
        p,
        (F.col("meter_id") == F.col("period_meter"))
        & F.to_date("read_ts").between(F.col("start_date"), F.col("end_date")),
    ).drop("period_meter", "start_date", "end_date")
    return dated(inside, F.col("read_ts"), holidays).drop("season", "hour_local", "day_of_week")


def _component_join(rated: DataFrame, parts: DataFrame) -> DataFrame:
    """Reads with the components of their schedule, day type and minute.

    Components of all days are spelled out per day type, so schedule and day are plain join keys. Components with a
    ``component_month`` hold in that month only.
    """
    days = F.when(F.col("component_day") == "ALL", F.array(F.lit("WEEKDAY"), F.lit("WEEKEND"), F.lit("HOLIDAY")))
    p = parts.withColumn("component_day", F.explode(F.coalesce(days, F.array("component_day")))).withColumnRenamed(
        "schedule_id", "component_schedule"
    )
    fits = (
        (F.col("component_schedule") == F.col("schedule_id"))
        & (F.col("component_day") == F.col("day_type"))
        & F.col("local_minute").between(F.col("start_minute"), F.col("end_minute"))
    )
    if "component_month" in p.columns:
        fits &= F.col("component_month").isNull() | (F.col("component_month") == F.month("read_ts"))
    return rated.join(p, fits).drop("component_schedule", "component_month")


def _running(rated: DataFrame) -> DataFrame:
    """Reads with the period's kWh before and after each."""
    w = Window.partitionBy("meter_id", "billing_period_id").orderBy("read_ts")
    used = F.coalesce("kwh_delivered", F.lit(0).cast("decimal(14,4)"))
    return rated.withColumn("after", F.sum(used).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "before", F.col("after") - used
    )


def _tier_quantity() -> Column:
    """The part of a read's kWh that lies in its component's tier."""
    top = F.least("after", F.coalesce("tier_to_kwh", F.col("after")))
    return (top - F.greatest("before", F.col("tier_from_kwh"))).cast("decimal(14,4)")


def energy_charges(rated: DataFrame, parts: DataFrame) -> DataFrame:
    """Energy per read and component; a read that crosses a tier border becomes one row per tier."""
    tiered = _component_join(_running(rated), parts.filter("component_type = 'ENERGY'"))
    return tiered.withColumn("quantity", _tier_quantity()).filter("quantity > 0").select(
        "meter_id", "billing_period_id", "read_ts", "schedule_id", "component_id", "component_type",
        "tou_bucket", "tier_from_kwh", "quantity", "rate",
        (F.col("quantity") * F.col("rate")).cast("decimal(14,4)").alias("charge"),
    )


def demand_charges(rated: DataFrame, parts: DataFrame) -> DataFrame:
    """Per meter, period and demand component: the highest kW times rate inside its window."""
    kinds = parts.filter(F.col("component_type").isin("DEMAND", "DEMAND_FACILITY"))
    return _component_join(rated, kinds).groupBy(
        "meter_id", "billing_period_id", "schedule_id", "component_id", "component_type"
    ).agg(
        F.max("demand_kw").alias("peak_kw"),
        F.max(F.col("demand_kw") * F.col("rate")).cast("decimal(14,4)").alias("charge"),
    )


def fixed_charges(rated: DataFrame, parts: DataFrame) -> DataFrame:
    """Monthly amounts spread over the period's reads.

    Each read gets the step of the rounded cumulative amount, so the rows add up to the amount exactly.
    """
    ordered = Window.partitionBy("meter_id", "billing_period_id", "schedule_id").orderBy("read_ts")
    whole = Window.partitionBy("meter_id", "billing_period_id")
    placed = rated.withColumn("i", F.row_number().over(ordered)).withColumn("n", F.count(F.lit(1)).over(whole))
    joined = placed.join(
        parts.filter("component_type = 'FIXED'").select("schedule_id", "component_id", "rate"), "schedule_id"
    )

    def upto(i):
        return (F.col("rate") * i.cast("decimal(10,0)") / F.col("n").cast("decimal(10,0)")).cast("decimal(14,4)")

    return joined.select(
        "meter_id", "billing_period_id", "read_ts", "schedule_id", "component_id",
        F.lit("FIXED").alias("component_type"),
        ratio(F.lit(1), F.col("n")).alias("quantity"), "rate",
        (upto(F.col("i")) - upto(F.col("i") - 1)).cast("decimal(14,4)").alias("charge"),
    )


def export_credits(rated: DataFrame, rates: DataFrame) -> DataFrame:
    """Credit per exporting read at the rate of the schedule's export rule (negative charge)."""
    return rated.filter("kwh_received > 0").join(rates, "schedule_id").select(
        "meter_id", "billing_period_id", "read_ts", "schedule_id", "nem_version",
        F.lit("EXPORT_CREDIT").alias("component_type"),
        F.col("kwh_received").alias("quantity"), F.col("export_rate").alias("rate"),
        (-(F.col("kwh_received") * F.col("export_rate"))).cast("decimal(14,4)").alias("charge"),
    )


def check_riders(riders: list[tuple]) -> None:
    """A rider nobody knows how to price must not be priced as something else."""
    for code, applies, _, unit in riders:
        fits = {"KWH": ("ALL", "DELIVERED", "RECEIVED"), "KW": ("DEMAND",)}.get(unit, ("ALL",))
        if unit not in ("KWH", "KW", "METER_DAY", "PCT") or applies not in fits:
            raise ValueError(f"rider {code}: cannot price {unit} of {applies}")


def rider_charges(rated: DataFrame, energy: DataFrame, riders: list[tuple] = RIDERS) -> DataFrame:
    """Surcharges per meter, period and rider: per kWh, per kW of the period's highest demand, per meter-day or
    percent of energy charges."""
    check_riders(riders)
    keys = ["meter_id", "billing_period_id"]
    usage = rated.groupBy(*keys, F.to_date("read_ts").alias("day")).agg(
        F.sum("kwh_delivered").alias("delivered"), F.sum("kwh_received").alias("received"),
        F.max("demand_kw").alias("peak"),
    ).groupBy(*keys).agg(
        F.sum("delivered").alias("delivered"), F.sum("received").alias("received"), F.max("peak").alias("peak"),
        F.count(F.lit(1)).cast("decimal(10,0)").alias("days"),
    )
    paid = energy.groupBy(*keys).agg(F.sum("charge").alias("energy_charge"))
    zero = F.lit(0).cast("decimal(14,4)")
    listed = F.array(*[
        F.struct(F.lit(code).alias("rider_code"), F.lit(applies).alias("applies_to"),
                 F.lit(rate).cast("decimal(10,5)").alias("rate"), F.lit(unit).alias("unit"))
        for code, applies, rate, unit in riders
    ])
    base = usage.join(paid, keys, "left").select("*", F.explode(listed).alias("r")).select("*", "r.*")
    kwh = (
        F.when(F.col("applies_to") == "RECEIVED", F.coalesce("received", zero))
        .otherwise(F.coalesce("delivered", zero))
    )
    amount = (
        F.when(F.col("unit") == "KWH", kwh.cast("decimal(18,4)"))
        .when(F.col("unit") == "KW", F.coalesce("peak", F.lit(0)).cast("decimal(18,4)"))
        .when(F.col("unit") == "METER_DAY", F.col("days").cast("decimal(18,4)"))
        .otherwise((F.coalesce("energy_charge", zero) / 100).cast("decimal(18,6)"))
    ).cast("decimal(18,6)")
    return base.select(
        *keys, "rider_code", "applies_to", "unit", amount.alias("quantity"), "rate",
        (amount * F.col("rate")).cast("decimal(14,4)").alias("charge"),
    )


def dated_rider_charges(rated: DataFrame, energy: DataFrame, versions: list[tuple] = RIDER_VERSIONS) -> DataFrame:
    """``rider_charges`` by versions with days: a version prices the days of a period on which it is in force.

    Usage and energy charges are added up per meter and day first, so a version sees at most a period's days of a meter. A
    rider that begins, ends or changes its rate inside a period is priced for its days, each rate on its own line.
    """
    check_riders([v[:4] for v in versions])
    keys, day = ["meter_id", "billing_period_id"], F.to_date("read_ts").alias("day")
    usage = rated.groupBy(*keys, day).agg(
        F.sum("kwh_delivered").alias("delivered"), F.sum("kwh_received").alias("received"), F.max("demand_kw").alias("peak"),
    )
    paid = energy.groupBy(*keys, day).agg(F.sum("charge").alias("energy_charge"))
    date = lambda text: F.lit(text).cast("date")
    listed = F.array(*[
        F.struct(F.lit(code).alias("rider_code"), F.lit(applies).alias("applies_to"), F.lit(rate).cast("decimal(10,5)").alias("rate"),
                 F.lit(unit).alias("unit"), date(first).alias("rider_from"), date(end).alias("rider_to"))
        for code, applies, rate, unit, first, end in versions
    ])
    daily = usage.join(paid, [*keys, "day"], "left")
    in_force = F.filter(listed, lambda r: (r["rider_from"] <= F.col("day")) & (r["rider_to"].isNull() | (F.col("day") < r["rider_to"])))
    lines = daily.withColumn("r", F.explode(in_force)).groupBy(*keys, "r").agg(
        *[F.sum(c).alias(c) for c in ("delivered", "received", "energy_charge")], F.max("peak").alias("peak"),
        F.count(F.lit(1)).alias("days"),
    ).select("*", "r.*")
    unit, zero = F.col("unit"), F.lit(0)
    kwh = F.when(F.col("applies_to") == "RECEIVED", F.col("received")).otherwise(F.col("delivered"))
    amount = (
        F.when(unit == "KWH", F.coalesce(kwh, zero).cast("decimal(18,4)"))
        .when(unit == "KW", F.coalesce("peak", zero).cast("decimal(18,4)"))
        .when(unit == "METER_DAY", F.col("days").cast("decimal(18,4)"))
        .otherwise((F.coalesce("energy_charge", zero) / 100).cast("decimal(18,6)"))
    ).cast("decimal(18,6)")
    return lines.select(
        *keys, "rider_code", "applies_to", "unit", "rider_from", "days", amount.alias("quantity"), "rate",
        (amount * F.col("rate")).cast("decimal(14,4)").alias("charge"),
    )


def period_charges(
    energy: DataFrame, demand: DataFrame, fixed: DataFrame, rider: DataFrame, credit: DataFrame
) -> DataFrame:
    """Charges per meter, period and component type. Each part is summed before the union."""
    keys = ["meter_id", "billing_period_id"]
    parts = [
        df.groupBy(*keys, kind.alias("component_type")).agg(F.sum("charge").alias("charge"))
        for df, kind in (
            (energy, F.lit("ENERGY")), (demand, F.col("component_type")), (fixed, F.lit("FIXED")),
            (rider, F.lit("RIDER")), (credit, F.lit("EXPORT_CREDIT")),
        )
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def shadow_bill(rated: DataFrame, parts: DataFrame, alternative: str) -> DataFrame:
    """Energy charges per meter and period now, and if everybody were on ``alternative``.

    Both are priced in one pass: each read meets the components of its own schedule and of the alternative, marked
    by the case they are for. A schedule's components without either case drop out.
    """
    keys = ["meter_id", "billing_period_id"]
    cases = F.array(
        F.struct(F.lit("current").alias("case"), F.col("schedule_id").alias("priced")),
        F.struct(F.lit("shadow").alias("case"), F.lit(alternative).alias("priced")),
    )
    tiered = _component_join(
        _running(rated).withColumn("c", F.explode(cases)).select("*", "c.*").drop("c", "schedule_id").withColumnRenamed(
            "priced", "schedule_id"
        ), parts.filter("component_type = 'ENERGY'"),
    )
    charge = (_tier_quantity() * F.col("rate")).cast("decimal(14,4)")
    paid = lambda case: F.sum(F.when(F.col("case") == case, F.col("charge")))
    zero = F.lit(0).cast("decimal(14,4)")
    delta = F.coalesce("shadow_charge", zero) - F.coalesce("current_charge", zero)
    return tiered.withColumn("quantity", _tier_quantity()).filter("quantity > 0").withColumn("charge", charge).groupBy(
        *keys
    ).agg(paid("current").alias("current_charge"), paid("shadow").alias("shadow_charge")).select(
        *keys, "current_charge", "shadow_charge", delta.alias("delta"),
        pct(delta, F.col("current_charge")).alias("delta_pct"),
    )
