"""Wide reads to channel rows and back, and the rollups whose rule is data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loadweave.functions import day_floor, hour_floor, mean, pct

# Channels that a wide read holds: their column and unit.
MEASURES = {
    "KWH_DEL": ("kwh_delivered", "KWH"), "KW_DEM": ("demand_kw", "KW"), "VOLT_AVG": ("voltage_v", "V"),
    "KWH_REC": ("kwh_received", "KWH"),
}
# Columns every channel row copies from its read.
CARRIED = [
    "quality_flag", "vee_status", "estimation_method", "event_id", "utility_territory",
    "source_file", "ingested_at", "ingestion_lag_sec",
]


def instantiate_channels(meters: DataFrame, catalog: DataFrame) -> DataFrame:
    """Channels each meter emits: three for all, received energy only behind generation.

    Each meter lists its codes and looks them up, which needs no product of meters and catalogue.
    """
    codes = F.array(F.lit("KWH_DEL"), F.lit("KW_DEM"), F.lit("VOLT_AVG"))
    emitted = F.when(F.col("has_der"), F.array_append(codes, F.lit("KWH_REC"))).otherwise(codes)
    listed = meters.select("meter_id", "install_date", F.explode(emitted).alias("channel_code"))
    return listed.join(catalog.filter("is_active"), "channel_code").select(
        F.concat_ws("-", "meter_id", "channel_code").alias("channel_id"),
        "meter_id", "channel_code", "channel_number", "uom", "direction", "aggregation",
        F.lit(15).alias("interval_min"),
        F.lit(1).cast("decimal(10,4)").alias("scale_factor"),
        F.lit("ACTIVE").alias("status"),
        F.col("install_date").alias("effective_from"),
    )


def unpivot(reads: DataFrame, meters: DataFrame) -> DataFrame:
    """One row per read and channel; zero or missing received energy only where it is measured."""
    generating = meters.filter("has_der").select("meter_id", F.lit(True).alias("emits_received"))
    listed = [f"'{code}', cast({name} as decimal(14,4)), '{uom}'" for code, (name, uom) in MEASURES.items()]
    stacked = F.expr(f"stack({len(listed)}, {', '.join(listed)})")
    rows = reads.join(generating, "meter_id", "left").select(
        "meter_id", "read_ts", *CARRIED, "emits_received",
        stacked.alias("channel_code", "value", "uom"),
    )
    empty_export = (
        (F.col("channel_code") == "KWH_REC")
        & (F.coalesce("value", F.lit(0)) == 0)
        & F.col("emits_received").isNull()
    )
    return rows.filter(~empty_export).select(
        "meter_id", F.concat_ws("-", "meter_id", "channel_code").alias("channel_id"),
        "channel_code", "read_ts", "value", "uom", *CARRIED,
    )


def channel_rows(reads: DataFrame, meters: DataFrame) -> DataFrame:
    """Reads with ``n_channels``, the number of rows that ``unpivot`` makes of each; to count without unfolding."""
    generating = meters.filter("has_der").select("meter_id", F.lit(True).alias("emits_received"))
    received = (F.coalesce("kwh_received", F.lit(0)) != 0) | F.col("emits_received").isNotNull()
    return reads.join(generating, "meter_id", "left").withColumn(
        "n_channels", F.lit(3) + received.cast("int")
    ).drop("emits_received")


def pivot_wide(channel_reads: DataFrame) -> DataFrame:
    """Back to one row per meter and slot; carried columns agree across channels, min picks them."""

    def measure(code: str, kind: str, name: str):
        return F.max(F.when(F.col("channel_code") == code, F.col("value"))).cast(kind).alias(name)

    return channel_reads.groupBy("meter_id", "read_ts").agg(
        measure("KWH_DEL", "decimal(14,4)", "kwh_delivered"),
        measure("KWH_REC", "decimal(14,4)", "kwh_received"),
        measure("KW_DEM", "decimal(10,4)", "demand_kw"),
        measure("VOLT_AVG", "decimal(6,2)", "voltage_v"),
        *[F.min(c).alias(c) for c in CARRIED],
    )


def channel_hourly(channel_reads: DataFrame, meter_channels: DataFrame, expected: int = 4) -> DataFrame:
    """Hourly values per channel, aggregated by the rule the meter's channel declares.

    All four aggregates are taken before the rule is looked up, so the join sees hours, not reads.
    """
    rules = meter_channels.select("meter_id", "channel_code", "aggregation")
    hours = (
        channel_reads.withColumn("rollup_ts", hour_floor("read_ts"))
        .groupBy("meter_id", "channel_code", "uom", "rollup_ts", "utility_territory")
        .agg(
            F.sum("value").alias("total"),
            F.max("value").alias("highest"),
            F.min("value").alias("lowest"),
            mean("value", 4).alias("average"),
            F.count(F.lit(1)).alias("source_interval_count"),
            F.count_if(F.col("vee_status") == "VALID").alias("valid_count"),
        )
    )
    return hours.join(rules, ["meter_id", "channel_code"]).select(*_by_rule(expected))


def _by_rule(expected: int) -> list[Column | str]:
    """Columns of a channel's hour: of its four aggregates, the one that its rule names."""
    by_rule = {"SUM": "total", "MAX": "highest", "MIN": "lowest", "AVG": "average"}
    rule = F.col("aggregation")
    picked = F.coalesce(*[F.when(rule == r, F.col(c)) for r, c in by_rule.items()])
    return [
        "meter_id", "channel_code", "uom", "rollup_ts", "utility_territory",
        *[
            F.when(rule == r, F.col(c)).cast("decimal(16,4)").alias(f"value_{r.lower()}")
            for r, c in by_rule.items()
        ],
        picked.cast("decimal(16,4)").alias("canonical_value"),
        "source_interval_count",
        F.lit(expected).alias("expected_interval_count"),
        pct(F.col("source_interval_count"), F.lit(expected)).alias("completeness_pct"),
        pct(F.col("valid_count"), F.col("source_interval_count")).alias("vee_pass_pct"),
    ]


def with_rules(reads: DataFrame, meters: DataFrame, meter_channels: DataFrame) -> DataFrame:
    """Reads of meters with channels, narrowed to what ``channel_hours`` needs, with their meter's ``rules`` (channel and
    aggregation) and ``generating``, how often the meter is listed as one that has generation (null: not)."""
    rules = meter_channels.groupBy("meter_id").agg(
        F.sort_array(F.collect_list(F.struct("channel_code", "aggregation"))).alias("rules")
    )
    listed = meters.filter("has_der").groupBy("meter_id").agg(F.count(F.lit(1)).alias("generating"))
    narrow = reads.select(
        "meter_id", "read_ts", "utility_territory", "vee_status",
        *[F.col(name).cast("decimal(14,4)").alias(name) for name, _ in MEASURES.values()],
    )
    return narrow.join(rules.join(listed, "meter_id", "left"), "meter_id")


def channel_hours(ruled: DataFrame, expected: int = 4, beside: Sequence[str] = ()) -> DataFrame:
    """What ``channel_hourly`` makes of unfolded reads, from wide reads (see ``with_rules``), with the columns ``beside``.

    The measures of a meter's hour are aggregated side by side, in one row instead of one for each channel, and the hours are
    unfolded by the meter's rules. Received energy of a meter without generation counts where it is not zero, as in
    ``unpivot``; ``beside`` names columns that meter and hour determine.
    """
    valid, sent = F.col("vee_status") == "VALID", F.coalesce("kwh_received", F.lit(0)) != 0
    stats = []
    for name, _ in MEASURES.values():
        x = F.col(name)
        stats += [F.sum(x).alias(f"s_{name}"), F.max(x).alias(f"h_{name}"), F.min(x).alias(f"l_{name}"), F.count(x).alias(f"c_{name}")]
    exported = F.when(sent, F.col("kwh_received"))
    keys = ["meter_id", "rollup_ts", "utility_territory", *beside]
    hours = ruled.withColumn("rollup_ts", hour_floor("read_ts")).groupBy(*keys, "rules", "generating").agg(
        *stats, F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("n_valid"),
        F.max(exported).alias("h_exported"), F.min(exported).alias("l_exported"),
        F.count_if(sent).alias("n_exported"), F.count_if(sent & valid).alias("n_exported_valid"),
    )
    code, own = F.col("rule.channel_code"), F.col("rule.channel_code") != "KWH_REC"
    whole = own | F.col("generating").isNotNull()
    # A meter that is listed twice has each of its reads twice.
    times = F.coalesce("generating", F.lit(1))

    def of(prefix: str) -> Column:
        return F.coalesce(*[F.when(code == c, F.col(f"{prefix}_{name}")) for c, (name, _) in MEASURES.items()])

    def either(prefix: str) -> Column:
        return F.when(whole, of(prefix)).otherwise(F.col(f"{prefix}_exported"))

    total, values = of("s"), F.when(whole, of("c")).otherwise(F.col("n_exported"))
    rows, passed = (F.when(whole, F.col(c)).otherwise(F.col(e)) for c, e in (("n", "n_exported"), ("n_valid", "n_exported_valid")))
    return hours.withColumn("rule", F.explode("rules")).filter(code.isin(*MEASURES)).select(
        *keys, code.alias("channel_code"), F.col("rule.aggregation").alias("aggregation"),
        F.coalesce(*[F.when(code == c, F.lit(uom)) for c, (_, uom) in MEASURES.items()]).alias("uom"),
        (total * times.cast("decimal(10,0)")).alias("total"), either("h").alias("highest"), either("l").alias("lowest"),
        (total / F.nullif(values, F.lit(0))).cast("decimal(18,4)").alias("average"),
        (rows * times).alias("source_interval_count"), (passed * times).alias("valid_count"),
    ).filter("source_interval_count > 0").select(*_by_rule(expected), *beside)


def channel_daily(hourly: DataFrame, expected: int = 96) -> DataFrame:
    count = F.sum("source_interval_count")
    return (
        hourly.withColumn("rollup_date", day_floor("rollup_ts"))
        .groupBy("meter_id", "channel_code", "uom", "rollup_date", "utility_territory")
        .agg(
            F.sum("value_sum").cast("decimal(18,4)").alias("value_sum"),
            F.max("value_max").cast("decimal(18,4)").alias("value_max"),
            F.min("value_min").cast("decimal(18,4)").alias("value_min"),
            mean("value_avg", 4).alias("value_avg"),
            count.alias("source_interval_count"),
            F.lit(expected).alias("expected_interval_count"),
            pct(count, F.lit(expected)).alias("completeness_pct"),
            mean("vee_pass_pct", 2).alias("vee_pass_pct"),
        )
    )
