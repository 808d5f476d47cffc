"""Operational edge cases: gaps, late reads, duplicates, estimates, wrong premise types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loadweave.functions import mean
from loadweave.operators.calendar import load_factors, load_scale, scaled_load
from loadweave.sources.reference import DUPLICATE_RESOLUTION, HOLIDAYS

#: Where the library's own estimates say they come from.
GAP_FILL = "GAP_FILL"


def partial_meters(reads: DataFrame, meters: DataFrame, last_ts: Column, expected: int = 96) -> DataFrame:
    """Meters with fewer delivered-energy reads than expected in the closed day before ``last_ts``.

    Every wide read has exactly one delivered-energy channel row, so no unpivot is needed to count.
    """
    recent = reads.filter(F.col("read_ts") >= last_ts - F.expr("interval 1 day"))
    counted = recent.groupBy("meter_id").agg(F.count(F.lit(1)).alias("intervals_24h"))
    return (
        counted.filter(F.col("intervals_24h") < expected)
        .join(meters.select("meter_id", "utility_territory", "meter_type"), "meter_id")
        .select(
            "meter_id", "utility_territory", "meter_type", "intervals_24h",
            (F.lit(expected) - F.col("intervals_24h")).alias("missing_24h"),
        )
    )


def lag_histogram(reads: DataFrame) -> DataFrame:
    lag = F.col("ingestion_lag_sec")
    bucket = (
        F.when(lag < 4 * 3600, "0-4h").when(lag < 24 * 3600, "4-24h").when(lag < 28 * 3600, "24-28h")
        .otherwise(">28h")
    )
    n = F.sum("n_channels") if "n_channels" in reads.columns else F.count(F.lit(1))
    return reads.filter(lag.isNotNull()).groupBy(bucket.alias("bucket")).agg(n.alias("n"))


def repeated_slots(raw: DataFrame, keys: list[str]) -> DataFrame:
    """Slots that were transmitted more than once: copies, and the first and the kept one.

    ``raw`` has kwh_delivered, ingested_at and event_id besides the keys. First and last copy come from combinable
    aggregates over raw rows, before anything is joined, so a meter that retransmits without end is one row a slot
    and task.
    """
    order = F.struct("ingested_at", "event_id")
    copy = F.struct(F.col("kwh_delivered").alias("value"), F.col("ingested_at").alias("received"))
    return raw.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.min_by(copy, order).alias("first"), F.max_by(copy, order).alias("kept"),
    ).filter("copies > 1")


def duplicate_audit(slots: DataFrame) -> DataFrame:
    """The audit of ``repeated_slots`` whose meters are known by id and territory."""
    return (
        slots
        .select(
            F.concat_ws("|", "meter_id", F.date_format("read_ts", "yyyy-MM-dd HH:mm")).alias("duplicate_id"),
            "meter_id", "utility_territory", "read_ts", "copies",
            F.col("first.value").alias("value_first"), F.col("kept.value").alias("value_second"),
            F.col("first.received").alias("received_first"), F.col("kept.received").alias("received_second"),
            F.timestamp_diff("MINUTE", F.date_trunc("minute", "first.received"),
                             F.date_trunc("minute", "kept.received")).alias("gap_min"),
            F.lit(DUPLICATE_RESOLUTION).alias("resolution"),
            F.lit("KWH_DEL").alias("channel_code"),
        )
    )


def load_shape(reads: DataFrame, meters: DataFrame, since: Column) -> DataFrame:
    """Mean kWh per read in the evening, by day, at night and overall, by UTC hour."""
    hour, value = F.hour("read_ts"), F.col("kwh_delivered")

    def between(first: int, last: int) -> Column:
        return mean(F.when(hour.between(first, last), value), 6)

    shape = reads.filter(F.col("read_ts") >= since).groupBy("meter_id").agg(
        between(17, 21).alias("eve"), between(9, 16).alias("day"), between(0, 5).alias("night"),
        mean(value, 6).alias("overall"),
    )
    return shape.join(meters.select("meter_id", "meter_type"), "meter_id")


def classify_shape(shape: DataFrame) -> DataFrame:
    """Premise type the load shape suggests, and how far evening and day lie apart."""
    eve, day, overall = (F.col(c).cast("double") for c in ("eve", "day", "overall"))
    day_over_eve = day / F.nullif(eve, F.lit(0.0))
    eve_over_day = eve / F.nullif(day, F.lit(0.0))
    suggested = (
        F.when((day_over_eve > 1.15) & (overall >= 0.8), "CNI")
        .when((day_over_eve > 1.05) & (overall < 0.8), "SMB")
        .when(eve_over_day > 1.10, "RES")
        .otherwise(F.col("meter_type"))
    )
    complete = F.col("eve").isNotNull() & F.col("day").isNotNull() & F.col("night").isNotNull()
    return shape.filter(complete).withColumn("suggested_type", suggested).withColumn(
        "separation", F.round(F.abs(eve - day) / F.nullif(F.greatest(eve, day), F.lit(0.0)), 6)
    )


def premise_mismatch(shape: DataFrame) -> DataFrame:
    """Every mistyped meter, with how clearly (``separation``); callers rank or cut."""
    wrong = classify_shape(shape).filter(F.col("meter_type") != F.col("suggested_type"))
    three = lambda c: F.round(F.col(c), 3)
    return wrong.select(
        "meter_id", F.col("meter_type").alias("current_type"), "suggested_type",
        three("eve").alias("avg_eve_kwh"), three("day").alias("avg_day_kwh"),
        three("night").alias("avg_night_kwh"), three("overall").alias("avg_overall"),
        F.round("separation", 3).alias("confidence"), "separation",
    )


def estimation_streaks(reads: DataFrame, longer_than: int = 3) -> DataFrame:
    """Runs of consecutive days with estimated reads per meter.

    The window sees one row per meter and day, never the reads themselves.
    """
    days = (
        reads.filter(F.col("vee_status") == "ESTIMATED")
        .groupBy("meter_id", F.to_date("read_ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("estimated"))
    )
    w = Window.partitionBy("meter_id").orderBy("day")
    island = F.date_sub("day", F.row_number().over(w))
    return days.withColumn("island", island).groupBy("meter_id", "island").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.count(F.lit(1)).alias("days"), F.sum("estimated").alias("estimated_intervals"),
    ).select(
        "meter_id", "first_day", "last_day", "days", "estimated_intervals",
        (F.col("days") > longer_than).alias("is_sustained"),
    )


def gap_fill(
    reads: DataFrame, meters: DataFrame, first: str, last: str, minutes: int = 15, holidays: Sequence[str] = HOLIDAYS
) -> DataFrame:
    """Estimated reads for every slot a meter did not report between two dates.

    Missing slots come from one row per meter and day holding the slots it did report (96 at most),
    so nothing of the size meters x slots is built before the gaps are known. What a slot alone contributes is worked
    out once per slot of the range. Meters that are there once give one read a slot.
    """
    per_day = 24 * 60 // minutes
    number = (F.hour("read_ts") * 60 + F.minute("read_ts")) / minutes
    seen = reads.groupBy("meter_id", F.to_date("read_ts").alias("day")).agg(
        F.collect_set(F.floor(number).cast("int")).alias("reported")
    )
    days = F.expr(f"sequence(date'{first}', date'{last}', interval 1 day)")
    about = ["meter_id", "meter_type", "has_der", "utility_territory", "timezone", "base_kwh", "level_kwh"]
    wanted = load_scale(meters).select(*about, F.explode(days).alias("day"))
    slots = F.expr(f"sequence(0, {per_day - 1})")
    missing = F.array_except(slots, F.coalesce("reported", F.expr("cast(array() as array<int>)")))
    # Each of these small rows unfolds into up to 96; the fixed number of partitions keeps adaptive
    # execution from merging them by their size before that.
    width = int(reads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gaps = (
        wanted.join(seen, ["meter_id", "day"], "left")
        .repartition(width, "meter_id", "day")
        .select(*about, "day", F.explode(missing).alias("slot"))
    )
    each = reads.sparkSession.range(1).select(F.explode(days).alias("day")).select("day", F.explode(slots).alias("slot"))
    timed = each.withColumn("read_ts", F.col("day").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("slot") * minutes))
    return scaled_load(gaps.join(F.broadcast(load_factors(timed, holidays)), ["day", "slot"])).select(
        "meter_id", "read_ts",
        F.convert_timezone(F.lit("UTC"), F.col("timezone"), F.col("read_ts")).alias("read_local_ts"),
        F.col("expected_kwh").alias("kwh_delivered"),
        F.col("expected_kwh_received").alias("kwh_received"),
        F.col("expected_kw").alias("demand_kw"),
        F.lit("E").alias("quality_flag"), F.lit("ESTIMATED").alias("vee_status"),
        F.lit("LOAD_PROFILE").alias("estimation_method"), "utility_territory",
    )
