"""Seasonal baseline per series, scoring against it, and what the excess is worth.

A series is a feeder or a meter. The baseline is a table of means and spreads, built by aggregation
alone, so it grows with the number of series and never fits one series in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loadweave.functions import as_decimal, pct
from loadweave.sources.reference import FLAT_RATE_PER_KWH

DAY_TYPES = ["WEEKDAY", "WEEKEND", "HOLIDAY"]


def day_type_of(ts: Column, holidays: list[str]) -> Column:
    date = F.to_date(ts)
    return (
        F.when(date.isin([F.lit(h).cast("date") for h in holidays]), "HOLIDAY")
        .when(F.dayofweek(date).isin(1, 7), "WEEKEND").otherwise("WEEKDAY")
    )


def _spread(n: Column, s: Column, q: Column) -> Column:
    """Sample deviation from exact count, sum and sum of squares."""
    exact = n.cast("decimal(10,0)") * q.cast("decimal(27,8)") - s.cast("decimal(18,4)") * s.cast("decimal(18,4)")
    return F.sqrt(exact.cast("double") / (n * (n - 1)).cast("double"))


def fit_baseline(
    load: DataFrame,
    series: str,
    holidays: list[str],
    min_points: int = 3,
    floor_kwh: float = 0.01,
) -> DataFrame:
    """Forecast and sigma for every series, day type and hour.

    The mean of (day type, hour) is used when it rests on ``min_points`` points, else that of the
    hour, else that of the series. Sigma has a floor, so a constant load can still be scored.
    """
    kwh = as_decimal("kwh", 14, 4)
    fine = (
        load.select(series, day_type_of(F.col("ts"), holidays).alias("day_type"), F.hour("ts").alias("hour"),
                    kwh.alias("kwh"))
        .groupBy(series, "day_type", "hour")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("kwh").alias("s"), F.sum(F.col("kwh") * F.col("kwh")).alias("q"))
    )
    # One row per series holding its cells (72 at most), then every cell of every series with what
    # training saw of it. Hour and series totals are windows over these few rows, already in place
    # after the shuffle by series, so the load itself is read and shuffled once.
    cell = F.concat_ws("|", "day_type", "hour")
    moments = F.struct(
        F.col("n"), F.col("s").cast("decimal(18,4)").alias("s"), F.col("q").cast("decimal(27,8)").alias("q")
    )
    packed = fine.groupBy(series).agg(
        F.map_from_entries(F.collect_list(F.struct(cell.alias("cell"), moments.alias("m")))).alias("cells")
    )
    grid = packed.select(
        series, "cells", F.explode(F.array(*[F.lit(d) for d in DAY_TYPES])).alias("day_type")
    ).select("*", F.explode(F.expr("sequence(0, 23)")).alias("hour"))
    seen = grid.select(series, "day_type", "hour", F.try_element_at("cells", cell).alias("l1"))

    def total(*keys: str) -> Column:
        w = Window.partitionBy(*keys)
        return F.struct(
            F.sum("l1.n").over(w).alias("n"),
            F.sum("l1.s").over(w).cast("decimal(18,4)").alias("s"),
            F.sum("l1.q").over(w).cast("decimal(27,8)").alias("q"),
        )

    cells = seen.withColumn("l2", total(series, "hour")).withColumn("l3", total(series))
    chosen = (
        F.when(F.col("l1.n") >= min_points, F.col("l1"))
        .when(F.col("l2.n") >= min_points, F.col("l2"))
        .otherwise(F.col("l3"))
    )
    source = (
        F.when(F.col("l1.n") >= min_points, "DAY_HOUR").when(F.col("l2.n") >= min_points, "HOUR")
        .otherwise("SERIES")
    )
    b = cells.select(series, "day_type", "hour", source.alias("level"), chosen.alias("b"))
    n, s, q = F.col("b.n"), F.col("b.s"), F.col("b.q")
    return b.select(
        series, "day_type", "hour", "level", n.alias("points"),
        F.round(s.cast("double") / n, 6).alias("forecast"),
        F.greatest(
            F.coalesce(F.round(F.when(n > 1, _spread(n, s, q)), 6), F.lit(floor_kwh)), F.lit(floor_kwh)
        ).alias("sigma"),
    )


def detect(load: DataFrame, baseline: DataFrame, series: str, holidays: list[str], k: float = 3.0) -> DataFrame:
    """Score a load against its baseline; distance is signed and in sigmas."""
    kwh = as_decimal("kwh", 14, 4)
    keyed = load.select(
        series, "ts", kwh.alias("kwh"),
        day_type_of(F.col("ts"), holidays).alias("day_type"), F.hour("ts").alias("hour"),
    )
    forecast, sigma, y = F.col("forecast"), F.col("sigma"), F.col("kwh").cast("double")
    lower, upper = F.round(forecast - k * sigma, 6), F.round(forecast + k * sigma, 6)
    return keyed.join(
        baseline.select(series, "day_type", "hour", "forecast", "sigma"), [series, "day_type", "hour"]
    ).select(
        series, "ts", "kwh", "forecast", lower.alias("lower_bound"), upper.alias("upper_bound"),
        ((y < lower) | (y > upper)).alias("is_anomaly"),
        F.round((y - forecast) / sigma, 6).alias("distance"),
    )


def excess_kwh(events: DataFrame) -> Column:
    """Energy above forecast; unknown when either side is unknown."""
    diff = F.col("kwh").cast("decimal(18,6)") - F.col("forecast").cast("decimal(18,6)")
    return F.when(diff.isNotNull(), F.greatest(diff, F.lit(0).cast("decimal(18,6)")))


def transformer_attribution(
    events: DataFrame, days: DataFrame, placed: DataFrame, transformers: DataFrame,
    rate_per_kwh=FLAT_RATE_PER_KWH,
) -> DataFrame:
    """Share each feeder's excess among its transformers by their part of the feeder's load."""
    per_meter = days.groupBy("meter_id").agg(F.sum("kwh_delivered").alias("kwh"))
    shares = (
        per_meter.join(placed.select("meter_id", "service_point_id", "transformer_id"), "meter_id")
        .join(transformers, "transformer_id")
        .groupBy("transformer_id", "feeder_id", "kva_rating")
        .agg(F.countDistinct("service_point_id").alias("meters"), F.sum("kwh").alias("kwh"))
    )
    # The window holds one row per transformer of a feeder.
    of_feeder = F.sum("kwh").over(Window.partitionBy("feeder_id"))
    flagged = events.filter("is_anomaly").groupBy("feeder_id").agg(
        F.count(F.lit(1)).alias("feeder_anomaly_hours"),
        F.sum(excess_kwh(events)).alias("excess"),
        F.max("distance").alias("max_distance"),
    )
    share = F.col("kwh").cast("double") / F.nullif(F.col("feeder_kwh").cast("double"), F.lit(0.0))
    excess = F.col("excess").cast("double")
    return shares.withColumn("feeder_kwh", of_feeder).join(flagged, "feeder_id").select(
        "transformer_id", "feeder_id", F.col("kva_rating").alias("kva"), "meters", "feeder_anomaly_hours",
        F.round(share * 100, 4).alias("share_pct"),
        F.round(share * excess, 4).alias("est_excess_kwh"),
        F.round(share * excess * F.lit(float(rate_per_kwh)), 4).alias("est_dollar_exposure"),
        F.round("max_distance", 3).alias("max_distance"),
    )


def exposure(events: DataFrame, series: str, rate_per_kwh=FLAT_RATE_PER_KWH) -> DataFrame:
    """Flagged hours with the price of their excess."""
    return events.filter("is_anomaly").select(
        series, "ts", "kwh", "forecast", "distance",
        (excess_kwh(events) * F.lit(rate_per_kwh)).cast("decimal(18,4)").alias("exposure"),
    )


def model_card(events: DataFrame, training: DataFrame, series: str, name: str, target: str = "KWH") -> DataFrame:
    """What was trained and what it found, one row."""
    n, hit = F.count(F.lit(1)), F.count_if(F.col("is_anomaly"))
    scored = events.agg(
        n.alias("scored"), hit.alias("anomalies_found"), pct(hit, n).alias("pct_flagged"),
        (F.sum(F.col("distance").cast("decimal(18,6)")) / F.nullif(n, F.lit(0))).cast("decimal(18,3)").alias("avg_distance"),
        F.round(F.max("distance"), 3).alias("max_distance"),
    )
    per_series = training.groupBy(series).agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    trained = per_series.agg(
        F.count(F.lit(1)).alias("n_series"), F.sum("rows").alias("training_rows"),
        F.datediff(F.max("last_ts"), F.min("first_ts")).alias("training_window_days"),
        F.to_date(F.max("last_ts")).alias("last_trained"),
    )
    one = F.lit(1).alias("one")
    return scored.select("*", one).join(trained.select("*", one), "one").select(
        F.lit(name).alias("name"), F.lit(target).alias("target"), F.lit(series.upper()).alias("series_col"),
        "training_window_days", "training_rows", "n_series", "last_trained",
        "scored", "anomalies_found", "pct_flagged", "avg_distance", "max_distance",
    )


def evaluate(events: DataFrame, labels: DataFrame, series: str) -> DataFrame:
    """Recall, precision and mean hours to detection of scored events against labelled intervals.

    Labels carry ``label_id, <series>, start_ts, end_ts``. Both sides are keyed by series and day, so a
    label only ever meets the events of the days it covers.
    """
    days = F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts"), F.expr("interval 1 day")))
    spread = labels.select("label_id", series, "start_ts", "end_ts", days.alias("day"))
    flagged = events.filter("is_anomaly").select(series, "ts", F.to_date("ts").alias("day"))
    hits = flagged.join(spread, [series, "day"]).filter(F.col("ts").between(F.col("start_ts"), F.col("end_ts")))
    found = hits.groupBy("label_id").agg(F.min(F.timestamp_diff("HOUR", "start_ts", "ts")).alias("hours"))
    true_hits = hits.select(series, "ts").distinct().agg(F.count(F.lit(1)).alias("true_positives"))
    total = labels.agg(F.count(F.lit(1)).alias("labels"))
    detected = found.agg(F.count(F.lit(1)).alias("detected"), F.sum("hours").alias("hours"))
    fired = events.agg(F.count_if(F.col("is_anomaly")).alias("flagged"))
    one = F.lit(1).alias("one")
    row = total.select("*", one)
    for part in (detected, fired, true_hits):
        row = row.join(part.select("*", one), "one")
    return row.select(
        "labels", "detected", "flagged", "true_positives",
        pct(F.col("detected"), F.col("labels")).alias("recall_pct"),
        pct(F.col("true_positives"), F.col("flagged")).alias("precision_pct"),
        F.round(F.col("hours").cast("double") / F.nullif(F.col("detected"), F.lit(0)), 6).alias("mean_hours_to_detect"),
    )
