"""Landing, typing and deduplicating reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loadweave.functions import seconds_between
from loadweave.sources.schemas import PAYLOAD_FIELDS


def land(
    df: DataFrame,
    payload: str = "payload_text",
    source_file: Column | None = None,
    ingested_at: Column | None = None,
    schema_version: str = "v1",
) -> DataFrame:
    """Raw landing rows: the payload as VARIANT beside where and when it arrived.

    Text that is no JSON lands too, as a VARIANT string, so that quarantine can show it. The value
    comes out of a generator because filters on extracted fields would otherwise be pushed below the
    parse and repeat it for every field they test.
    """
    own = {"payload_text", "raw_payload", "source_file", "schema_version", "ingested_at", payload}
    text = F.col(payload)
    return df.select(
        F.explode(F.array(F.coalesce(F.try_parse_json(text), text.cast("variant")))).alias("raw_payload"),
        (source_file if source_file is not None else F.col("source_file")).alias("source_file"),
        F.lit(schema_version).alias("schema_version"),
        (ingested_at if ingested_at is not None else F.col("ingested_at")).alias("ingested_at"),
        *[c for c in df.columns if c not in own],
    )


def extract_fields(raw: DataFrame) -> DataFrame:
    """Typed payload fields; a field that cannot be read as its type is null."""
    keep = [c for c in raw.columns if c != "raw_payload"]
    typed = raw.select(
        *keep,
        *[
            F.try_variant_get("raw_payload", f"$.{name}", kind).alias(name)
            for name, kind in PAYLOAD_FIELDS.items()
        ],
    )
    return typed.withColumn("read_ts_text", F.col("read_ts")).withColumn(
        "read_ts", F.col("read_ts").try_cast("timestamp_ntz")
    )


def typed_reads(raw: DataFrame) -> DataFrame:
    """Landed rows with typed fields; rows without meter or time drop out."""
    return extract_fields(raw).filter(F.col("meter_id").isNotNull() & F.col("read_ts").isNotNull())


def normalise(raw: DataFrame, meters: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Landed rows to canonical columns; reads of unknown meters and untypable rows drop out.

    Works on batch and streaming frames. ``extra`` names landing columns to carry along.
    """
    return conform(typed_reads(raw), meters, extra)


def latest_reads(raw: DataFrame, meters: DataFrame, newest: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Canonical reads, the newest copy of each slot.

    Copies go before the meters are joined: a meter that retransmits without end is combined to one row a slot in each
    task, and the join sees one row a slot.
    """
    typed = typed_reads(raw).drop("read_ts_text")
    return conform(last_write_wins(typed, ["meter_id", "read_ts"], newest), meters, extra)


def conform(typed: DataFrame, meters: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Typed reads of known meters in canonical columns."""
    m = meters.select("meter_id", "utility_territory", "timezone")
    return typed.join(m, "meter_id").select(
        "meter_id",
        "read_ts",
        F.convert_timezone(F.lit("UTC"), F.col("timezone"), F.col("read_ts")).alias("read_local_ts"),
        "kwh_delivered", "kwh_received", "demand_kw", "voltage_v", "quality_flag", "vee_status",
        "estimation_method", "utility_territory", "source_file", "ingested_at",
        seconds_between(F.col("read_ts"), F.col("ingested_at")).alias("ingestion_lag_sec"),
        *extra,
    )


def quarantine(raw: DataFrame, meters: DataFrame) -> DataFrame:
    """Landed rows that normalise() leaves out, each with the first reason that applies."""
    known = meters.select("meter_id", F.lit(True).alias("is_known"))
    held = raw.withColumn("payload_text", F.coalesce(
        F.try_variant_get("raw_payload", "$", "string"), F.to_json("raw_payload")))
    typed = extract_fields(held).join(known, "meter_id", "left")
    reason = (
        F.when(F.col("meter_id").isNull(), "MALFORMED")
        .when(F.col("read_ts").isNull(), "BAD_TIMESTAMP")
        .when(F.col("is_known").isNull(), "UNKNOWN_METER")
    )
    return (
        typed.withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select("payload_text", "meter_id", "read_ts_text", "source_file", "ingested_at", "reason")
    )


def precedence() -> Column:
    """The class of a read: an actual measurement outranks an estimate, whenever either arrived."""
    return F.when(F.col("vee_status") == "ESTIMATED", 0).otherwise(1)


def last_write_wins(df: DataFrame, keys: Sequence[str], newest: Sequence[Column | str]) -> DataFrame:
    """Keep, per key, the row that is newest by the given columns, or expressions of them.

    ``max_by`` combines before the shuffle, so one key with any number of copies costs each task a
    single row. Without a watermark this is also valid in a streaming aggregation.
    """
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*newest)).alias("kept")
    )
    return kept.select(*keys, "kept.*").select(*df.columns)


def hashed_key(key: str, salt: str = "") -> Column:
    """A number of 32 bits that depends on the key and the salt alone."""
    digest = F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def sample_by_key(df: DataFrame, key: str, percent: float, salt: str = "") -> DataFrame:
    """Repeatable sample: rows whose hashed key falls into the first ``percent`` of 10,000 buckets.

    The sampling operator itself; reports do not use it to run cheaper.
    """
    return df.filter(hashed_key(key, salt) % 10000 < F.lit(int(round(percent * 100))))


def sample_rows(df: DataFrame, key: str, n: int, strata: Sequence[str] = (), salt: str = "") -> DataFrame:
    """Exactly n rows (all, where there are fewer) of each stratum: those with the smallest hashed keys, then keys.

    The same rows however the input is partitioned, as long as keys are not repeated. Rows are counted by hash bucket, which
    adds up in each task; the counts tell the bucket in which the n-th row lies. Smaller buckets are taken whole, and only the rows
    of that one bucket (a 65,536th of all) are ranked.
    """
    bucket = F.shiftright(hashed_key(key, salt), 16)
    same = [F.coalesce(F.col(s).cast("string"), F.lit("")).alias(f"_s{k}") for k, s in enumerate(strata)]
    # Null and empty text are told apart by a flag beside the text.
    flags = [F.col(s).isNull().alias(f"_n{k}") for k, s in enumerate(strata)]
    names = [f"_s{k}" for k in range(len(strata))] + [f"_n{k}" for k in range(len(strata))]
    rows = df.select("*", *same, *flags, F.lit(0).alias("_all"), bucket.alias("_bucket"))
    group = ["_all", *names]
    counts = rows.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    upto = F.sum("_rows").over(Window.partitionBy(*group).orderBy("_bucket"))
    ends = counts.withColumn("_upto", upto).filter(F.col("_upto") - F.col("_rows") < n).groupBy(*group).agg(
        F.max("_bucket").alias("_last"), F.max_by(F.col("_upto") - F.col("_rows"), "_bucket").alias("_before"),
    )
    near = rows.join(ends, group).filter(F.col("_bucket") <= F.col("_last"))
    order = Window.partitionBy(*group, "_bucket").orderBy(hashed_key(key, salt), key)
    sure = near.filter("_bucket < _last")
    last = near.filter("_bucket = _last").withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") + F.col("_before") <= n)
    return sure.select(*df.columns).unionByName(last.select(*df.columns))
