"""Continuous ingest: land, normalise, merge, aggregate.

Every query is a Structured Streaming query with a checkpoint. ``drain`` runs one with what is there
and stops; a deployment passes its trigger, and gets the running query back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from loadweave.operators.edge import GAP_FILL
from loadweave.operators.ingest import land, last_write_wins, normalise
from loadweave.operators.quality import RunLog
from loadweave.sources import tables
from loadweave.sources.schemas import LANDED

READ_KEYS = ["meter_id", "read_ts"]
NEWEST = ["ingested_at", "event_id"]


#: Files of one batch, whatever the table's size.
FILES_PER_BATCH = 32


def drain(writer: DataStreamWriter, trigger: dict | None = None) -> StreamingQuery:
    """Process everything available in as many batches as the source's limits ask for, then stop.

    With a ``trigger`` (such as ``{"processingTime": "1 minute"}``, see ``refresh.TARGET_LAG_MIN``) the query goes on;
    the caller stops it.
    """
    if trigger is not None:
        return writer.trigger(**trigger).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, so that it is bounded by disk and not by executor memory."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def land_bronze(payloads: DataFrame, path: str) -> None:
    """Append payloads to the bronze table as VARIANT, one directory per ingestion day."""
    rows = land(payloads).withColumn("ingest_date", F.to_date("ingested_at"))
    tables.write_partitioned(rows, path, "ingest_date")


def bronze_stream(spark: SparkSession, path: str, files_per_batch: int | None = FILES_PER_BATCH) -> DataFrame:
    """Landed rows as a stream; without a number of files, all that is there is one batch."""
    reader = spark.readStream.schema(LANDED)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def text_stream(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """JSON lines dropped into a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path).select(
        F.col("value").alias("payload_text"),
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("source_file"),
        F.lit("v1").alias("schema_version"),
        F.localtimestamp().alias("ingested_at"),
    )


def append_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Exactly-once append of a stream to a Parquet table."""
    return drain(stream.writeStream.format("parquet").outputMode("append")
                 .option("path", path).option("checkpointLocation", checkpoint), trigger)


def normalised_stream(raw: DataFrame, meters: DataFrame) -> DataFrame:
    """Typed reads of a stream of landed rows, with their partition day."""
    return normalise(raw, meters, extra=["event_id"]).withColumn("read_date", F.to_date("read_ts"))


def merge_stream(
    reads: DataFrame, path: str, work: str, after_batch: Callable[[list], None] | None = None,
    trigger: dict | None = None, newest: Sequence[Column | str] = NEWEST, name: str | None = None,
    log: RunLog | None = None, on_changes: Callable[[DataFrame, str], None] | None = None,
) -> StreamingQuery:
    """Merge a stream of reads into the canonical table, one touched-day rewrite per batch.

    No streaming state at all, so lateness is unbounded. Staging is named after the query's own id,
    which lives in its checkpoint: a restarted batch finds its copy, a new query never meets an old one.

    ``newest`` orders the rows of a slot (see ``ingest.precedence``). ``after_batch`` gets the days of each batch,
    ``on_changes`` what the merge changed and the batch's own staging folder. With ``log``, each merge is a run in it, with the rows, failed
    reads and newest arrival of the batch, as observed while it was staged.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        staging = f"{work}/staging/{query_id}/{batch_id}"
        days: list = []

        def job() -> dict:
            seen = None if tables.exists(spark, f"{staging}/incoming/_SUCCESS") else Observation()
            rows = batch if seen is None else batch.observe(
                seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("vee_status") == "FAILED").alias("failed"),
                F.max("ingested_at").cast("string").alias("newest"),
            )
            days.extend(tables.upsert(rows, path, staging, READ_KEYS, newest, by="read_date"))
            got = seen.get if seen is not None else {}  # a batch that is repeated from its staging copy is not read again
            told = f"newest arrival {got['newest']}" if got.get("newest") else None
            return {"rows_processed": got.get("rows"), "error_count": got.get("failed"), "message": told, "batch_id": batch_id}

        log.run("MERGE_CANONICAL", job, "MERGE") if log else job()
        if after_batch is not None and days:
            after_batch(days)
        changed = tables.changes_of(spark, staging, "read_date")
        if on_changes is not None and changed is not None:
            on_changes(changed, staging)
        # This batch only began after the one before it was committed; its staging copy is done with.
        tables.drop(spark, f"{work}/staging/{query_id}/{batch_id - 1}")

    writer = reads.writeStream.foreachBatch(merge).option("checkpointLocation", f"{work}/checkpoint")
    return drain(writer.queryName(name) if name else writer, trigger)


def store_estimates(
    path: str, estimates: DataFrame, made_at: Column, work: str, newest: Sequence[Column | str],
    on_changes: Callable[[DataFrame, str], None] | None = None, unique: bool = False,
    span: int = 0,
) -> list:
    """Merge estimated reads (see ``edge.gap_fill``) into the canonical table; returns their days.

    Ordered by ``ingest.precedence`` first, they fill gaps and replace older estimates, never an actual read. ``unique``
    estimates are one a slot, as those of meters that are there once; ``span`` is their number of days, if that is known.
    """
    spark = estimates.sparkSession
    known = {c.name: c for c in spark.read.parquet(path).schema}
    own = {
        "ingested_at": made_at, "source_file": F.lit(GAP_FILL), "event_id": F.lit(0), "read_date": F.to_date("read_ts"),
    }
    rows = estimates.select(*[
        own.get(n, F.col(n) if n in estimates.columns else F.lit(None)).cast(f.dataType).alias(n) for n, f in known.items()
    ])
    days = tables.upsert(rows, path, work, READ_KEYS, newest, by="read_date", unique=unique, days=span)
    changed = tables.changes_of(spark, work, "read_date")
    if on_changes is not None and changed is not None:
        on_changes(changed, work)
    tables.drop(spark, work)
    return days


def changelog(aggregated: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write each batch's changed groups of a streaming aggregation, tagged with the batch number.

    A batch replaces only its own directory, so a repeated batch leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.replace_partitions(batch.withColumn("batch", F.lit(batch_id)), path, "batch")

    keep_state_on_disk(aggregated.sparkSession)
    return drain(aggregated.writeStream.outputMode("update").foreachBatch(write)
                 .option("checkpointLocation", checkpoint), trigger)


def current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Latest state per group of a changelog."""
    log = spark.read.parquet(path)
    return last_write_wins(log, keys=keys, newest=["batch"]).drop("batch")


def stateful_lww(reads: DataFrame, watermark: str | None = None) -> DataFrame:
    """Newest read per key as a streaming aggregation.

    With a watermark, state of old keys is dropped and later rewrites of them are ignored; without one
    nothing is ever too late and state grows with the keys.
    """
    bounded = reads.withWatermark("read_ts", watermark) if watermark else reads
    return last_write_wins(bounded, keys=READ_KEYS, newest=NEWEST)


def windowed_load(reads: DataFrame, watermark: str | None = None) -> DataFrame:
    """Reads and kWh per meter and tumbling hour of event time, as transmitted."""
    timed = reads.withWatermark("read_ts", watermark) if watermark else reads
    return timed.groupBy("meter_id", "utility_territory", F.window("read_ts", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("reads"), F.sum("kwh_delivered").alias("kwh")
    ).select("meter_id", "utility_territory", F.col("w.start").alias("hour"), "reads", "kwh")
