"""Column types shared by landing, canonical reads and streaming."""

from __future__ import annotations

from pyspark.sql import types as T

ENERGY = T.DecimalType(14, 4)
DEMAND = T.DecimalType(10, 4)
VOLTAGE = T.DecimalType(6, 2)

# Fields of one landed payload and the type each is read as.
PAYLOAD_FIELDS = {
    "meter_id": "string",
    "read_ts": "string",
    "kwh_delivered": "decimal(14,4)",
    "kwh_received": "decimal(14,4)",
    "demand_kw": "decimal(10,4)",
    "voltage_v": "decimal(6,2)",
    "quality_flag": "string",
    "vee_status": "string",
    "estimation_method": "string",
}

LANDED = T.StructType([
    T.StructField("raw_payload", T.VariantType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("schema_version", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ingest_date", T.DateType()),
])

RUN_AUDIT = T.StructType([
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("error_count", T.LongType()),
    T.StructField("message", T.StringType()),
    # What a refresh or stream adds: where its table is, what it did, and the batch with the state it left.
    T.StructField("schema_name", T.StringType()),
    T.StructField("refresh_action", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("state_rows", T.LongType()),
    T.StructField("state_bytes", T.LongType()),
])
