"""Session settings the library relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job needs. Time zone: wall-clock (NTZ) columns are truncated through
# TIMESTAMP, which is only safe in a zone without offset changes.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "loadweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session for standalone use; on a cluster, pass no master and size it from outside."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Call-site tracking of Python columns only serves error messages, and costs most of the planning.
    quiet = {"spark.ui.showConsoleProgress": "false", "spark.python.sql.dataFrameDebugging.enabled": "false"}
    settings = {**RUNTIME, **quiet, **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` if the cluster names one.

    Only a local session without that setting falls back to the machine's temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = os.path.join(tempfile.gettempdir(), f"loadweave-{os.getpid()}")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
