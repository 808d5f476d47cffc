"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.session import shared_folder
from loadweave.sources.tables import drop

#: One run of ASCII white space, and one word, as the operators count them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the given folder, only the named columns, so that the scan reads nothing else."""
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def whole(text: Column | str) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lowered(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column | str) -> Column:
    """Array of the words of a text; empty for a text without words."""
    trimmed = F.regexp_replace(whole(text), rf"^{SPACE}|{SPACE}$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def host_of(url: Column) -> Column:
    """The URL's host in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the one that driver and executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def kept_at(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame once and go on from the files, so that a lost executor costs no earlier step."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, path: str, *names: str) -> None:
    """Delete intermediates that no frame reads any more: the named folders below a path, or all of it."""
    for folder in [f"{path}/{n}" for n in names] or [path]:
        drop(spark, folder)


def file_system(uri: str):
    """The pyarrow file system and path of a folder that driver and executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("/") else fs.FileSystem.from_uri(
        uri.replace(":/", ":///", 1)
    )


@contextmanager
def publish(uri: str, name: str):
    """An open output stream, moved to its final name once everything is written.

    An attempt that dies leaves nothing under the final name, and a repeated one puts the same bytes there.
    """
    system, root = file_system(uri)
    system.create_dir(root, recursive=True)
    attempt = f"{root}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(attempt) as out:
        yield out
    system.move(attempt, f"{root}/{name}")


def fetch(uri: str, name: str):
    """An input file of a shared folder, open for random reads."""
    system, root = file_system(uri)
    return system.open_input_file(f"{root}/{name}")
