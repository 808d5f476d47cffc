"""Partitioned Parquet tables: snapshots, partition replacement, crash-safe upserts, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from loadweave.operators.ingest import last_write_wins


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def data_files(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getFileCount() if fs.exists(p) else 0


def drop(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


#: Which part of a day's keys a row belongs to (see ``deal``).
SHARE = "_share"
#: Stored bytes of a day that make one share: at most, and at least if there is more than one.
SHARE_BYTES, LEAST_SHARE_BYTES = 32 << 20, 1 << 20


def shares_of(spark: SparkSession, path: str, by: str, days: Sequence[dt.date]) -> dict[dt.date, int]:
    """Into how many shares each day of a table is dealt: by its stored size, so that all days together keep all cores busy."""
    wanted = -(-4 * spark.sparkContext.defaultParallelism // max(len(days), 1))

    def size(day: dt.date) -> int:
        fs, p = _fs(spark, f"{path}/{by}={day}")
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    sizes = {d: size(d) for d in days}
    return {d: max(1, min(wanted, n // LEAST_SHARE_BYTES), -(-n // SHARE_BYTES)) for d, n in sizes.items()}


def deal(df: DataFrame, by: str, keys: Sequence[str], shares: dict[dt.date, int]) -> DataFrame:
    """Rows dealt once by day and share of ``keys``, which is added as ``SHARE``.

    An aggregation by ``by``, ``SHARE`` and others needs no further exchange, and its rows can be written as they lie:
    a share of a day is one file. A big day has more shares, so that it is still written by many tasks; no one value of the
    keys may have a great part of a day's rows.
    """
    usual = min(shares.values(), default=1)
    more = [F.lit(x) for day, n in shares.items() if n > usual for x in (day, n)]
    number = F.coalesce(F.element_at(F.create_map(*more), F.col(by)), F.lit(usual)) if more else F.lit(usual)
    return df.withColumn(SHARE, F.pmod(F.hash(*keys), number)).repartition(max(sum(shares.values()), 1), by, SHARE)


def _laid_out(df: DataFrame, by: str, cluster: Sequence[str], days: int = 0) -> DataFrame:
    """Rows of a partition together, in cluster order.

    Rebalancing sends a partition's rows to few tasks, and splits a partition that is too big for one,
    so a day that holds a third of the table is still written by many tasks. Order inside the files
    lets scans skip row groups by their minimum and maximum. Where it is known that there are fewer ``days`` than cores,
    each is dealt in shares of its rows' first column, so that all cores write, whatever the day's size.
    """
    shares = -(-df.sparkSession.sparkContext.defaultParallelism // days) if days else 1
    if shares > 1:
        name = "_share"
        shared = df.withColumn(name, F.pmod(F.hash(df.columns[0]), F.lit(shares)))
        spread = shared.hint("rebalance", by, name).drop(name)
    else:
        spread = df.hint("rebalance", by)
    return spread.sortWithinPartitions(by, *cluster) if cluster else spread


def write_partitioned(
    df: DataFrame, path: str, by: str, mode: str = "append", cluster: Sequence[str] = (), days: int = 0, dealt: bool = False
) -> None:
    """Write one directory per value of ``by``, of which there are ``days`` if that is known.

    Rows that are ``dealt`` by day already are written as they lie, in cluster order."""
    if dealt:
        rows = df.sortWithinPartitions(by, *cluster) if cluster else df
    else:
        rows = _laid_out(df, by, cluster, days)
    rows.write.mode(mode).partitionBy(by).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, by: str, cluster: Sequence[str] = (), expected: Sequence[dt.date] = (), dealt: bool = False
) -> None:
    """Replace the partitions that occur in ``df``; all others stay as they are.

    ``expected`` names partitions that ``df`` is the whole new content of: one that it has no row for is dropped, as its
    old rows are no longer true. Rows that were ``dealt`` by day already are written as they lie.
    """
    spark = df.sparkSession
    before = {d: _file_names(spark, f"{path}/{by}={d}") for d in expected}
    rows = df if dealt else _laid_out(df, by, cluster, len(expected))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    for d, names in before.items():
        # A partition that was written anew has new file names.
        if names and names == _file_names(spark, f"{path}/{by}={d}"):
            drop(spark, f"{path}/{by}={d}")


def _file_names(spark: SparkSession, path: str) -> set[str]:
    fs, p = _fs(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Freeze a frame into a table and read it back; this also cuts its lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched(df: DataFrame, by: str) -> list[dt.date]:
    """Partition dates of a batch: one value per day, never rows."""
    return sorted(r[0] for r in df.select(by).distinct().collect())


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder where another one may be. After a crash in between, the source is still there to be moved."""
    fs, to = _fs(spark, target)
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), to):
        raise OSError(f"cannot move {source} to {target}")


def publish(spark: SparkSession, staged: str, path: str, by: str, expected: Sequence[dt.date] = ()) -> None:
    """Move finished partitions into a table, in place of those it has; no file is written again.

    ``expected`` are partitions that ``staged`` is the whole new content of: one that it has nothing for is dropped. They
    are noted before the first folder moves, so that a repeated call does not take a moved one for an empty one.
    """
    fs, root = _fs(spark, staged)
    noted = f"{staged}.emptied"
    if expected and not exists(spark, f"{noted}/_SUCCESS"):
        held = partition_days(spark, staged, by)
        for day in (*(d for d in expected if d not in held), None):
            where = f"{noted}/{by}={day}" if day else f"{noted}/_SUCCESS"
            fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(where))
    for day in partition_days(spark, noted, by):
        drop(spark, f"{path}/{by}={day}")
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{by}="):
            _move(spark, f"{staged}/{name}", f"{path}/{name}")


def stage(df: DataFrame, path: str, by: str, cluster: Sequence[str] = (), days: int = 0, dealt: bool = False) -> None:
    """Write a folder of partitions (``days`` of them, if that is known), unless an earlier attempt has finished it."""
    if not exists(df.sparkSession, f"{path}/_SUCCESS"):
        write_partitioned(df, path, by, mode="overwrite", cluster=cluster, days=days, dealt=dealt)


def changes_of(spark: SparkSession, staging: str, by: str) -> DataFrame | None:
    """What a merge changed: the keys, and ``before`` and ``after``, the rest of the row (``before`` is null for a new key)."""
    return spark.read.parquet(f"{staging}/changes") if partition_days(spark, f"{staging}/changes", by) else None


def upsert(
    batch: DataFrame, path: str, staging: str, keys: Sequence[str], newest: Sequence[Column | str], by: str,
    unique: bool = False, days: int = 0,
) -> list[dt.date]:
    """Merge a batch into a table, newest row per key, however late it arrives; returns the days of the batch.

    ``newest`` are columns, or expressions of them, that order the rows of a key; the greater one stays. Everything goes
    through ``staging``, a path of this batch alone: the batch, once, in partitions whose names tell its days; its changes,
    from a join of those rows with the old ones of their days; and the new content of the days that change. The finished
    partitions are moved in. A run that dies at any point is repeated from what is finished, and merging the same batch
    again changes nothing. Old rows are never sorted or deduplicated again, and days without a change are not written.
    A batch that is known to be ``unique`` has no two rows of a key, and is not deduplicated either; ``days`` is its number
    of days, if that is known.
    """
    spark = batch.sparkSession
    columns = batch.columns
    rest = [c for c in columns if c not in (*keys, by)]
    order = F.struct(*newest).alias("_order")
    once = batch if unique else last_write_wins(batch, keys=[*keys, by], newest=newest)
    stage(once, f"{staging}/incoming", by, days=days)
    dates = partition_days(spark, f"{staging}/incoming", by)
    if not dates:
        return []

    def old(days: list[dt.date]) -> DataFrame:
        return spark.read.schema(batch.schema).parquet(path).filter(F.col(by).isin(days))

    if not exists(spark, f"{staging}/merged/_SUCCESS"):
        incoming = spark.read.schema(batch.schema).parquet(f"{staging}/incoming")
        held = set(partition_days(spark, path, by))
        after = incoming.select(*keys, by, F.struct(*rest).alias("after"), order.alias("_new"))
        if compared := sorted(held.intersection(dates)):
            before = old(compared).select(*keys, by, F.struct(*rest).alias("before"), order.alias("_old"))
            found = after.join(before, [*keys, by], "left").filter("before is null or _new > _old").drop("_new", "_old")
        else:
            # Nothing to compare with: the staged rows are the changes, and lie by day already.
            unknown = F.lit(None).cast(T.StructType([f for f in batch.schema if f.name in rest]))
            found = after.select(*keys, by, "after", unknown.alias("before"))
        stage(found, f"{staging}/changes", by, days=len(dates), dealt=not compared)
        changed = partition_days(spark, f"{staging}/changes", by)
        if not changed:
            return dates
        new = spark.read.schema(found.schema).parquet(f"{staging}/changes")
        merged = new.select(*keys, by, "after.*").select(*columns)
        if replaced := sorted(held.intersection(changed)):
            kept = old(replaced).join(new.select(*keys, by), [*keys, by], "left_anti")
            merged = kept.select(*columns).unionByName(merged)
        stage(merged, f"{staging}/merged", by, cluster=keys, days=len(changed), dealt=not replaced)
    publish(spark, f"{staging}/merged", path, by)
    return dates


def partition_days(spark: SparkSession, path: str, by: str) -> list[dt.date]:
    """The days of a table, read off its folder names."""
    fs, root = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(dt.date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{by}="))


def purge_before(spark: SparkSession, path: str, by: str, cutoff: dt.date) -> list[str]:
    """Drop whole date partitions older than the cut-off; returns what was dropped."""
    fs, root = _fs(spark, path)
    dropped = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(f"{by}=") and dt.date.fromisoformat(name.split("=", 1)[1]) < cutoff:
            fs.delete(status.getPath(), True)
            dropped.append(name)
    return sorted(dropped)


def retained(raw: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Rows whose ingestion day is inside the retention window."""
    cutoff = as_of - dt.timedelta(days=days)
    return raw.filter(F.to_date("ingested_at") >= F.lit(cutoff.isoformat()).cast("date"))
