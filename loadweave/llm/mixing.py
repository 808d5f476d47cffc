"""Mix sources to target weights by a low-discrepancy schedule. DataFrame operations only.

Sources in code-point order (null last) get the weights in turn; targets share all words by weight, none above
``most`` times its source's size, and what is over goes to the others by weight. Sorted by that cap per weight the
capped sources come first, so one running sum finds the final level without iterating.

A mix is a row of slots of ``block`` words. Slot i holds the point frac((i + 1/2) x golden ratio); the cumulative target
shares map it to a source, and the slot's rank among its source's slots names the block it takes. A source's
stream is its documents in shuffled order (by the MD5 of seed and id), read again from the start when used up and cut
into equal blocks at its target, so the last block may be shorter. The points leave a source at most a few blocks off
its target: blocks that got no slot are appended in closing slots, surplus slots stay empty. So each source
gives its rounded target, and no document more than ``most`` times its size.

Ranks and running sums are taken in two steps, inside chunks of bounded size and over the chunks' totals, so that a
source with a third of all rows is spread over many tasks. Points find their source by an equality join on cells of the
unit interval.

Defined results: null text has size 0; a source without words has target 0; a document without words takes 0; rows with equal ids are documents of their own (equal rows share
alike). An empty table gives no rows. Only id, text and source are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadweave.llm.common import WORD, kept_at, scratch, whole

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 256
#: Rows that one task ranks together, and cells of the unit interval.
CHUNK, CELLS = 4_096, 4_096
GOLDEN = (5**0.5 - 1) / 2


class Mix(NamedTuple):
    """The sizes of all documents, the targets of their sources, the documents' places in their sources' streams, and
    the mix itself: a row for each piece of a document in a slot (slot, s, rank, doc_id, offset, turn, first, upto)."""

    sizes: DataFrame
    targets: DataFrame
    streams: DataFrame
    parts: DataFrame


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source and number of words of each document."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(whole(text_col), F.lit(WORD)).cast("long").alias("size"),
    )


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """A row per source: source, s (its number), weight, source_size, target, goal (the target in whole words)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    one = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = one.withColumn("s", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(turn, (F.col("s") % len(weights) + 1).cast("int")).cast("long")
    )
    all_rows = Window.partitionBy()
    by_cap = Window.orderBy(F.col("source_size") * most / F.col("weight"), "s").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("total") - most * F.coalesce(F.sum("source_size").over(by_cap), F.lit(0))
    open_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0))
    capped = named.withColumn("total", F.sum("source_size").over(all_rows)).withColumn(
        "full", most * F.col("source_size") * open_weight <= left * F.col("weight")
    )
    spent = F.sum(F.when(F.col("full"), most * F.col("source_size")).otherwise(0)).over(all_rows)
    rest = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(all_rows)
    share = ((F.col("total") - spent) * F.col("weight")).cast("double") / rest
    final = capped.withColumn(
        "target", F.when(F.col("full"), (most * F.col("source_size")).cast("double")).otherwise(share)
    )
    goal = F.least(F.round("target").cast("long"), most * F.col("source_size"))
    return final.select("source", "s", "weight", "source_size", "target", goal.alias("goal"))


def _ranked(rows: DataFrame, key: str, chunk: str, order: list[Column], amount: Column, name: str) -> DataFrame:
    """Adds the running sum of ``amount`` before each row of its key, in two steps over bounded chunks."""
    whole_chunk = rows.groupBy(key, chunk).agg(F.sum(amount).alias("_amount"))
    before = F.coalesce(
        F.sum("_amount").over(Window.partitionBy(key).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    bases = whole_chunk.select(key, chunk, before.alias("_base"))
    inside = F.coalesce(
        F.sum(amount).over(Window.partitionBy(key, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0),
    )
    return rows.withColumn("_inside", inside).join(bases, [key, chunk]).withColumn(
        name, F.col("_base") + F.col("_inside")
    ).drop("_base", "_inside", chunk)


def streams(rows: DataFrame, goals: DataFrame, n_docs: int, seed: int = 0) -> DataFrame:
    """Documents with words, with ``offset``, their place in their source's shuffled stream."""
    chunks = max(1, -(-n_docs // CHUNK))
    name = F.concat_ws("/", F.lit(str(seed)), F.col("doc_id").cast("string"))
    spot = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")
    numbered = rows.where("size > 0").join(goals.select("source", "s"), rows["source"].eqNullSafe(goals["source"])).select(
        "s", "doc_id", "size", spot.alias("spot"), F.floor(spot * chunks / 2**32).alias("chunk"),
    )
    return _ranked(numbered, "s", "chunk", [F.col("spot"), F.col("doc_id"), F.col("size")], F.col("size"), "offset")


def schedule(goals: DataFrame, total: int, block: int = BLOCK) -> DataFrame:
    """The mix as slots: slot, s (source number), rank (the block of the source it takes)."""
    spark = goals.sparkSession
    slots = -(-total // block)
    used = goals.where("goal > 0")
    upto = F.sum("goal").over(Window.orderBy("s"))
    share = used.select(
        "s", ((upto - F.col("goal")) / F.sum("goal").over(Window.partitionBy())).alias("low"),
        (upto / F.sum("goal").over(Window.partitionBy())).alias("high"),
    )
    cells = share.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1))))
    )
    turn = (F.col("slot") + 0.5) * GOLDEN
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", turn - F.floor(turn))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS))
    placed = points.join(cells, "cell").where("point >= low AND point < high").select(
        "s", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk")
    )
    ranked = _ranked(placed, "s", "chunk", [F.col("slot")], F.lit(1), "rank")
    wanted = used.select("s", F.ceil(F.col("goal") / block).alias("blocks"))
    given = placed.groupBy("s").agg(F.count(F.lit(1)).alias("given"))
    closing = wanted.join(given, "s", "left").withColumn("given", F.coalesce("given", F.lit(0))).where("given < blocks").select(
        "s", F.explode(F.sequence(F.col("given"), F.col("blocks") - 1)).alias("rank")
    )
    kept = ranked.join(wanted, "s").where("rank < blocks").select("slot", "s", "rank")
    return kept.unionByName(closing.select((F.lit(slots) + F.col("rank")).alias("slot"), "s", "rank"))


def pieces(placed: DataFrame, goals: DataFrame, block: int = BLOCK, most: int = MOST) -> DataFrame:
    """What each block of a source holds: s, rank, doc_id, offset, turn (which reading), first, upto (word numbers)."""
    length = goals.where("goal > 0").select("s", "source_size", "goal")
    turn = F.explode(F.sequence(F.lit(0), F.lit(most - 1)))
    read = placed.join(length, "s").withColumn("turn", turn).withColumn(
        "start", F.col("turn") * F.col("source_size") + F.col("offset")
    ).where("start < goal").withColumn("stop", F.least(F.col("start") + F.col("size"), F.col("goal")))
    cut = read.withColumn(
        "rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("stop") - 1) / block)))
    )
    return cut.select(
        "s", "rank", "doc_id", "offset", "turn",
        (F.greatest(F.col("start"), F.col("rank") * block) - F.col("start")).alias("first"),
        (F.least(F.col("stop"), (F.col("rank") + 1) * block) - F.col("start")).alias("upto"),
    )


def mixed(
    docs: DataFrame, block: int = BLOCK, most: int = MOST, weights: Sequence[int] = WEIGHTS, seed: int = 0, **columns: str,
) -> Mix:
    """The mix of all documents; ``columns`` name the id, text and source columns."""
    path = scratch(docs.sparkSession, "mix")
    rows = kept_at(sizes(docs, **columns), f"{path}/sizes")
    goals = kept_at(targets(rows, weights, most).coalesce(1), f"{path}/targets")
    total, n_docs = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    placed = kept_at(streams(rows, goals, n_docs, seed), f"{path}/streams")
    parts = schedule(goals, total, block).join(pieces(placed, goals, block, most), ["s", "rank"])
    return Mix(rows, goals, placed, parts)


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    mix = mixed(docs, **options)
    taken = mix.parts.groupBy("s", "offset").agg(F.sum(F.col("upto") - F.col("first")).alias("taken"))
    worded = mix.streams.join(taken, ["s", "offset"], "left").select("s", "doc_id", "size", "taken")
    bare = mix.sizes.where("size = 0")
    empty = bare.join(mix.targets.select("s", "source"), bare["source"].eqNullSafe(mix.targets["source"])).select(
        "s", "doc_id", "size", F.lit(0).cast("long").alias("taken")
    )
    return worded.unionByName(empty).join(mix.targets, "s").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
    )
