"""A Merkle manifest of a dataset that stores every third level and computes the levels between again for proofs.

A leaf is the SHA-256 of a row's fields (each ``-`` if null, else its number of UTF-8 bytes, ``:`` and its value). The
leaves of a source, in order, form a tree of fan-out three: each run of three consecutive nodes (the last run may be
shorter, even of one) is hashed to its parent until one node is left, the source's subroot. The subroots, ordered by
source, form the top tree in the same way, and its last node is the root.

``build`` stores the levels 0, 3, 6 and so on of each tree. A stored node above is made from an aligned subtree of at most
27 stored nodes below; the levels between are hashed on the way and forgotten. ``proofs`` goes from the root down:
for each aligned subtree the levels between are computed again from the stored nodes, every node of the subtree gets its
siblings on them, its subtree's own path is put behind, and the levels between are dropped again. So both directions
handle groups of at most 27 nodes, and the joins are by subtree, 27 times fewer rows than nodes. The number of rounds is
the number of stored levels (log 27 of the largest source).

Positions come from one range partitioning of narrow rows by source and order, which spreads a hot source: a row's
position is its place inside its range plus the rows of its source in earlier ranges.

Defined results: null ids come first, and a null source is a source of its own, before all others. Rows with equal ids
are leaves of their own, in order of their hash; equal rows have equal leaves, neighbouring places and their own proofs.
A single leaf is its own subroot. An empty table has no root and no proofs. Columns other than those named are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadweave.llm.common import discard, kept_at

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes of a run, and levels from one stored level to the next.
FAN, STEP = 3, 3
TOP = "top"
#: Subtrees whose paths a task holds at once, and letters of a text that tell ranges apart.
HELD, BOUND = 256, 24
NODE = "tree string, pos long, hash string, height int, done boolean"
PATH = "array<struct<before:string,after:string>>"


class Manifest(NamedTuple):
    """A stored manifest: its folder, the stored levels of the sources' trees and of the top tree, and the root."""

    spark: SparkSession
    folder: str
    levels: int
    top_levels: int
    root: str | None


def leaf(rows: DataFrame, fields: Sequence[str] = FIELDS, **instead: Column) -> Column:
    """The leaf of a row; ``instead`` replaces single fields."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*(told(instead.get(f, rows[f])) for f in fields)), 256)


def parents(nodes: list[str], fan: int = FAN) -> list[str]:
    """The level above: one node per run."""
    return [sha256("".join(nodes[i:i + fan]).encode()).hexdigest() for i in range(0, len(nodes), fan)]


def inner_levels(nodes: list[str], n: int) -> list[list[str]]:
    """The nodes of an aligned subtree and of the n levels above them."""
    levels = [nodes]
    for _ in range(n):
        levels.append(parents(levels[-1]))
    return levels


def siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """For each level below the last, what precedes and follows node i's ancestor in its run."""
    path = []
    for nodes in levels[:-1]:
        first = i - i % FAN
        path.append(("".join(nodes[first:i]), "".join(nodes[i + 1:first + FAN])))
        i //= FAN
    return path


def placed(rows: DataFrame, order: Sequence[str], path: str) -> DataFrame:
    """Rows (tree, hash, row) with ``pos`` (their place in their tree) and ``height`` (of their tree)."""
    bare = kept_at(rows, f"{path}/unplaced")
    dealt = bare.repartitionByRange("tree", *_bounds(bare, order)).sortWithinPartitions("tree", *order)
    # The number is the range's, times 2^33, plus the place inside it; written, so that it is given only once.
    numbered = kept_at(dealt.withColumn("number", F.monotonically_increasing_id()), f"{path}/numbered")
    part = F.shiftright("number", 33).alias("part")
    ranges = numbered.groupBy("tree", part).agg(F.count(F.lit(1)).alias("rows"), F.min("number").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("part")
    before = F.sum("rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    size = F.sum("rows").over(Window.partitionBy("tree"))
    shift = ranges.select(
        "tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), _height(size).alias("height")
    )
    return numbered.withColumn("part", part).join(shift, ["tree", "part"]).withColumn(
        "pos", F.col("number") + F.col("shift")
    ).drop("part", "number", "shift")


def _bounds(rows: DataFrame, order: Sequence[str]) -> list[Column]:
    """What ranges are told apart by: the order up to its first text, of which some letters will do, as the sampled bounds go
    through the driver. Rows that agree in those are in one range, where the whole order sorts them."""
    kinds, out = dict(rows.select(*[F.col(c).alias(c) for c in order]).dtypes), []
    for name in order:
        out.append(F.substring(F.col(name), 1, BOUND) if kinds[name] == "string" else F.col(name))
        if kinds[name] == "string":
            break
    return out


def _height(size: Column) -> Column:
    """Levels above the leaves: how often FAN goes into the size, rounded up, until one is left."""
    powers = F.array(*(F.lit(FAN**k) for k in range(40)))
    return F.size(F.filter(powers, lambda p: p < size)).alias("height")


def _subtrees(nodes: DataFrame) -> DataFrame:
    """Nodes as rows of aligned subtrees: tree, block, height, nodes (in order, at most 27)."""
    item = F.struct("pos", "hash", *(["row"] if "row" in nodes.columns else []))
    block = F.floor(F.col("pos") / FAN**STEP).alias("block")
    return nodes.groupBy("tree", block).agg(
        F.min("height").alias("height"), F.array_sort(F.collect_list(item)).alias("nodes")
    )


def _raise(base: int):
    """Subtrees of stored nodes of level ``base`` to the nodes above them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, block, height, hashes in zip(*(c.to_pylist() for c in batch.columns)):
                top = inner_levels(hashes, min(STEP, height - base))[-1]
                out.append((tree, block, top[0], height, height <= base + STEP))
            names, kinds = ["tree", "pos", "hash", "height", "done"], [
                pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_()
            ]
            columns = list(zip(*out)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return work


def _levels(leaves: DataFrame, folder: str) -> int:
    """Store the levels of all trees whose leaves are given (tree, pos, hash, height, row); returns how many steps."""
    nodes = kept_at(leaves, f"{folder}/level-0")
    highest = nodes.agg(F.max("height")).first()[0]
    if highest is None:
        return 0
    count = max(1, -(-highest // STEP))
    for k in range(count):
        blocks = _subtrees(nodes).select("tree", "block", "height", F.col("nodes.hash").alias("hashes"))
        above = blocks.mapInArrow(_raise(k * STEP), NODE)
        written = kept_at(above, f"{folder}/level-{k + 1}")
        nodes = written.where("NOT done")
    return count


def _last_nodes(spark: SparkSession, folder: str, levels: int) -> DataFrame:
    """The one node that each tree ends in."""
    ends = [spark.read.parquet(f"{folder}/level-{k + 1}").where("done").select("tree", "hash") for k in range(levels)]
    out = ends[0]
    for more in ends[1:]:
        out = out.unionByName(more)
    return out


def build(leaves: DataFrame, folder: str, order: Sequence[str], tree_col: str = "source", leaf_col: str = "leaf") -> Manifest:
    """Store the manifest of leaves, each in the tree that ``tree_col`` names, in the given order.

    The columns of ``leaves`` are kept with the leaves, as one struct, so that proofs carry them.
    """
    spark = leaves.sparkSession
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    rows = leaves.select(tree.alias("tree"), F.col(leaf_col).alias("hash"), F.struct("*").alias("row"))
    levels = _levels(placed(rows, [f"row.{c}" for c in order], f"{folder}/sources"), f"{folder}/sources")
    if not levels:
        return Manifest(spark, folder, 0, 0, None)
    subroots = _last_nodes(spark, f"{folder}/sources", levels).select(
        F.lit(TOP).alias("tree"), "hash", F.struct("tree").alias("row")
    )
    top_levels = _levels(placed(subroots, ["row.tree"], f"{folder}/top"), f"{folder}/top")
    for part in ("sources", "top"):
        discard(spark, f"{folder}/{part}", "unplaced", "numbered")
    root = _last_nodes(spark, f"{folder}/top", top_levels).first()["hash"]
    return Manifest(spark, folder, levels, top_levels, root)


def _descend(base: int):
    """Subtrees with the path and subroot of what is above them to their nodes' own paths."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = pa.struct([("before", pa.string()), ("after", pa.string())])
        # A subtree unfolds into up to 27 rows with long paths, so few are held at once.
        for batch in (b.slice(i, HELD) for b in batches for i in range(0, b.num_rows, HELD)):
            at, paths = [], []
            columns = dict(zip(batch.schema.names, batch.columns))
            for row, (height, hashes, above) in enumerate(zip(
                columns["height"].to_pylist(), columns["hashes"].to_pylist(), columns["above"].to_pylist()
            )):
                levels = inner_levels(hashes, min(STEP, height - base))
                for i in range(len(hashes)):
                    own = [{"before": b, "after": a} for b, a in siblings(levels, i)]
                    at.append(row)
                    paths.append(own + above)
            flat = pa.array([n for nodes in columns["nodes"].to_pylist() for n in nodes], columns["nodes"].type.value_type)
            yield pa.RecordBatch.from_arrays(
                [columns["tree"].take(pa.array(at, pa.int32())), flat, columns["subroot"].take(pa.array(at, pa.int32())),
                 pa.array(paths, pa.list_(step))],
                names=["tree", "node", "subroot", "path"],
            )

    return work


def _paths(spark: SparkSession, folder: str, levels: int, ends: DataFrame, scratch: str) -> DataFrame:
    """The leaves with ``subroot`` and ``path`` to the root; ``ends`` has tree, subroot and the path behind each tree."""
    above = None
    for k in reversed(range(levels)):
        nodes = spark.read.parquet(f"{folder}/level-{k}")
        blocks = _subtrees(nodes.where("NOT done") if k else nodes)
        # A tree that ends in this step goes on with its own path, the others with their parent's.
        last = ends.select("tree", F.lit(0).cast("long").alias("block"), "subroot", F.col("path").alias("above"))
        ending = spark.read.parquet(f"{folder}/level-{k + 1}").where("done").select("tree")
        up = last.join(ending, "tree")
        up = up if above is None else up.unionByName(above)
        joined = blocks.join(up, ["tree", "block"]).withColumn("hashes", F.col("nodes.hash"))
        kind = dict(joined.dtypes)["nodes"].removeprefix("array<").removesuffix(">")
        found = joined.mapInArrow(_descend(k * STEP), f"tree string, node {kind}, subroot string, path {PATH}")
        if k == 0:
            return found.select("tree", "node.*", "subroot", "path")
        above = kept_at(
            found.select("tree", F.col("node.pos").alias("block"), "subroot", F.col("path").alias("above")),
            f"{scratch}/above-{k}",
        )
    raise ValueError("no stored level")


def proofs(manifest: Manifest) -> DataFrame:
    """A row per leaf: row (its columns), pos, subroot, root and path (what to put before and after, from the leaf up)."""
    spark, folder = manifest.spark, manifest.folder
    if manifest.root is None:
        kept, none = spark.read.parquet(f"{folder}/sources/level-0"), F.lit(None)
        ends = [none.cast(kind).alias(name) for name, kind in (("subroot", "string"), ("path", PATH), ("root", "string"))]
        return kept.select("pos", "row", *ends)
    no_path = F.array().cast(PATH)
    end = spark.range(1).select(F.lit(TOP).alias("tree"), F.lit(manifest.root).alias("subroot"), no_path.alias("path"))
    tops = _paths(spark, f"{folder}/top", manifest.top_levels, end, f"{folder}/paths/top")
    ends = kept_at(
        tops.select("row.tree", F.col("hash").alias("subroot"), "path"), f"{folder}/paths/subroots"
    )
    found = _paths(spark, f"{folder}/sources", manifest.levels, ends, f"{folder}/paths/sources")
    return found.select("pos", "row", "subroot", "path", F.lit(manifest.root).alias("root"))


def proof_digest(path: str = "path") -> Column:
    """The SHA-256 of a proof's siblings in a row."""
    told = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(told, ""), 256)


def folded(leaf_col: str, path: str = "path") -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(
        path, F.col(leaf_col), lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256)
    )
