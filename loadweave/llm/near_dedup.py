"""Near duplicates by min-max hashing, confirmed on full shingle sets.

Each permutation of the shingle hashes is evaluated once and gives two values of the signature, the least and the
greatest, which are both unbiased for the Jaccard similarity. Bands of four values are the keys under which documents
meet: with 48 permutations (96 values, 24 bands) two sets with similarity 0.85 miss each other with a chance of
(1 - 0.85^4)^24 = 2e-8, with 0.8 of 3e-6. Sets of fewer than ``EXACT`` shingles are found without chance: they, and sets
that are not too large to be similar to one of them, meet under the rarest of their shingles, as many as two similar sets
cannot all differ in (prefix filtering).

1. Documents with equal sets (128-bit hash of the sorted set) form a class; its smallest id stands for it.
2. In each bucket every representative is compared with the bucket's smallest. Confirmed links give components; a
   bucket with a third of all documents costs one comparison a document.
3. Buckets that still hold several components are searched for links between them, one of those with the same members:
   members outside the bucket's largest component are dealt into chunks of about ``BLOCK``, all members into others, and
   each chunk of the ones meets each chunk of the others. There all pairs of different components are compared on full
   sets, and only a forest of the links found is emitted.
4. Components of all links; the smallest id stays.

Full sets are computed again, for documents that share a bucket only, and travel by document, never as all pairs of a
bucket. Every intermediate is written to the shared folder.

Defined results: null and empty texts, and texts without words, have no set and are linked with nothing; a text with
fewer words than a shingle has one shingle. Rows with equal ids are one node; a row without id has a null
component and is kept. An empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import discard, kept_at, scratch, whole
from loadweave.llm.components import components
from loadweave.llm.shingle_sets import band_keys, jaccard_counts, min_max, shingle_sets

SHINGLE = 5
PERCENT = 80
PERMUTATIONS, BANDS = 48, 24
BLOCK = 512
#: Sets with fewer shingles meet under their rarest shingles instead of bands.
EXACT = 64
#: Shingles that a task holds before it hands on their rows.
HELD = 1 << 17


def _set_key(values: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(values.tobytes())


def _signer(n: int, permutations: int, bands: int, few: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, held, size = batch.column(0), 0, [], 0
            for values in shingle_sets((t.as_py() for t in batch.column(1)), n):
                held.append(values)
                size += len(values)
                if size >= HELD:
                    yield pack(ids.slice(at, len(held)), held)
                    at, held, size = at + len(held), [], 0
            if held:
                yield pack(ids.slice(at, len(held)), held)

    def pack(ids: pa.Array, held: list[np.ndarray]) -> pa.RecordBatch:
        long = [k for k, v in enumerate(held) if len(v) >= EXACT]
        signatures = np.array([min_max(held[k], permutations) for k in long])
        keys = dict(zip(long, band_keys(signatures, bands).view(np.int64))) if long else {}
        return pa.RecordBatch.from_pydict({
            "doc_id": ids,
            "n_shingles": pa.array([len(v) for v in held], pa.int64()),
            "set_key": pa.array([_set_key(v) for v in held], pa.binary()),
            "keys": pa.array([keys.get(k, ()) for k in range(len(held))], pa.list_(pa.int64())),
            "few": pa.array([v.view(np.int64) if len(v) <= few else None for v in held], pa.list_(pa.int64())),
        })

    return sign


def signed(docs: DataFrame, n: int, percent: int, permutations: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, set_key, band keys (of sets that are not short) and few (the set, if a short one can be similar)."""
    kind = "doc_id long, n_shingles long, set_key binary, keys array<long>, few array<long>"
    return docs.mapInArrow(_signer(n, permutations, bands, (EXACT - 1) * 100 // percent), kind)


def rarest(sets: DataFrame, percent: int, path: str) -> DataFrame:
    """key and doc_id: the shingles under which similar sets meet, of frames with doc_id, set_key, n_shingles and few.

    In one order of all shingles, sets with 100 * intersection >= percent * union share one of the first
    size - ceil(percent * size / 100) + 1 of each. Rare shingles come first; those of a single set lead to no other.
    """
    each = sets.where("few IS NOT NULL").select("doc_id", "set_key", "n_shingles", F.explode("few").alias("key"))
    common = kept_at(each.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), f"{path}/common")
    held = each.join(common, "key").groupBy("doc_id", "set_key", "n_shingles").agg(
        F.sort_array(F.collect_list(F.struct("sets", "key"))).alias("held")
    )
    first = F.expr(f"n_shingles - ({percent} * n_shingles + 99) div 100 + 1 - (n_shingles - size(held))")
    taken = F.slice("held", F.lit(1), F.greatest(first, F.lit(0)).cast("int"))
    return held.select("doc_id", F.explode(taken).alias("one")).select("one.key", "doc_id")


def full_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id and shingles (the sorted set as bytes) of each row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, held, size = 0, [], 0
            for values in shingle_sets((t.as_py() for t in batch.column(1)), n):
                held.append(values.tobytes())
                size += len(values)
                if size >= HELD:
                    yield pack(batch.column(0).slice(at, len(held)), held)
                    at, held, size = at + len(held), [], 0
            if held:
                yield pack(batch.column(0).slice(at, len(held)), held)

    def pack(ids: pa.Array, held: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, pa.array(held, pa.binary())], names=["doc_id", "shingles"])

    return docs.mapInArrow(read, "doc_id long, shingles binary")


def _confirm(percent: int):
    """Of pairs (a, b, set of a, set of b) those that are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, two in zip(batch.column(2), batch.column(3)):
                shared, union = jaccard_counts(np.frombuffer(one.as_buffer(), "<u8"), np.frombuffer(two.as_buffer(), "<u8"))
                good.append(100 * shared >= percent * union)
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return confirm


class _Forest:
    """Labels joined as links are found; remembers the links that joined something."""

    def __init__(self, labels: list[int]):
        self.up = {x: x for x in labels}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int, link: tuple[int, int]) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
            self.links.append(link)


def _links_of_block(rows: list[dict], percent: int) -> list[tuple[int, int]]:
    """A forest of links between the block's visitors and residents of other components, by exact counts."""
    sets = [np.frombuffer(r["shingles"], "<u8") for r in rows]
    residents = [k for k, r in enumerate(rows) if r["resident"]]
    if not residents:
        return []
    sizes = np.array([len(sets[k]) for k in residents])
    comps = np.array([rows[k]["comp"] for k in residents])
    ids = np.array([rows[k]["doc_id"] for k in residents])
    outside = np.array([rows[k]["outside"] for k in residents])
    held = np.concatenate([sets[k] for k in residents])
    order = np.argsort(held, kind="stable")
    held, whose = held[order], np.repeat(np.arange(len(residents)), sizes)[order]
    forest = _Forest([r["comp"] for r in rows])
    for k, own in enumerate(rows):
        if not own["visitor"]:
            continue
        low, high = np.searchsorted(held, sets[k], "left"), np.searchsorted(held, sets[k], "right")
        many = high - low
        hits = np.repeat(high - np.cumsum(many), many) + np.arange(many.sum())
        shared = np.bincount(whose[hits], minlength=len(residents))
        near = 100 * shared >= percent * (len(sets[k]) + sizes - shared)
        # Two members outside the largest component visit each other; one of the visits is enough.
        near &= (comps != own["comp"]) & (~outside | (ids > own["doc_id"]))
        for j in np.flatnonzero(near):
            forest.join(own["comp"], int(comps[j]), (own["doc_id"], int(ids[j])))
    return forest.links


def _block_searcher(percent: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["key"], row["block"]) != block and held:
                    yield as_links(held)
                    held = []
                block = row["key"], row["block"]
                held.append(row)
        if held:
            yield as_links(held)

    def as_links(held: list[dict]) -> pa.RecordBatch:
        found = _links_of_block(held, percent)
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
        )

    return search


def _star_links(reps: DataFrame, meets: DataFrame, pivots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links of representatives with the smallest of their buckets."""
    pairs = meets.join(pivots, "key").where("doc_id <> pivot").select("doc_id", "pivot").distinct()
    sizes = reps.select(F.col("doc_id").alias("pivot"), F.col("n_shingles").alias("n_pivot"))
    near = pairs.join(reps.select("doc_id", "n_shingles"), "doc_id").join(sizes, "pivot").where(
        100 * F.least("n_shingles", "n_pivot") >= percent * F.greatest("n_shingles", "n_pivot")
    )
    own = sets.select("doc_id", F.col("shingles").alias("own"))
    its = sets.select(F.col("doc_id").alias("pivot"), F.col("shingles").alias("its"))
    joined = near.select("doc_id", "pivot").join(own, "doc_id").join(its, "pivot").select("doc_id", "pivot", "own", "its")
    return joined.mapInArrow(_confirm(percent), "a long, b long")


def _cross_links(meets: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that meet in a bucket."""
    named = comps.select(F.col("node").alias("doc_id"), "root")
    members = meets.join(named, "doc_id", "left").select("key", "doc_id", F.coalesce("root", "doc_id").alias("comp"))
    # Two sums of 32-bit hashes and the count tell whether two buckets have the same members.
    marks = [F.sum(F.shiftright(F.xxhash64("doc_id", F.lit(k)), 32)).alias(f"mark{k}") for k in (0, 1)]
    per_comp = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"), *marks)
    mixed = per_comp.groupBy("key").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"),
        F.count(F.lit(1)).alias("comps"), F.sum("mark0").alias("mark0"), F.sum("mark1").alias("mark1"),
    ).where("comps > 1")
    least = F.min(F.struct("key", "main", "most")).alias("one")
    mixed = mixed.groupBy("n", "mark0", "mark1").agg(least).select("one.*", "n")
    outside = F.col("comp") != F.col("main")
    placed = members.join(mixed, "key").select(
        "key", "doc_id", "comp", outside.alias("outside"), F.ceil(F.col("n") / BLOCK).alias("homes"),
        F.ceil((F.col("n") - F.col("most")) / BLOCK).alias("turns"),
    ).withColumn("home", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("homes"))).withColumn(
        "turn", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.col("turns"))
    )
    # A block is a chunk of residents (home) and one of visitors (turn).
    lives = F.expr("transform(sequence(0L, turns - 1), t -> home * turns + t)")
    visits = F.expr("transform(sequence(0L, homes - 1), h -> h * turns + turn)")
    rows = placed.withColumn("block", F.explode(F.when(F.col("outside"), F.array_union(lives, visits)).otherwise(lives)))
    rows = rows.withColumn("resident", F.expr("block div turns = home")).withColumn(
        "visitor", F.col("outside") & F.expr("block % turns = turn")
    )
    full = rows.join(sets, "doc_id").select("key", "block", "doc_id", "comp", "outside", "resident", "visitor", "shingles")
    dealt = full.repartition("key", "block").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(_block_searcher(percent), "a long, b long")


def near_duplicates(
    docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, permutations: int = PERMUTATIONS, bands: int = BANDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= percent * union of their sets of n-word shingles.
    """
    path = scratch(docs.sparkSession, "near-dedup")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    signatures = kept_at(signed(rows, n, percent, permutations, bands), f"{path}/signed")
    named = signatures.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = kept_at(named.groupBy("set_key").agg(F.min("doc_id").alias("rep")), f"{path}/classes")
    reps = named.join(classes.withColumnRenamed("rep", "doc_id"), ["set_key", "doc_id"])
    reps = kept_at(reps.dropDuplicates(["set_key", "doc_id"]), f"{path}/reps")
    # Documents that share a bucket with another representative; the others need nothing more.
    short = kept_at(rarest(reps, percent, path), f"{path}/rarest")
    banded = reps.select(F.explode("keys").alias("key"), "doc_id").unionByName(short)
    pivots = kept_at(
        banded.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
            "key", "pivot"
        ), f"{path}/pivots",
    )
    meets = kept_at(banded.join(pivots.select("key"), "key").select("key", "doc_id"), f"{path}/meets")
    wanted = kept_at(meets.select(F.col("doc_id").alias("_id")).distinct(), f"{path}/wanted")
    is_near = F.col("doc_id") == F.col("_id")
    near = kept_at(reps.join(wanted, is_near, "left_semi").select("doc_id", "n_shingles"), f"{path}/near")
    sets = kept_at(full_sets(rows.join(wanted, is_near, "left_semi").select("doc_id", "text"), n), f"{path}/sets")
    sure = kept_at(_star_links(near, meets, pivots, sets, percent), f"{path}/star")
    comps = components(sure, f"{path}/star-components")
    more = kept_at(_cross_links(meets, comps, sets, percent), f"{path}/cross")
    final = kept_at(components(sure.unionByName(more), f"{path}/components"), f"{path}/roots")
    # What follows reads the signatures, the classes and the roots.
    discard(
        docs.sparkSession, path, "reps", "common", "rarest", "pivots", "meets", "wanted", "near", "sets", "star", "star-components", "cross",
        "components",
    )
    roots = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("root", "rep").alias("_root")
    )
    held = named.select("doc_id", "n_shingles", "set_key").join(roots, "set_key").select(
        "doc_id", "n_shingles", F.col("_root").alias("component_id")
    )
    bare = signatures.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return held.unionByName(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
