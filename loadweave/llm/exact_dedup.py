"""Exact deduplication against a minimal perfect hash over historical digests.

Texts are compared after each run of ASCII white space has become one space; a null text counts as empty. The
SHA-256 of the normalised UTF-8 text stands for the text. The distinct digests of the history are dealt into
buckets; each bucket gets a minimal perfect hash (levels of bit arrays: a key stays on the first level where it
meets no other key, its slot is the rank of its bit). A slot holds the full digest, the smallest document id
and the number of rows, so a lookup compares all 32 bytes and a stranger that falls on a slot is recognised.
Incoming rows are combined per digest before they are dealt to the buckets, so a group of copies with a third of
all rows arrives as one row a task. Digests the history does not hold form groups of their own.

Defined results: an empty table gives no rows; a repeated row counts each time; a null id never wins against
an integer id, and a group with null ids only has a null ``keep_id`` (its rows are all kept). Columns other than
id and text are neither read nor returned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import SPACE, kept_at, scratch, whole

#: Levels before the rest of a bucket's keys is kept as a plain sorted list.
LEVELS = 48
INDEX = (
    "bucket long, sizes array<long>, bits array<binary>, digests binary, winners array<long>, counts array<long>"
)
GROUP = "digest binary, keep_id long, group_size long"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the 32 bytes of the normalised text's SHA-256."""
    text = F.regexp_replace(whole(text_col), SPACE, " ")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))


def groups(rows: DataFrame) -> DataFrame:
    """A row for each digest: smallest id and number of rows, combined before the shuffle."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))


def _spots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys[:, 0] + np.uint64(level) * (keys[:, 1] | np.uint64(1))
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def _as_keys(raw: np.ndarray) -> np.ndarray:
    """The first 16 bytes of each digest as two integers."""
    return np.ascontiguousarray(raw[:, :16]).view("<u8").reshape(-1, 2)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), dtype=np.uint8).reshape(-1, 32)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct digests; any other digest gets some slot or -1."""

    def __init__(self, sizes: list[int], bits: list[bytes]):
        self.sizes = [int(s) for s in sizes]
        self.bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=s) for b, s in zip(bits, self.sizes)]
        held = [int(b.sum()) for b in self.bits]
        self.base = np.concatenate([[0], np.cumsum(held)]).astype(np.int64)
        self.ranks = [np.cumsum(b, dtype=np.int64) - 1 for b in self.bits]

    @classmethod
    def build(cls, raw: np.ndarray) -> tuple[PerfectHash, list[bytes]]:
        keys, left, sizes, packed = _as_keys(raw), np.arange(len(raw)), [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(2, 2 * len(left))
            at = _spots(keys[left], level, size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            packed.append(np.packbits(alone).tobytes())
            left = left[~alone[at]]
        return cls(sizes, packed), packed

    def slots(self, raw: np.ndarray) -> np.ndarray:
        keys, out, left = _as_keys(raw), np.full(len(raw), -1, np.int64), np.arange(len(raw))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = _spots(keys[left], level, size)
            hit = self.bits[level][at] == 1
            out[left[hit]] = self.base[level] + self.ranks[level][at[hit]]
            left = left[~hit]
        return out

    def __len__(self) -> int:
        return int(self.base[-1])


def _whole_numbers(values) -> list[int | None]:
    return [None if pd.isna(v) else int(v) for v in values]


def _build_bucket(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    raw = _matrix(rows["digest"])
    table, packed = PerfectHash.build(raw)
    slots = table.slots(raw)
    # Keys that no level could part come after the slots, in the order of their bytes.
    rest = np.flatnonzero(slots < 0)
    rest = rest[np.argsort([raw[i].tobytes() for i in rest])] if len(rest) else rest
    slots[rest] = len(table) + np.arange(len(rest))
    order = np.argsort(slots)
    winners = _whole_numbers(rows["winner"])
    return pd.DataFrame([{
        "bucket": key[0], "sizes": table.sizes, "bits": packed, "digests": raw[order].tobytes(),
        "winners": [winners[i] for i in order], "counts": rows["n"].to_numpy()[order].tolist(),
    }])


def build_index(history: DataFrame, buckets: int, path: str) -> DataFrame:
    """Write the index over the history's groups, one row a bucket, and read it back."""
    dealt = history.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    return kept_at(dealt.groupBy("bucket").applyInPandas(_build_bucket, INDEX), path)


def _look_up(index: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    if len(index):
        one = index.iloc[0]
        held = np.frombuffer(one["digests"], np.uint8).reshape(-1, 32)
        winners, counts = list(one["winners"]), np.array(one["counts"], dtype=np.int64)
        table = PerfectHash(one["sizes"], one["bits"])
    else:
        held, winners, counts, table = np.zeros((0, 32), np.uint8), [], np.zeros(0, np.int64), PerfectHash([], [])
    raw = _matrix(rows["digest"])
    found = table.slots(raw)
    extra = {held[i].tobytes(): i for i in range(len(table), len(held))}
    if extra:
        found = np.array([extra.get(raw[i].tobytes(), s) for i, s in enumerate(found)], dtype=np.int64)
    member = found >= 0
    member[member] = (held[found[member]] == raw[member]).all(axis=1)
    n, own = rows["n"].to_numpy(dtype=np.int64), _whole_numbers(rows["winner"])
    np.add.at(counts, found[member], n[member])
    best = list(winners)
    for slot, i in zip(found[member], np.flatnonzero(member)):
        ids = [v for v in (best[slot], own[i]) if v is not None and not pd.isna(v)]
        best[slot] = min(ids, default=None)
    strangers = np.flatnonzero(~member)
    return pd.DataFrame({
        "digest": [d.tobytes() for d in held] + [raw[i].tobytes() for i in strangers],
        "keep_id": pd.array(_whole_numbers(best) + [own[i] for i in strangers], dtype="Int64"),
        "group_size": np.concatenate([counts, n[strangers]]).astype(np.int64),
    })


def resolve(history: DataFrame, incoming: DataFrame, path: str, per_bucket: int = 100_000) -> DataFrame:
    """The winner and size of every digest of either side (frames of doc_id and digest).

    ``per_bucket`` is the mean number of digests a task holds; the buckets follow the size of both sides.
    """
    past, new = kept_at(groups(history), f"{path}/history"), kept_at(groups(incoming), f"{path}/incoming")
    buckets = max(1, -(-max(past.count(), new.count()) // per_bucket))
    index = build_index(past, buckets, f"{path}/index")
    dealt = new.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
    return index.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInPandas(_look_up, GROUP)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Documents with an id up to ``split`` are the history (by default the middle of the ids), the others, and
    those without an id, are looked up in it.
    """
    path = scratch(docs.sparkSession, "exact-dedup")
    rows = kept_at(digests(docs, id_col, text_col), f"{path}/digests")
    if split is None:
        low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
        split = 0 if low is None else (low + high) // 2
    past = F.coalesce(F.col("doc_id") <= F.lit(split), F.lit(False))
    decided = kept_at(resolve(rows.where(past), rows.where(~past), path), f"{path}/decided")
    return rows.join(decided, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
