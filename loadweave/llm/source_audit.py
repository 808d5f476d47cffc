"""How far the sources of a language lie apart in their words, and the words that set a source apart.

Terms are runs of letters A-Z (lower-cased) and of characters beyond ASCII. A language keeps the terms that at least
``LEAST`` of its documents hold (V of them). In a group (language, source), and in the language as a whole, a kept term
with ``count`` occurrences has p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N the count of all kept terms there. Two
distributions p and q differ by f = floor((p - q)^2 / (p + q)) in a term.

Identical texts of a language are collapsed first: one text travels once, with the number of its copies per source (of
digests, so a text that a third of all rows repeat is a few sums), is tokenised once, and adds its counts and document
frequencies times its copies. The texts of one task are added up before anything is shuffled.

Pairs are evaluated sparsely. With a0 and b0 the p of terms that do not occur in a and b, the sum over all kept terms is

    V f(a0, b0) + sum over terms of a (f(p, b0) - f(a0, b0)) + sum over terms of b (f(a0, q) - f(a0, b0))
      + sum over terms of both (f(p, q) - f(p, b0) - f(a0, q) + f(a0, b0)).

The single sums need only how many terms of a source have which count; the last one visits the pairs of sources that a term
has, inside a task, which adds them up and emits one row per pair. Everything is integer: the division by N + 2 V is done
on decimals, and p, squares of differences and sums fit 64 bits for any counts.

Defined results: null text, language and source are empty strings; a group without terms is a group with N = 0; repeated
rows are documents of their own; a language without kept terms gives 0 for each pair and no terms; a language with one
source has no pairs. An empty table gives no rows. Columns other than the three are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadweave.llm.common import kept_at, scratch, whole

LEAST, TOP, SCALE, PRIOR = 10, 10, 1_000_000_000, 2
#: Entries that a task adds up before it passes them on.
HELD = 1_000_000
#: Rows of terms that are compared at once: few enough for sums of their values to be exact as doubles.
SLICE = 1 << 20
#: Bytes of terms in lower case, blanks for all other bytes.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTED = "lang string, term string, source array<string>, docs array<long>, count array<long>"
#: Terms of one batch that a task passes on.
PASSED = 1 << 15
BOTH = "lang string, a string, b string, value long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(LETTERS).split()


class Codes(dict):
    """Numbers for names, in order of appearance."""

    def __missing__(self, name: Hashable) -> int:
        self[name] = len(self)
        return self[name]


class Tally:
    """Occurrences and documents of terms per language and source."""

    def __init__(self) -> None:
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)
        self.docs: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def add(self, lang: str, text: bytes, copies: list[dict]) -> None:
        found = terms(text)
        if len(copies) == 1 and copies[0]["copies"] == 1:
            key = lang, copies[0]["source"]
            self.counts[key].update(found)
            self.docs[key].update(set(found))
            return
        own = Counter(found)
        for copy in copies:
            counts, docs, n = self.counts[lang, copy["source"]], self.docs[lang, copy["source"]], copy["copies"]
            for term, k in own.items():
                counts[term] += k * n
                docs[term] += n

    def __len__(self) -> int:
        return sum(map(len, self.counts.values()))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row per language and term, with the sources that hold it."""
        for lang in dict.fromkeys(lang for lang, _ in self.counts):
            codes, at, source, docs, count = Codes(), [], [], [], []
            for (of, name), counts in self.counts.items():
                if of == lang:
                    held = self.docs[of, name]
                    at.extend(codes[t] for t in counts)
                    source.extend([name] * len(counts))
                    docs.extend(held[t] for t in counts)
                    count.extend(counts.values())
            where = np.array(at, np.int64)
            order = pa.array(np.argsort(where, kind="stable"))
            ends = pa.array(np.append(0, np.cumsum(np.bincount(where, minlength=len(codes)))), pa.int32())
            kinds = (source, pa.string()), (docs, pa.int64()), (count, pa.int64())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, kind).take(order)) for x, kind in kinds]
            names = pa.array([t.decode() for t in codes], pa.string())
            batch = pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), names, *lists], names=["lang", "term", "source", "docs", "count"]
            )
            for first in range(0, len(codes), PASSED):
                yield batch.slice(first, PASSED)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Tally()
    for batch in batches:
        for lang, text, copies in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
            held.add(lang, text.as_py(), copies)
        if len(held) >= HELD:
            yield from held.rows()
            held = Tally()
    yield from held.rows()


def collapsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each different text of a language once, with its copies per source; and the groups that occur."""
    rows = docs.select(*(whole(F.col(c).cast("string")).alias(c) for c in ("text", "lang", "source")))
    marked = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    per_source = marked.groupBy("digest", "lang", "source").agg(F.count(F.lit(1)).alias("copies"))
    copies = per_source.groupBy("digest", "lang").agg(F.collect_list(F.struct("source", "copies")).alias("copies"))
    # Equal texts of a partition meet before the shuffle. Both sides are dealt by digest and language already.
    texts = marked.groupBy("digest", "lang").agg(F.first("text").alias("text"))
    once = texts.join(copies, ["digest", "lang"]).select("lang", F.col("text").cast("binary").alias("text"), "copies")
    return once, rows.select("lang", "source").distinct()


def summed(counted: DataFrame) -> DataFrame:
    """Terms (lang, term, docs, count, and sources, an array of source and count) of what tasks counted.

    Rows are dealt by language and term once, each with all sources that its task saw; both sums are made where they arrive.
    """
    entries = F.inline(F.arrays_zip("source", "docs", "count"))
    single = counted.repartition("lang", "term").select("lang", "term", entries)
    per_source = single.groupBy("lang", "term", "source").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))
    return per_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("count"),
        F.collect_list(F.struct("source", "count")).alias("sources"),
    )


def term_counts(docs: DataFrame, path: str, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Kept terms (lang, term, count and sources, an array of source and count), and groups (lang, source), both written."""
    once, groups = collapsed(docs)
    counted = kept_at(once.mapInArrow(_tally, COUNTED), f"{path}/counted")
    kept = summed(counted).where(F.col("docs") >= least).drop("docs")
    return kept_at(kept, f"{path}/terms"), kept_at(groups, f"{path}/groups")


def share(count: Column, total: Column, vocabulary: Column) -> Column:
    """p of a count; null without kept terms. The product needs more than 64 bits, so it is a decimal."""
    wide = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + (PRIOR * vocabulary).cast("decimal(20,0)")
    return F.when(vocabulary > 0, 1 + F.call_function("div", wide, below))


def apart(p: Column, q: Column) -> Column:
    """f of two shares."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(kept: DataFrame, groups: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """p of each kept term in each group it occurs in (lang, term, source, p, none, q), and none of each group; both written.

    ``none`` is the p of a term that the group does not hold, and q the p of the term in the language.
    """
    zero = F.lit(0).cast("long")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"), F.sum("count").alias("all"))
    single = kept.select("lang", "term", F.col("count").alias("everywhere"), F.inline("sources"))
    totals = single.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    known = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").withColumns({
        c: F.coalesce(c, zero) for c in ("total", "vocabulary", "all")
    })
    none = share(zero, F.col("total"), F.col("vocabulary")).alias("none")
    members = kept_at(known.select("lang", "source", "total", "vocabulary", "all", none), f"{path}/members")
    found = single.join(members, ["lang", "source"]).select(
        "lang", "term", "source", share(F.col("count"), F.col("total"), F.col("vocabulary")).alias("p"), "none",
        share(F.col("everywhere"), F.col("all"), F.col("vocabulary")).alias("q"),
    )
    return kept_at(found, f"{path}/shares"), members


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with the sources that hold them to the last of the four sums, one row per language and pair of sources."""
    langs, names, sums = Codes(), Codes(), Counter()

    def rows() -> pa.RecordBatch:
        lang, name = list(langs), list(names)
        keys = [(lang[k >> 42], name[k >> 21 & 0x1FFFFF], name[k & 0x1FFFFF]) for k in sums]
        columns = [*(list(zip(*keys)) if keys else [[]] * 3), list(sums.values())]
        kinds = [pa.string()] * 3 + [pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["lang", "a", "b", "value"]
        )

    for batch in batches:
        held = batch.column(1)
        entry, sizes = held.flatten(), np.diff(held.offsets.to_numpy())
        term = np.repeat(np.arange(len(sizes)), sizes)
        lang = np.repeat([langs[x] for x in batch.column(0).to_pylist()], sizes).astype(np.int64)
        source = np.array([names[x] for x in entry.field("source").to_pylist()], np.int64)
        p, none = (entry.field(c).to_numpy() for c in ("p", "none"))
        for k in range(1, int(sizes.max(initial=0))):
            for first in range(0, len(term) - k, SLICE):
                left = np.arange(first, min(first + SLICE, len(term) - k))
                left = left[term[left] == term[left + k]]
                right = left + k
                a, b, a0, b0 = p[left], p[right], none[left], none[right]
                value = _f(a, b) - _f(a, b0) - _f(a0, b) + _f(a0, b0)
                keys, at = np.unique(lang[left] << 42 | source[left] << 21 | source[right], return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, at, value)
                for key, v in zip(keys.tolist(), total.tolist()):
                    sums[key] += v
            if len(sums) >= HELD:
                yield rows()
                sums.clear()
        if len(names) >= HELD:
            yield rows()
            langs, names, sums = Codes(), Codes(), Counter()
    yield rows()


def pair_values(found: DataFrame, members: DataFrame) -> DataFrame:
    """f summed over all kept terms, for each pair of a language's sources (lang, a, b; a before b)."""
    a, b = members.alias("a"), members.alias("b")
    nowhere = a.join(b, F.col("a.lang") == F.col("b.lang")).where("a.source < b.source").select(
        "a.lang", F.col("a.source").alias("a"), F.col("b.source").alias("b"),
        F.coalesce(F.col("a.vocabulary") * apart(F.col("a.none"), F.col("b.none")), F.lit(0).cast("long")).alias("value"),
    )
    like = found.groupBy("lang", "source", "p", "none").agg(F.count(F.lit(1)).alias("n")).alias("x")
    change = apart(F.col("x.p"), F.col("b.none")) - apart(F.col("x.none"), F.col("b.none"))
    one = like.join(b, F.col("x.lang") == F.col("b.lang")).where("x.source <> b.source").select(
        "x.lang", F.least("x.source", "b.source").alias("a"), F.greatest("x.source", "b.source").alias("b"),
        (F.col("n") * change).alias("value"),
    )
    holders = F.array_sort(F.collect_list(F.struct("source", "p", "none"))).alias("holders")
    shared = found.groupBy("lang", "term").agg(holders).where(F.size("holders") > 1).select("lang", "holders")
    both = shared.mapInArrow(_both, BOTH)
    return nowhere.unionByName(one).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: each group's other sources (``pair``) and outstanding terms (``term``)."""
    path = scratch(docs.sparkSession, "source-audit")
    found, members = shares(*term_counts(docs, path, least), path)
    values = kept_at(pair_values(found, members), f"{path}/pairs")
    there = values.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    back = values.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    pairs = there.unionByName(back).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    rising = found.where("p > q").select("lang", "source", F.col("term").alias("item"), apart(F.col("p"), F.col("q")).alias("value"))
    # The planner keeps the best ``top`` of each task before it shuffles.
    best = rising.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.unionByName(best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
