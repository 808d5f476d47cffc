"""Test items inside training documents: size-partitioned MinHash containment search. DataFrame operations only.

An item is the set of its word shingles. It leaks into a document that holds at least the share ``threshold`` of them.
Jaccard similarity between a short item and a long document says nothing, so both sides are cut to like sizes. Items are
put into classes by size, doubling from class to class. For a class of at most u shingles a document is read in windows
of 2u shingles, a new one each u, so every run of u shingles lies inside one window, and an item that leaks has a
Jaccard similarity of at least 0.8 x 0.5 / (0.5 + 2 - 0.4) = 0.19 with it (0.8 containment, least size of the class). Signatures
of ``HASHES`` minima, one band each, then miss it with a chance of (1 - 0.19)^48 = 0.00004 at worst, and of less than
1e-9 for a whole item. Candidates are verified by exact containment of the shingles, as words, in the whole document.

Minima are taken under random exclusive-or masks over 64-bit shingle hashes. A window can share a minimum with an item
only if it holds the very shingle that is the item's minimum. So documents are first searched for those shingles
(an equality join that emits a document number and a position, never text), and only windows around them get a
signature; the result is that of signing every window.

Defined results: words are runs of anything but ASCII white space, A-Z in lower case. A text with fewer words than a
shingle has is one shingle; one without words, or null, has none and never matches. Rows that share an id, and rows
without one, are read as one document (or item), so a repeated row changes nothing. Empty tables give no rows. Only id
and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import discard, kept_at, lowered, scratch, whole, words

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 48


def shingles(text: Column, n: int = SHINGLE) -> Column:
    """All shingles of a text in order, each an array of words."""
    def cut(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.slice(w, i, n))
        return F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(w)).otherwise(
            F.array().cast("array<array<string>>")
        )

    # One element to transform: the words are split once, and named once.
    return F.flatten(F.transform(F.array(words(lowered(whole(text)))), cut))


def mask(k: Column) -> Column:
    """The k-th random mask."""
    return F.xxhash64(k, F.lit("mask"))


def item_sets(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = SHINGLE) -> DataFrame:
    """item_id, x (hash), shingle, n_item (number of distinct shingles), u (upper size of the class)."""
    one = items.select(
        F.col(id_col).cast("long").alias("item_id"), F.explode(shingles(F.col(text_col), n)).alias("shingle")
    ).distinct()
    size = one.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item")).withColumn(
        "u", F.pow(F.lit(2), F.ceil(F.log2(F.col("n_item")))).cast("long")
    )
    return one.join(size.withColumnRenamed("item_id", "_id"), F.col("item_id").eqNullSafe(F.col("_id"))).select(
        "item_id", F.xxhash64("shingle").alias("x"), "shingle", "n_item", "u"
    )


def item_signatures(sets: DataFrame, hashes: int = HASHES) -> DataFrame:
    """item_id, u, k, least (the masked minimum), x (the shingle it belongs to)."""
    k = F.explode(F.sequence(F.lit(0), F.lit(hashes - 1)))
    masked = sets.select("item_id", "u", "x", k.alias("k")).withColumn("masked", F.col("x").bitwiseXOR(mask(F.col("k"))))
    return masked.groupBy("item_id", "u", "k").agg(F.min("masked").alias("least"), F.min_by("x", "masked").alias("x"))


def touched_windows(docs: DataFrame, signatures: DataFrame, n: int = SHINGLE) -> DataFrame:
    """doc_id, u, w: windows that hold a shingle at which an item of the class has a minimum.

    Window w of class u is the shingles from w * u up to (w + 2) * u.
    """
    marks = signatures.select("x", "u").distinct()
    hashed = F.transform(shingles(F.col("text"), n), lambda s: F.xxhash64(s))
    found = docs.select("doc_id", F.posexplode(hashed).alias("at", "x")).join(marks, "x")
    cell = F.floor(F.col("at") / F.col("u"))
    near = F.when(cell > 0, F.array(cell - 1, cell)).otherwise(F.array(cell))
    return found.select("doc_id", "u", F.explode(near).alias("w")).distinct()


def candidates(texts: DataFrame, windows: DataFrame, signatures: DataFrame, n: int, hashes: int) -> DataFrame:
    """item_id, doc_id: pairs that share a minimum in some window."""
    per_doc = windows.withColumnRenamed("doc_id", "_id")
    hashed = texts.select("doc_id", F.transform(shingles(F.col("text"), n), lambda s: F.xxhash64(s)).alias("xs"))
    cut = hashed.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id"))).select(
        "doc_id", "u", F.slice("xs", (F.col("w") * F.col("u") + 1).cast("int"), (2 * F.col("u")).cast("int")).alias("xs"),
        F.explode(F.sequence(F.lit(0), F.lit(hashes - 1))).alias("k"),
    )
    signed = cut.withColumn("m", mask(F.col("k"))).select(
        "doc_id", "u", "k", F.array_min(F.transform("xs", lambda x: x.bitwiseXOR(F.col("m")))).alias("least")
    )
    return signed.join(signatures.select("item_id", "u", "k", "least"), ["u", "k", "least"]).select(
        "item_id", "doc_id"
    ).distinct()


def leaks(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE, hashes: int = HASHES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """A row per leaked item and document: item_id, doc_id, n_item, n_shared, containment."""
    path = scratch(docs.sparkSession, "leaks")
    sets = kept_at(item_sets(items, item_col, item_text, n), f"{path}/items")
    signatures = kept_at(item_signatures(sets, hashes), f"{path}/signatures")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    windows = kept_at(touched_windows(rows, signatures, n), f"{path}/windows")
    ids = windows.select(F.col("doc_id").alias("_id")).distinct()
    texts = kept_at(rows.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"), f"{path}/texts")
    pairs = candidates(texts, windows, signatures, n, hashes).select(F.col("item_id").alias("_i"), F.col("doc_id").alias("_d"))
    held = texts.select("doc_id", F.explode(shingles(F.col("text"), n)).alias("shingle"))
    held = held.select("doc_id", F.xxhash64("shingle").alias("x"), "shingle")
    # The items' shingles first: few rows of a document are left before its copies are removed.
    shared = held.join(sets, ["x", "shingle"]).select("item_id", "doc_id", "x", "shingle", "n_item").distinct()
    counted = shared.groupBy("item_id", "doc_id", "n_item").agg(F.count(F.lit(1)).alias("n_shared"))
    sure = counted.join(
        pairs, F.col("item_id").eqNullSafe(F.col("_i")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left_semi"
    )
    found = sure.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item")).select(
        "item_id", "doc_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment")
    )
    found = kept_at(found, f"{path}/found")
    discard(docs.sparkSession, path, "items", "signatures", "windows", "texts")
    return found
