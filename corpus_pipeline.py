"""From documents to token files: a filter, near-duplicate removal, decontamination, mixing and encoding in a row.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. A stage judges all that its predecessor kept:

* toxicity drops documents that score as toxic (learned from the labels that are not held out);
* near_dedup keeps the smallest id of each group of near duplicates (five words, similarity 0.8);
* decontaminate drops documents that hold a benchmark item (four fifths of its five-word shingles);
* mix returns each document as often as the mix takes its words (rounded), so not at all where a source has too many;
* tokens writes the store of token ids and returns its entries.

Stages that decide by document give each row a key of its own: its id, or, for rows without id and rows that repeat one, a
number that no id has, written once with the row. So such rows are documents like all others: each is judged by its own text,
and equal texts among them are near duplicates, of which one stays. Extra columns are passed on, whatever their names. An
empty table stays empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.llm import decontaminate, mixing, near_dedup, token_store, toxicity
from loadweave.llm.catalog import tokenizer_path
from loadweave.llm.common import kept_at, scratch, table
from loadweave.session import tune


class Keyed(NamedTuple):
    """Documents with a column that tells each row from all others."""

    docs: DataFrame
    key: str

    def without(self, keys: DataFrame) -> DataFrame:
        """The documents whose key is not among ``keys``, without the key."""
        left = self.docs.join(keys.select(keys[keys.columns[0]].alias(self.key)), self.key, "left_anti")
        return left.drop(self.key)


def keyed(docs: DataFrame, path: str) -> Keyed:
    """Rows that have no id, or one that other rows have, are written with their keys, so that these do not change."""
    name = f"row_{uuid.uuid4().hex}"
    counted = docs.groupBy(docs["doc_id"].cast("long").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    unsure = kept_at(counted.where("n > 1 OR id IS NULL").select("id"), f"{path}/unsure")
    own = docs["doc_id"].cast("long")
    if unsure.isEmpty():
        return Keyed(docs.withColumn(name, own), name)
    low, high = docs.agg(F.coalesce(F.min(own), F.lit(0)), F.coalesce(F.max(own), F.lit(0))).first()
    same, number = own.eqNullSafe(unsure["id"]), F.monotonically_increasing_id()
    if min(-low, high) >= 1 << 62:
        return Keyed(kept_at(docs.withColumn(name, number), f"{path}/numbered"), name)
    # Above all ids, so that of equal texts the one with an id stays; below them only if there is no room above.
    apart = F.lit(high + 1) + number if high < 1 << 62 else F.lit(low - 1) - number
    odd = kept_at(docs.join(unsure, same, "left_semi").withColumn(name, apart), f"{path}/odd")
    return Keyed(docs.join(unsure, same, "left_anti").withColumn(name, own).unionByName(odd), name)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marks = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), marks)
    if model.constant is not None:  # nothing was learned, so nothing is rejected
        return docs
    return docs.where(toxicity.scorer(model)(F.coalesce(docs["text"], F.lit(""))) < toxicity.THRESHOLD)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch(spark, "near-stage")
    rows = keyed(docs, path)
    found = near_dedup.near_duplicates(rows.docs, id_col=rows.key)
    return rows.without(kept_at(found.where(~F.col("kept")).select("doc_id"), f"{path}/dropped"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch(spark, "leak-stage")
    rows, items = keyed(docs, path), table(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.leaks(rows.docs, items, id_col=rows.key)
    return rows.without(kept_at(found.select("doc_id").distinct(), f"{path}/ids"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch(spark, "mix-stage")
    rows = keyed(docs, path)
    taken = mixing.taken_words(rows.docs, id_col=rows.key).where("size > 0").select(
        F.col("doc_id").alias(rows.key), F.round(F.col("taken") / F.col("size")).cast("int").alias("copies")
    )
    copies = kept_at(taken.where("copies > 0"), f"{path}/copies").alias("c")
    extra = f"copy_{uuid.uuid4().hex}"
    joined = rows.docs.alias("d").join(copies, F.col(f"d.{rows.key}") == F.col(f"c.{rows.key}"))
    return joined.select("d.*", F.explode(F.expr("array_repeat(0, c.copies)")).alias(extra)).drop(extra, rows.key)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-store")
    token_store.write_store(docs, folder, tokenizer_path("word_bpe_49k.json"))
    return token_store.read_store(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


#: Rows that travel between Spark and Python at once.
BATCH = "1000"


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage in small batches, also if it is run alone: each task holds one in the JVM and one in Python, and texts and
    sets of shingles are kilobytes a row."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, in_small_batches(stage)) for name, stage in (
    ("toxicity", drop_toxic), ("near_dedup", one_of_near_copies), ("decontaminate", drop_leaks), ("mix", to_target_weights),
    ("tokens", to_tokens),
)]

#: SQL cannot express the first stage; the tests compare the others with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    path = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = kept_at(stage(spark, docs, sf_dir), f"{path}/{name}")
    return docs
