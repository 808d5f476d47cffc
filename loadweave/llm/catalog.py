"""The subpackage's queries by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.llm import (
    arc_to_warc, decontaminate, exact_dedup, language_id, mixing, merkle, near_dedup, packing, source_audit,
    token_store, toxicity, viterbi_count, wrappers,
)
from loadweave.llm.common import scratch, table
from loadweave.llm.sql import STATEMENTS
from loadweave.session import tune

CATALOG: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    CATALOG[function.__name__] = function
    return function


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of each document, learned from the labels that are not held out."""
    docs = table(tune(spark), sf_dir, "documents", "doc_id", "text")
    return toxicity.judged(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document and page; the text model learns from documents with a language."""
    docs = table(tune(spark), sf_dir, "documents", "doc_id", "text", "lang", "source")
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    rows = language_id.of_documents(docs).unionByName(language_id.of_pages(pages))
    found = language_id.identify(rows, language_id.train(docs))
    ids = [F.when(F.col("kind") == kind, F.col("id")).alias(name) for kind, name in (("document", "doc_id"), ("page", "page_id"))]
    return found.select("kind", *ids, "language", "confidence", "text_language")


@query
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes from each document."""
    docs = table(tune(spark), sf_dir, "documents", "doc_id", "text", "source")
    return mixing.taken_words(docs).drop("source")


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold."""
    docs = table(tune(spark), sf_dir, "documents", "doc_id", "text")
    return decontaminate.leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token ids and read back from the files."""
    folder = scratch(tune(spark), "token-store")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    token_store.write_store(docs, folder, tokenizer_path("word_bpe_49k.json"))
    return token_store.read_store(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The winner of each document's group of equal texts."""
    return exact_dedup.deduplicate(table(tune(spark), sf_dir, "documents", "doc_id", "text"))


@query
def op7_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC and WARC, as read back from the WARC files."""
    pages = table(tune(spark), sf_dir, "pages", "page_id", "url", "html")
    return arc_to_warc.archive_pages(spark, pages, scratch(spark, "archives"))


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near duplicates that each document is in."""
    docs = table(tune(spark), sf_dir, "documents", "doc_id", "text")
    return near_dedup.near_duplicates(docs, n=3, percent=85)


@query
def op9_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    return wrappers.extract(table(tune(spark), sf_dir, "pages", "page_id", "url", "html"))


@query
def op10_viterbi_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of each document."""
    docs = table(tune(spark), sf_dir, "documents", "doc_id", "text")
    return viterbi_count.count_tokens(docs, tokenizer_path("piece_bpe_32k.model"))


@query
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each language's sources lie apart, and the terms that set a source apart."""
    return source_audit.audit(table(tune(spark), sf_dir, "documents", "text", "lang", "source"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of each document, folded again after every second document was tampered with."""
    docs = table(tune(spark), sf_dir, "documents", *merkle.FIELDS)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    altered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select("doc_id", "source", merkle.leaf(docs).alias("leaf"), merkle.leaf(docs, text=altered).alias("shown"))
    manifest = merkle.build(leaves, scratch(spark, "manifest"), order=["doc_id", "leaf", "shown"])
    found = merkle.proofs(manifest).select(
        "row.doc_id", "row.leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"),
        merkle.folded("row.shown").alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in the sequences they are packed into."""
    docs = table(tune(spark), sf_dir, "documents", "doc_id", "text")
    pieces = packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def oracle_sql() -> dict[str, str]:
    return {name: text for name, text in STATEMENTS.items() if name in CATALOG}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(CATALOG)
