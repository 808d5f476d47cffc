"""Language of texts by Bayesian fusion of evidence.

For each row the log likelihood of its text under each language (byte trigrams, learned from a bounded sample of labelled
texts) is combined with

* the language its markup declares: the chance of each declaration given the language,
* a prior of its host, smoothed towards its domain, that towards its address suffix, that towards all rows.

Declarations and priors are not given but counted, by grouped aggregation of the text posteriors of all rows; a row's own
vote is taken out of its host's, domain's and suffix's counts, so that nothing votes for itself. Counting combines before its
shuffle, and what is joined by host are narrow rows without text, so a host with a third of all rows is harmless.

Neighbouring trigrams repeat each other, so a text's likelihood counts as that of at most ``WORTH`` independent ones;
short texts lean on the other evidence.

Defined results: null and empty texts, undeclared languages and rows without host bring no evidence of that kind; a row with
none at all gets the overall prior. Without any labelled text the language is null. Ties go to the first language by
name. Repeated rows each vote and each return. Empty tables give no rows. Columns that are not named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import host_of, kept_at, scratch, whole

#: Labelled texts learned from, chosen by a hash of their ids.
SAMPLE = 4_000
BUCKETS = 1 << 16
WORTH = 60.0
#: Rows that the level above counts as, at each level of the prior and in the chance of declarations.
STRENGTH = 5.0

_MARKUP = re.compile(r"<(script|style)\b.*?(?:</\1\s*>|$)|<!--.*?(?:-->|$)|<[^>]*>", re.S | re.I)
_MIX = np.array([1, 257, 65_537 * 31], dtype=np.uint32)


def visible(html: str) -> str:
    """A page's text without markup, scripts and styles (references stay as they are)."""
    return _MARKUP.sub(" ", html)


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a text in lower case, white space as one space."""
    data = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    codes = (data[:-2] * _MIX[0] + data[1:-1] * _MIX[1] + data[2:] * _MIX[2]) * np.uint32(2_654_435_761)
    return (codes >> np.uint32(16)).astype(np.int64)


class TrigramModel:
    """Log probability of each bucket under each language, from how often each occurs there."""

    def __init__(self, languages: list[str], seen: np.ndarray):
        self.languages = languages
        counts = seen + 0.1
        self.table = np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32).copy()

    def evidence(self, text: str) -> np.ndarray:
        """Log likelihoods, tempered to at most ``WORTH`` trigrams."""
        codes = trigrams(text)
        if not len(codes):
            return np.zeros(len(self.languages))
        total = sum(self.table[codes[k: k + 65_536]].sum(axis=0, dtype=np.float64) for k in range(0, len(codes), 65_536))
        return total * (WORTH / (WORTH + len(codes)))


def train(docs: DataFrame, sample: int = SAMPLE) -> TrigramModel | None:
    """A model from at most ``sample`` rows of ``docs`` (doc_id, text, lang) with a language; None without any.

    Texts are counted where they are; the driver gets a number for each bucket of each language. Of rows with one id the least counts.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    ids = labelled.select("doc_id", F.xxhash64("doc_id", F.lit("language")).alias("rank")).orderBy("rank", "doc_id").limit(sample)
    picked = F.broadcast(ids.select("doc_id").distinct())  # at most ``sample`` numbers
    rows = labelled.join(picked, "doc_id").groupBy("doc_id").agg(F.min(F.struct("lang", whole("text").alias("text"))).alias("one"))
    counted = rows.select("one.lang", "one.text").mapInArrow(_count, "lang string, bucket int, n long")
    seen = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(seen):
        return None
    languages = sorted(seen["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    real = seen[seen["bucket"] >= 0]
    place = {name: k for k, name in enumerate(languages)}
    counts[real["lang"].map(place).to_numpy(int), real["bucket"].to_numpy(int)] = real["n"].to_numpy(float)
    return TrigramModel(languages, counts)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each bucket occurs in the texts of each language; bucket -1 names a language, which may have no trigrams."""
    for batch in batches:
        seen: dict[str, np.ndarray] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            codes = trigrams(text.as_py())
            seen[lang] = seen.get(lang, 0) + np.bincount(codes, minlength=BUCKETS)
        for lang, counts in seen.items():
            buckets = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * (len(buckets) + 1), pa.string()), pa.array(np.append(-1, buckets), pa.int32()),
                pa.array(np.append(0, counts[buckets]), pa.int64()),
            ], names=["lang", "bucket", "n"])


def of_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Rows of evidence for plain texts; their source stands for a host."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.lit("document").alias("kind"), F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"),
        F.col(host_col).cast("string").alias("host"), none.alias("declared"),
    )


def of_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows of evidence for web pages: host of the address, language that the html element declares."""
    html = whole(html_col)
    declared = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))
    return pages.select(
        F.lit("page").alias("kind"), F.col(id_col).cast("long").alias("id"), html.alias("text"),
        F.nullif(host_of(F.col(url_col)), F.lit("")).alias("host"), F.nullif(declared, F.lit("")).alias("declared"),
    )


def text_evidence(rows: DataFrame, model: TrigramModel) -> DataFrame:
    """The rows with a column of tempered log likelihood for each language instead of the text."""
    names = [f"e{k}" for k in range(len(model.languages))]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([
                model.evidence(visible(t.as_py()) if kind.as_py() == "page" else t.as_py())
                for kind, t in zip(batch.column(0), batch.column(4))
            ]).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(4)] + [pa.array(c) for c in found.T], names=["kind", "id", "host", "declared", *names]
            )

    kinds = ", ".join(f"{n} double" for n in names)
    return rows.select("kind", "id", "host", "declared", "text").mapInArrow(
        look, f"kind string, id long, host string, declared string, {kinds}"
    )


def _softmax(values: list[Column]) -> list[Column]:
    top = F.greatest(*values) if len(values) > 1 else values[0]
    powers = [F.exp(v - top) for v in values]
    total = sum(powers[1:], powers[0])
    return [p / total for p in powers]


def fuse(evidence: DataFrame, n: int, path: str) -> DataFrame:
    """kind, id, text posteriors t0..., and posteriors p0... of all evidence."""
    e, t = [F.col(f"e{k}") for k in range(n)], [f"t{k}" for k in range(n)]
    name = F.coalesce("host", F.lit(""))
    rows = evidence.withColumns(dict(zip(t, _softmax(e)))).withColumns({
        "domain": F.regexp_extract(name, r"[^.]*\.?[^.]*$", 0), "suffix": F.regexp_extract(name, r"\.([^.]+)$", 1),
    })
    rows = rows.withColumns({c: F.concat_ws("/", "kind", F.coalesce(c, F.lit(""))) for c in ("host", "domain", "suffix", "declared")})
    rows = kept_at(rows, f"{path}/rows")

    def counts(key: str) -> DataFrame:
        """The text posteriors of all rows with one key, added up."""
        added = rows.groupBy(key).agg(*(F.sum(c).alias(f"{key}_{c}") for c in t), F.count(F.lit(1)).alias(f"{key}_n"))
        return kept_at(added, f"{path}/{key}")

    joined = rows
    for key in ("host", "domain", "suffix", "declared"):
        joined = joined.join(counts(key), key)
    totals = rows.agg(*(F.sum(c).alias(c) for c in t), F.count(F.lit(1)).alias("n")).first()
    every = totals["n"] or 0
    overall = [((totals[c] or 0.0) + STRENGTH / n) / (every + STRENGTH) for c in t]
    prior = [F.lit(p) for p in overall]
    for key in ("suffix", "domain", "host"):
        others = F.col(f"{key}_n") - 1
        prior = [
            (F.greatest(F.col(f"{key}_{c}") - F.col(c), F.lit(0.0)) + STRENGTH * p) / (others + STRENGTH) for c, p in zip(t, prior)
        ]
    # Chance of this declaration given a language, relative to its share among all rows; 1 where nothing is declared.
    said = ~F.col("declared").endswith("/")
    share = (F.col("declared_n") - 1 + STRENGTH * 0.01) / (every + STRENGTH * 0.01)
    chance = [
        F.when(said, (F.greatest(F.col(f"declared_{c}") - F.col(c), F.lit(0.0)) + STRENGTH * share) / (every * p + STRENGTH)).otherwise(1.0)
        for c, p in zip(t, overall)
    ]
    fused = _softmax([x + F.log(p) + F.log(c) for x, p, c in zip(e, prior, chance)])
    return joined.select("kind", "id", *t, *(p.alias(f"p{k}") for k, p in enumerate(fused)))


def identify(rows: DataFrame, model: TrigramModel | None) -> DataFrame:
    """kind, id, language, confidence, text_language of each row of evidence."""
    if model is None:
        none = F.lit(None)
        return rows.select(
            "kind", "id", none.cast("string").alias("language"), none.cast("double").alias("confidence"),
            none.cast("string").alias("text_language"),
        )
    path, n = scratch(rows.sparkSession, "language"), len(model.languages)
    fused = fuse(kept_at(text_evidence(rows, model), f"{path}/evidence"), n, path)

    def best(prefix: str) -> tuple[Column, Column]:
        top = F.greatest(*(F.col(f"{prefix}{k}") for k in range(n))) if n > 1 else F.col(f"{prefix}0")
        return F.coalesce(*(F.when(F.col(f"{prefix}{k}") == top, F.lit(m)) for k, m in enumerate(model.languages))), top

    return fused.select(
        "kind", "id", best("p")[0].alias("language"), best("p")[1].alias("confidence"), best("t")[0].alias("text_language")
    )
