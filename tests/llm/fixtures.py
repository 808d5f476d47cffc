"""Small tables with the cases that every operator must bear."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside; as extra columns of an input they must do no harm.
CLASHING = ["size", "kept", "root", "key", "keys", "s", "offset", "taken", "score", "x", "n", "start", "digest", "host"]


def prose(rng: random.Random, n: int, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(n))


def vocabulary(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def awkward(spark: SparkSession, extra: bool = True) -> DataFrame:
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows, clashing extra columns."""
    rng = random.Random(5)
    words = vocabulary(rng, 300)
    long = prose(rng, 30_000, words)
    base = prose(rng, 120, words)
    near = base.split()
    near[7] = "changed"
    rows = [
        (1, base, "en", "b", 1), (2, base, "en", "a", 1), (3, " ".join(near), "en", None, 1), (4, None, "fr", "a", None),
        (5, "", "fr", "b", 0), (6, " \n\t ", None, "c", 3), (7, "one", "de", "a", 3), (8, "one two", "de", "b", 7),
        (9, long, "es", "c", len(long)), (10, base.replace(" ", "  \n", 3), "en", "a", 1), (None, base, "en", "a", 1),
        (None, None, None, None, None), (11, "Ünïcode ß ñ 日本語 \U0001f600 é", "de", "\U0001f600", 3),
        (12, prose(rng, 80, words), "en", "b", 1), (12, None, "en", "b", 1), (13, base.upper(), "en", "c", 1),
    ]
    rows += [(14, "same row twice over here", "en", "b", 5)] * 2
    rows += [(20 + k, prose(rng, 60, words), "en", "abc"[k % 3], 1) for k in range(12)]
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    if extra:
        for name in CLASHING:
            frame = frame.selectExpr("*", f"'clash' AS `{name}`")
    return frame


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)
