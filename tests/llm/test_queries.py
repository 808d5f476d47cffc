"""The registered queries: equal to their SQL, and complete where SQL cannot express them."""

from __future__ import annotations

import zlib

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from compare import connect, difference
from loadweave.llm import catalog
from loadweave.llm.sql import STATEMENTS


@pytest.fixture(scope="module")
def duck(root):
    return connect(root)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equals_sql(spark, root, duck, name):
    assert difference(catalog.CATALOG[name](spark, root), duck, STATEMENTS[name]) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in contract.queries() if n == "pipeline" or n[:2] == "op" and n[2].isdigit()]
    assert sorted(n.split("_")[0] for n in names) == sorted([f"op{k}" for k in range(1, 14)] + ["pipeline"])


def test_token_store_against_the_library(spark, root, duck):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(catalog.tokenizer_path("word_bpe_49k.json"))
    start, want = 0, {}
    for doc_id, text in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[doc_id] = start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    got = {r[0]: tuple(r)[1:] for r in catalog.CATALOG["op5_token_store"](spark, root).collect()}
    assert got == want


def test_token_counts_against_the_library(spark, root, duck):
    from tokenizers import Tokenizer, models, pre_tokenizers

    from loadweave.llm.viterbi_count import vocabulary

    entries, unknown = vocabulary(catalog.tokenizer_path("piece_bpe_32k.model"))
    tokenizer = Tokenizer(models.Unigram(entries, unk_id=unknown, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    got = {r["doc_id"]: r["n_tokens"] for r in catalog.CATALOG["op10_viterbi_count"](spark, root).collect()}
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    assert got == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in rows}


def test_packing_against_the_library(spark, root, duck):
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(catalog.tokenizer_path("byte_bpe_50k.json"))
    pieces = catalog.CATALOG["op13_packing"](spark, root).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    assert by_doc.keys() == {i for i, _ in rows}
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024 and at & (at - 1) == 0  # nothing is padded


def test_toxicity_on_held_out_labels(spark, duck):
    root = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in catalog.CATALOG["op1_toxicity"](spark, root).collect()}
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    con = connect(root)
    # These documents' insults are English; toxic labels in other languages follow nothing in the text.
    marks = con.execute(
        "SELECT doc_id, toxic FROM labels JOIN documents USING (doc_id) WHERE lang = 'en'"
    ).fetchall()
    held = [(rows[i]["predicted"], t) for i, t in marks if rows[i]["held_out"]]
    found = sum(p and t for p, t in held)
    assert found / max(1, sum(p for p, _ in held)) > 0.95
    assert found / sum(t for _, t in held) > 0.85


def test_languages_are_found(spark, root, duck):
    rows = catalog.CATALOG["op2_language_id"](spark, root).collect()
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    docs = [r for r in rows if r["kind"] == "document"]
    assert sorted(r["doc_id"] for r in docs) == sorted(langs)
    assert sum(r["language"] == langs[r["doc_id"]] for r in docs) > 0.98 * len(docs)
    pages = dict(duck.execute("SELECT page_id, regexp_extract(html, 'lang=\"(..)', 1) FROM pages").fetchall())
    found = {r["page_id"]: r["language"] for r in rows if r["kind"] == "page"}
    assert found.keys() == pages.keys() and sum(found[i] == pages[i] for i in pages) > 0.98 * len(pages)


def test_main_texts_are_the_articles(spark, root, duck):
    import re
    from html import unescape

    rows = {r["page_id"]: r for r in catalog.CATALOG["op9_wrappers"](spark, root).collect()}
    pages = duck.execute("SELECT page_id, url, html FROM pages").fetchall()
    assert len(rows) == len(pages)
    for page_id, url, html in pages:
        body = re.sub(r"</?(?:p|h1)[^>]*>", "\0", re.search(r"<article>(.*?)</article>", html, re.S)[1])
        parts = (" ".join(unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in body.split("\0"))
        want = "\n".join(p for p in parts if p)
        assert rows[page_id]["text"] == want and rows[page_id]["n_chars"] == len(want) and rows[page_id]["url"] == url


def test_pipeline_runs_every_stage(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet")
    names = docs.columns
    folder = spark.conf.get("spark.checkpoint.dir")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, root)
        if name != "tokens":
            assert out.columns == names
        out.write.mode("overwrite").parquet(f"{folder}/stage-{name}")
        docs = spark.read.parquet(f"{folder}/stage-{name}")
        seen.append(docs.count())
    assert seen[0] > seen[1] > seen[2] >= seen[3] and seen[4] == seen[5] > 0
