"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; and brute force on small tables."""

from __future__ import annotations

import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from fixtures import awkward, empty, prose, vocabulary
from loadweave.llm import (
    arc_to_warc, decontaminate, exact_dedup, language_id, mixing, near_dedup, token_store, toxicity, viterbi_count, wrappers,
)
from loadweave.llm.catalog import tokenizer_path
from loadweave.llm.common import scratch
from loadweave.llm.components import components
from loadweave.llm.shingle_sets import band_keys, jaccard_counts, min_max, shingle_sets

LABELS = "doc_id long, toxic int"
PAGES = "page_id long, url string, html string"


def listed(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(low)
    return {tuple(w[i: i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


# --- exact dedup ---


def test_exact_dedup_by_brute_force(spark):
    docs = awkward(spark)
    groups: dict[str, list] = {}
    for r in docs.collect():
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "").encode()).hexdigest()
        groups.setdefault(key, []).append(r["doc_id"])
    want = []
    for key, ids in groups.items():
        best = min((i for i in ids if i is not None), default=None)
        want += [(i, best, len(ids), i == best, key) for i in ids]
    for split in (None, -1, 8, 10**6):
        got = exact_dedup.deduplicate(docs, split=split)
        assert listed(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.deduplicate(empty(spark)).count() == 0


@given(st.integers(0, 3_000), st.integers(0, 2**32))
@settings(max_examples=20, deadline=None)
def test_perfect_hash_is_minimal_and_perfect(n, seed):
    raw = np.random.default_rng(seed).integers(0, 256, (n, 32), dtype=np.uint8)
    table, _ = exact_dedup.PerfectHash.build(raw)
    assert sorted(table.slots(raw).tolist()) == list(range(n))


def test_digests_that_no_level_can_part_are_still_found():
    import pandas as pd

    raw = np.zeros((5, 32), np.uint8)
    raw[:, 31] = range(5)  # equal first halves: every level sees one key
    rows = pd.DataFrame({"digest": [r.tobytes() for r in raw], "winner": [5, 4, 3, 2, 1], "n": [1] * 5})
    index = exact_dedup._build_bucket((0,), rows)
    found = exact_dedup._look_up(index, pd.DataFrame({"digest": [raw[2].tobytes(), b"x" * 32], "winner": [9, 8], "n": [4, 1]}))
    got = {bytes(d): (k, n) for d, k, n in found.itertuples(index=False)}
    assert got[raw[2].tobytes()] == (3, 5) and got[b"x" * 32] == (8, 1) and len(got) == 6


# --- token store ---


def test_token_store_round_trip(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    tokenizer, docs, folder = Tokenizer.from_file(path), awkward(spark), scratch(spark, "tokens")
    token_store.write_store(docs, folder, path)
    got = token_store.read_store(spark, folder).collect()
    want = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want[r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered[:-1]]).tolist()
    assert [r["doc_id"] or 0 for r in ordered] == sorted(r["doc_id"] or 0 for r in ordered)
    assert {r["doc_id"] for r in token_store.read_store(spark, folder, {9, 4}).collect()} == {9, 4}
    again = scratch(spark, "tokens")  # rows that share an id, or have none, stand in the same order
    token_store.write_store(docs.repartition(7), again, path)
    place = lambda rows: sorted((r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert place(token_store.read_store(spark, again).collect()) == place(got)
    nothing = scratch(spark, "tokens")
    token_store.write_store(empty(spark), nothing, path)
    assert token_store.read_store(spark, nothing).count() == 0


@given(st.lists(st.text(max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_in_a_row_encode_as_the_whole_text(texts):
    import re as regex

    encoder = token_store.encoder(tokenizer_path("word_bpe_49k.json"))
    for text in texts:
        text = regex.sub("[\ud800-\udfff]", "", text)
        want = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode(text.encode()) == want


def shard(entries):
    out = io.BytesIO()
    writer = token_store.ShardWriter(out)
    for doc_id, ids in entries:
        writer.add(doc_id, ids)
    writer.close()
    return out.getvalue()


def test_seekable_frames(tmp_path):
    import pyarrow as pa
    import zstandard

    docs = [(3, b"\1\0\0\0" * 50), (9, b""), (None, b"\2\0\0\0")]
    data = shard(docs)
    file = pa.OSFile
    (tmp_path / "s.zst").write_bytes(data)
    with file(str(tmp_path / "s.zst")) as f:
        assert [(d, i) for _, d, _, i in token_store.read_frames(f)] == [(3, docs[0][1]), (9, b""), (token_store.NO_ID, docs[2][1])]
        assert [b for _, _, b, _ in token_store.read_frames(f, {9})] == [50]
    # Any zstandard decoder reads the frames from end to end.
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain == b"".join(i for _, i in docs)
    for at in (10, len(data) - 30):
        broken = bytearray(data)
        broken[at] ^= 0xFF
        (tmp_path / "b.zst").write_bytes(broken)
        with file(str(tmp_path / "b.zst")) as f, pytest.raises(Exception):
            list(token_store.read_frames(f))


# --- token counts ---


def small_unigram():
    return [("<unk>", 0.0), ("▁", -2.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("ba", -4.0), ("aba", -6.0), ("▁a", -4.0), ("bb", -3.5)]


@given(st.lists(st.text(alphabet="ab cé日", max_size=30), max_size=10))
@settings(max_examples=80, deadline=None)
def test_counts_follow_the_tokenizers_rules(texts):
    from tokenizers import Tokenizer, models, pre_tokenizers

    for fallback in (False, True):
        entries = small_unigram() + [(f"<0x{b:02X}>", -9.0) for b in range(256) if fallback]
        tokenizer = Tokenizer(models.Unigram(entries, unk_id=0, byte_fallback=fallback))
        tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
        counter = viterbi_count.UnigramCounter(entries, 0)
        for text in texts:
            assert counter.total(text)[1] == len(tokenizer.encode(text, add_special_tokens=False).ids), text


def test_counts_of_awkward_texts(spark, monkeypatch):
    from tokenizers import Tokenizer, models, pre_tokenizers

    model = tokenizer_path("piece_bpe_32k.model")
    entries, unknown = viterbi_count.vocabulary(model)
    tokenizer = Tokenizer(models.Unigram(entries, unk_id=unknown, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    docs = awkward(spark)
    want = sorted(((r["doc_id"], len(tokenizer.encode(r["text"] or "").ids)) for r in docs.collect()), key=repr)
    assert listed(viterbi_count.count_tokens(docs, model), "doc_id", "n_tokens") == want
    assert viterbi_count.count_tokens(empty(spark), model).count() == 0
    monkeypatch.setattr(viterbi_count, "CACHED_PIECES", 3)  # a full cache changes nothing
    counter = viterbi_count.UnigramCounter(entries, unknown)
    for r in docs.collect():
        assert counter.total(r["text"] or "")[1] == len(tokenizer.encode(r["text"] or "").ids)


# --- archives ---


def test_archives_of_awkward_pages(spark):
    rows = [
        (1, "http://a.org/x y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b.org", None), (None, "http://c.org", "<p>one</p>"),
        (4, "http://d.org/ü", ""), (5, "http://e.org", "HTTP/1.1 200 OK\r\n\r\nüß"), (5, "http://e.org", "HTTP/1.1 200 OK\r\n\r\nüß"),
        (6, "http://f.org", "x" * 300_000), (7, "http://g.org", "\r\n\r\nWARC/1.1\r\n"),
    ]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'clash' AS name", "1 AS at", "'x' AS file").repartition(2)
    got = arc_to_warc.archive_pages(spark, pages, scratch(spark, "archives"))
    import base64

    best: dict[str, list] = {}
    for i, _, html in rows:
        digest = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        best.setdefault(digest, []).append(i)
    want = []
    for i, _, html in rows:
        digest = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        top = max(x for x in best[digest] if x is not None)
        want.append((i, len((html or "").encode()), digest, top))
    assert listed(got.selectExpr("*", "coalesce(refers_to, page_id) AS top"), "page_id", "payload_bytes", "payload_digest", "top") == sorted(want, key=repr)
    # One response for each payload, also where a row is repeated.
    assert Counter(r["payload_digest"] for r in got.collect() if r["record_type"] == "response") == Counter(best.keys())
    large = arc_to_warc.archive_pages(spark, pages, scratch(spark, "archives"), min_bytes=11)
    assert sum(r["record_type"] == "revisit" for r in large.collect()) == 1
    assert arc_to_warc.archive_pages(spark, spark.createDataFrame([], PAGES), scratch(spark, "archives")).count() == 0


def test_arc_versions_are_read_by_their_own_fields():
    for version in (1, 2):
        head = arc_to_warc.arc_head("x.arc", version, "19990102030405")
        record = arc_to_warc.arc_record(version, "x.arc", "http://a.org/", "1999", 7, b"body")
        dns = arc_to_warc._arc_line(version, "dns:a.org", "1.2.3.4", "20000101", "text/dns", "x.arc", 3) + b"a b\n"
        records = list(arc_to_warc.arc_records(io.BytesIO(head + record + dns)))
        assert [f["URL"] for _, f, _ in records] == ["filedesc://x.arc", "http://a.org/", "dns:a.org"]
        assert arc_to_warc.http_parts(records[1][2])[1] == b"body" and ("Result-code" in records[1][1]) == (version == 2)
        made = [arc_to_warc.convert_record("x.arc", a, f, c, None) for a, f, c in records]
        fields = [f for f, _ in arc_to_warc.warc_records(io.BytesIO(b"".join(made)))]
        assert [f["warc-type"] for f in fields] == ["warcinfo", "response", "response"]
        assert fields[1]["warc-date"] == "1999-01-01T00:00:00Z" and len({f["warc-record-id"] for f in fields}) == 3
    with pytest.raises(ValueError):
        list(arc_to_warc.arc_records(io.BytesIO(head + record[:-3])))
    with pytest.raises(ValueError):
        list(arc_to_warc.arc_records(io.BytesIO(record)))


# --- near duplicates ---


def brute_components(docs, n, percent):
    sets: dict = {}
    for r in docs:
        if r["doc_id"] is not None:
            sets.setdefault(r["doc_id"], []).append(shingles(r["text"], n))
    ids, up = sorted(sets), {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_near_duplicates_by_brute_force(spark, n, percent):
    rng = random.Random(n)
    vocab = vocabulary(rng, 400)
    rows, i = [], 100
    for _ in range(12):  # families whose members differ by more and more words, and chains of copies of copies
        base = prose(rng, rng.choice([6, 20, 60, 200]), vocab).split()
        for _ in range(rng.choice([1, 5, 30])):
            one = list(base)
            for _ in range(rng.randint(0, max(1, len(one) // 12))):
                one[rng.randrange(len(one))] = rng.choice(vocab)
            if rng.random() < 0.3:
                base = one
            rows.append((i, " ".join(one), "en", "a", 1))
            i += 1
    docs = awkward(spark, extra=False).unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    docs = docs.selectExpr("*", "'clash' AS key", "'clash' AS keys", "1 AS rep", "2 AS root", "3 AS band")
    got = near_dedup.near_duplicates(docs, n=n, percent=percent).collect()
    held = docs.collect()
    assert len(got) == len(held)
    want = brute_components(held, n, percent)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
    sizes = Counter((r["doc_id"], len(shingles(r["text"], n))) for r in held)
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_large_buckets_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(3)
    vocab = vocabulary(rng, 300)
    base = prose(rng, 100, vocab).split()
    rows = []
    for i in range(90):
        one = list(base)
        for _ in range(rng.randint(0, 9)):
            one[rng.randrange(len(one))] = rng.choice(vocab)
        rows.append((i, " ".join(one)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, n=3, percent=85).collect()}
    assert got == brute_components(docs.collect(), 3, 85)


def test_links_that_miss_a_buckets_smallest_are_searched_in_all_bands(spark, monkeypatch):
    """Each pair shares one band alone, with a third set that is far from both and smallest in the bucket."""
    import pandas as pd

    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    sets = {i: set(range(1_000 * i, 1_000 * i + 20)) for i in range(1, 25)}
    sets |= {i + 100: set(sorted(s)[:-1]) for i, s in sets.items()} | {i - 100: {10**6 + i} for i in sets}
    meets = spark.createDataFrame(pd.DataFrame(
        [(k, k - 1, d) for k in range(1, 25) for d in (k - 100, k, k + 100)], columns=["key", "band", "doc_id"]
    ))
    held = [(d, np.array(sorted(s), "<u8").tobytes()) for d, s in sets.items()]
    comps = spark.createDataFrame([], "node long, root long")
    found = near_dedup._cross_links(meets, comps, spark.createDataFrame(held, "doc_id long, shingles binary"), 85)
    assert {tuple(sorted((r["a"], r["b"]))) for r in found.collect()} == {(k, k + 100) for k in range(1, 25)}


def test_groups_outside_the_largest_component_are_bounded(spark, monkeypatch):
    """No block has more than a chunk of residents and one of visitors."""
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    seen = spark.sparkContext.accumulator(0)

    def searcher(percent):
        def search(batches):
            sizes = Counter((r["key"], r["block"]) for b in batches for r in b.to_pylist())
            seen.add(sum(n > 80 for n in sizes.values()))
            yield from ()

        return search

    monkeypatch.setattr(near_dedup, "_block_searcher", searcher)
    meets = spark.createDataFrame([(7, i) for i in range(400)], "key long, doc_id long").selectExpr("*", "0 AS band")
    sets = spark.createDataFrame([(i, bytes(8)) for i in range(400)], "doc_id long, shingles binary")
    near_dedup._cross_links(meets, spark.createDataFrame([], "node long, root long"), sets, 85).count()
    assert seen.value == 0


def test_short_near_copies_are_found_without_chance(spark):
    """Sets of seven shingles and six of them: a difference alone in its half of the hashes must not hide a pair."""
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.getrandbits(40)}" for _ in range(9)) for _ in range(1_000)]
    rows = [(2 * i + k, t.rsplit(" ", 1)[0] if k else t) for i, t in enumerate(texts) for k in (0, 1)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - i % 2 for i, _ in rows}


def test_rarest_shingles_by_brute_force(spark, tmp_path):
    """All pairs of short sets that are similar, and no band, so that nothing else can find them."""
    rng = random.Random(12)
    sets = {}
    for i in range(300):
        base = set(sets[rng.randrange(i)]) if i and rng.random() < 0.8 else {rng.randrange(400) for _ in range(rng.randint(1, 78))}
        for _ in range(rng.randint(0, 6)):
            base = (base - {rng.choice(sorted(base))}) | {rng.randrange(400)}
        sets[i] = sorted(base)[:78]
    frame = spark.createDataFrame(
        [(i, bytes([i % 256, i // 256]), len(s), s) for i, s in sets.items()],
        "doc_id long, set_key binary, n_shingles long, few array<long>",
    )
    for percent in (80, 85):
        keys: dict = {}
        for r in near_dedup.rarest(frame, percent, str(tmp_path)).collect():
            keys.setdefault(r["doc_id"], set()).add(r["key"])
        for a in sets:
            for b in range(a):
                x, y = set(sets[a]), set(sets[b])
                if 100 * len(x & y) >= percent * len(x | y):
                    assert keys.get(a, set()) & keys.get(b, set())


def test_permutations_weigh_shingles_alike():
    """Over all bands, sets agree as often as their similarity says, and no pair of similar sets differs in every band."""
    rng = np.random.default_rng(13)
    agree, missed = 0, 0
    for _ in range(1_500):
        v = rng.integers(0, 2**64, 20, dtype=np.uint64)
        one, two = (band_keys(min_max(x, 48)[None], 24)[0] for x in (v[:18], v[2:]))
        agree, missed = agree + (one == two).mean(), missed + (one != two).all()
    assert missed == 0 and abs(agree / 1_500 - (16 * 15 / 20 / 19) ** 2) < 0.01


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


@given(st.lists(st.text(alphabet="ab \n\tÄä", max_size=60), max_size=8), st.integers(1, 5))
@settings(max_examples=60, deadline=None)
def test_hashed_sets_are_the_sets(texts, n):
    hashed = list(shingle_sets(texts, n))
    real = [shingles(t, n) for t in texts]
    assert [len(h) for h in hashed] == [len(r) for r in real]
    for i in range(len(texts)):
        for j in range(i):
            assert jaccard_counts(hashed[i], hashed[j]) == (len(real[i] & real[j]), len(real[i] | real[j]))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 180)] + [(7, k) for k in range(8, 60)] + [(500, 500), (900, 400), (400, 901)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components(frame, scratch(spark, "components")).collect()}
    want = {**dict.fromkeys(range(100, 181), 100), **dict.fromkeys([7, *range(8, 60)], 7), 400: 400, 900: 400, 901: 400}
    assert got == want


# --- decontamination ---


def test_leaks_by_brute_force(spark):
    rng = random.Random(9)
    vocab = vocabulary(rng, 500)
    items = [(k, prose(rng, rng.choice([2, 5, 12, 30, 90, 400]), vocab)) for k in range(25)]
    items += [(25, None), (26, ""), (27, "one two"), (None, prose(rng, 20, vocab)), (3, items[3][1])]
    docs = [(9_000 + k, None) for k in range(2)]
    for k in range(80):
        text = prose(rng, rng.choice([0, 3, 50, 2_000]), vocab).split()
        if items[k % 25][1]:
            part = items[k % 25][1].split()
            part = part[: int(len(part) * rng.choice([1, 1, 0.95, 0.85, 0.5]))]
            at = rng.randint(0, len(text))
            half = rng.choice([0, len(part) // 2])  # also in two pieces
            text = part[:half] + text[:at] + part[half:] + text[at:]
        docs.append((k, " ".join(text).title() if k % 7 == 0 else " ".join(text)))
    docs += [(100, "one two"), (101, "One\tTWO "), (None, items[4][1]), (5, docs[5][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS x", "'c' AS item_id", "2 AS u", "3 AS k", "4 AS shingle")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'c' AS n_item")
    by_doc, by_item = {}, {}
    for key, text in docs:
        by_doc.setdefault(key, set()).update(shingles(text, 5))
    for key, text in items:
        by_item.setdefault(key, set()).update(shingles(text, 5))
    want = [(a, b, len(q), len(q & s)) for a, q in by_item.items() for b, s in by_doc.items() if q and len(q & s) >= 0.8 * len(q)]
    got = decontaminate.leaks(d, i)
    assert listed(got, "item_id", "doc_id", "n_item", "n_shared") == sorted(want, key=repr) and len(want) > 20
    assert decontaminate.leaks(empty(spark), i).count() == 0 and decontaminate.leaks(d, i.limit(0)).count() == 0


# --- mixing ---


def fair(sizes: dict, weights=(5, 2, 1), most=3):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        open_weight = sum(weight[n] for n in names if n not in full)
        level = (total - sum(most * sizes[n] for n in full)) / open_weight if open_weight else 0
        over = {n for n in names if n not in full and level * weight[n] >= most * sizes[n]}
        if not over:
            return {n: most * sizes[n] if n in full else level * weight[n] for n in names}
        full |= over


@pytest.mark.parametrize("block", [1, 7, 256])
def test_mix_meets_its_targets(spark, block):
    docs = awkward(spark)
    rows = mixing.taken_words(docs, block=block).collect()
    held = docs.collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter((r["doc_id"], r["source"], len(words(r["text"]))) for r in held)
    sizes: dict = {}
    for r in held:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    want = fair(sizes)
    taken: Counter = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), abs=len(sizes))
    again = mixing.taken_words(docs.repartition(5), block=block).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_schedule_is_even_everywhere(spark):
    docs = spark.createDataFrame([(i, "w " * 500, "abc"[i % 3]) for i in range(60)], "doc_id long, text string, source string")
    mix = mixing.mixed(docs, block=50)
    slots = mixing.schedule(mix.targets, 30_000, 50).orderBy("slot").collect()
    share = {r["s"]: r["goal"] / 30_000 for r in mix.targets.collect()}
    for low in range(0, 500, 100):
        part = Counter(r["s"] for r in slots[low: low + 100])
        assert all(abs(part[s] - 100 * share[s]) <= 4 for s in share)
    ranks = Counter((r["s"], r["rank"]) for r in slots)
    assert max(ranks.values()) == 1 and len({r["slot"] for r in slots}) == len(slots)
    assert mix.parts.selectExpr("sum(upto - first)").first()[0] == 30_000


def test_mix_of_nothing(spark):
    assert mixing.taken_words(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert listed(mixing.taken_words(blank), "doc_id", "target", "taken") == [(1, 0.0, 0), (2, 0.0, 0)]


# --- toxicity ---


def labelled(n=240):
    rng = random.Random(1)
    vocab = vocabulary(rng, 600)
    rows = []
    for i in range(n):
        text = prose(rng, rng.choice([20, 200]), vocab).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                text.insert(rng.randint(0, len(text)), rng.choice(["Blockhead", "numskull,", "dunderwhelp"]))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_toxicity_learns_gapped_insults(spark):
    rows = labelled()
    model = toxicity.ToxicityModel.train([t for _, t, _ in rows], [y for _, _, y in rows])
    clean = "lora natu selina torin asule"
    scores = list(model.scores([clean, "", clean + " numskull", clean + " n.u.m.s.k.u.l.l", clean + " block-head", "b l o c k h e a d " + clean]))
    assert max(scores[:2]) < 0.3 and min(scores[2:]) > 0.7
    long = list(model.scores(["z" * 50_000 + "numskull" + "z" * 50_000]))[0]
    assert long > 0.7


def test_toxicity_of_awkward_rows(spark):
    train = spark.createDataFrame([(i + 1_000, t, None, None, None) for i, t, _ in labelled()], "doc_id long, text string, lang string, source string, n_chars long")
    docs = awkward(spark, extra=False).unionByName(train).selectExpr("*", "9 AS toxic", "8 AS score", "true AS held_out")
    marks = [(i + 1_000, y) for i, _, y in labelled()] + [(None, 1), (1, None), (2, 0), (2, 0), (10**9, 1)]
    labels = spark.createDataFrame(marks, LABELS).selectExpr("*", "'x' AS text", "1 AS quality")
    got = toxicity.judged(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    for r in got:
        want = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] == want
    held = {r["doc_id"]: r["predicted"] for r in got if r["held_out"] and r["doc_id"] >= 1_000}
    assert all(held[i] == y for i, y in marks if i in held)
    # Nothing to learn from: the share of toxic labels.
    alone = toxicity.judged(docs, labels.where("toxic = 1")).collect()
    assert {r["score"] for r in alone} == {1.0}
    assert {r["score"] for r in toxicity.judged(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.judged(empty(spark), labels).count() == 0


def test_held_out_labels_are_not_learned_from(spark):
    rows = labelled()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    one = spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    other = spark.createDataFrame([(i, 1 - y if i in held else y) for i, _, y in rows], LABELS)
    assert listed(toxicity.judged(docs, one), "doc_id", "score") == listed(toxicity.judged(docs, other), "doc_id", "score")


def test_kernel_by_brute_force():
    from itertools import combinations
    from math import prod

    def weights(text):
        out: Counter = Counter()
        for c in combinations(range(len(text)), 3):
            if c[2] - c[0] < toxicity.SPAN and all(text[i].isalpha() for i in c):
                out["".join(text[i] for i in c)] += prod(0.5 if x.isalpha() else 0.95 for x in text[c[0]: c[2] + 1])
        return out

    names, texts = ["loser", "clown", "ab"], ["loser", "l.o.s.e.r", "clowner", "", "x", "lloses", "!!!!"]
    got = toxicity.SubsequenceKernel(names)(texts)
    for i, t in enumerate(texts):
        for j, n in enumerate(names):
            a, b = weights(t), weights(n)
            assert got[i, j] == pytest.approx(sum(a[u] * b[u] for u in b), rel=1e-4)


# --- languages ---


def test_evidence_is_fused(spark):
    rng = random.Random(2)
    first, second = vocabulary(rng, 80), ["k" + w + "z" for w in vocabulary(rng, 80)]
    docs = [(i, prose(rng, 60, (first, second)[i % 2]), ("aa", "bb")[i % 2], "s") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    model = language_id.train(frame)
    pages = []
    for i in range(60):  # host and declaration agree with the text of most of its pages
        k = i % 2
        pages.append((i, f"http://h{k}.site.{('x', 'y')[k]}/{i}", f"<html lang='{('aa', 'bb')[k]}'><script>zkzk</script><p>{prose(rng, 60, (first, second)[k])}</p>"))
    pages += [(100, "http://h1.site.y/z", None), (101, "http://h0.site.x/z", ""), (102, None, "<html lang=bb><p></p>"), (None, None, None)]
    rows = language_id.of_pages(spark.createDataFrame(pages, PAGES).selectExpr("*", "1 AS kind", "2 AS declared"))
    got = {r["id"]: r for r in language_id.identify(rows, model).collect()}
    assert all(got[i]["language"] == ("aa", "bb")[i % 2] for i in range(60))
    assert (got[100]["language"], got[101]["language"], got[102]["language"]) == ("bb", "aa", "bb")
    assert None in got and 0 < got[None]["confidence"] <= 1


def test_languages_of_awkward_rows(spark):
    docs = awkward(spark)
    found = language_id.identify(language_id.of_documents(docs), language_id.train(docs))
    assert found.count() == docs.count() and found.where("language IS NULL").count() == 0
    none = language_id.train(docs.where("lang IS NULL"))
    assert none is None
    assert language_id.identify(language_id.of_documents(docs), none).where("language IS NOT NULL").count() == 0
    assert language_id.identify(language_id.of_documents(empty(spark)), language_id.train(docs)).count() == 0


# --- pages ---

NOISE = [
    "<nav><ul><li>Home<li>News</ul></nav>", "<header>Site name</header>", "<aside>Side</aside>", "<footer>&copy; Site</footer>",
    "<div class='ad-banner'>Buy</div>", "<div id=comments><p>First!</p></div>", "<form><p>Mail</p><input></form>",
    "<div class=\"cookie-notice\">We use cookies</div>", "<script>if (a < b) document.write('<p>x</p>')</script>",
    "<style>p { x: '</p>' }</style>", "<!-- <p>old</p> -->", "<div role='navigation'>More</div>", "<section hidden>Not seen</section>",
]
ARTICLE = "<article><h1>A &amp; B</h1><p>one  <b>two\n<br>three<p>caf&eacute; &#x1F600; 1 < 2</article>"
TEXT = "A & B\none two three\ncafé \U0001f600 1 < 2"


@pytest.mark.parametrize("noise", NOISE)
def test_what_is_no_article_is_left_out(noise):
    for page in (f"<html><body>{noise}{ARTICLE}", f"<body>{ARTICLE}{noise}</body>", f"<body><main>{noise}{ARTICLE}{noise}</main>"):
        assert wrappers.main_text(page, None) == TEXT


def test_frames_around_the_article_stay_and_comments_in_article_elements_go():
    comment = "<article class='comment'><p>Nice.</p></article>"
    for page in (
        f"<body class='has-sidebar'><div class='layout with-sidebar'><div id='page-header-fixed'>{ARTICLE}</div></div>",
        f"<div class='content search-page'>{ARTICLE}<section>{comment}</section></div>", f"{comment}{ARTICLE}{comment}",
    ):
        assert wrappers.main_text(page, None) == TEXT


@pytest.mark.parametrize("part", [
    '<div style="overflow:hidden">Own words.</div>', '<p title="the hidden valley">Own words.</p>', '<p data-role="search">Own words.</p>',
    '<h2 id="form-validation">Own words.</h2>', '<h2 id="how-to-search">Own words.</h2>', '<h2 id="search">Own words.</h2>',
    '<section id="discussion"><p>Own words.</p></section>', '<div class="section" id="comments"><p>Own words.</p></div>',
])
def test_elements_of_an_article_with_like_names_are_kept(part):
    for tag in ("article", "main"):
        assert wrappers.main_text(f"<{tag}><p>Before.</p>{part}<p>After.</p></{tag}>", None) == "Before.\nOwn words.\nAfter."


def test_what_holds_most_of_a_page_is_kept():
    own = "Many words of the page, all in one paragraph that is longer than what stands around it."
    for page in (
        f'<div class="content no-sidebar"><p>{own}</p></div><div class="sidebar">Side</div>', f"<form><div><p>{own}</p></div></form>",
        f'<form action="/"><nav>Home</nav><article><p>{own}</p></article></form>', f'<div class="sidebar"><p>{own}</p></div>',
        f'<article><p>{own}</p><div class="comments"><p>{own} Indeed.</p></div></article>',
    ):
        assert wrappers.main_text(page, None) == own
    for noise in (f'<div class="comments"><p>{own}</p></div>', f'<div class="site-nav"><p>{own}</p></div>'):
        assert wrappers.main_text(f"<article><p>Short.</p></article>{noise}", None) == "Short."


@pytest.mark.parametrize("name", ["comments", "cookie-banner", "user-comments-area", "site-notice", "ad-banner", "related posts"])
def test_comments_and_notices_stay_out_however_long(name):
    long = "Many words that are no part of the article, all in one paragraph longer than the article."
    page = f"<body><div class='story'><p>Two words.</p></div><div class='{name}'><p>{long}</p></div></body>"
    assert wrappers.main_text(page, None) == "Two words."


def test_tags_that_never_end_are_read_once():
    import time

    began = time.process_time()
    for page in ("<b " * 300_000, "<a '" * 100_000, '<a "x" ' * 100_000, "<! " * 100_000, "<" * 300_000):
        wrappers.main_text(page, None)
    assert time.process_time() - began < 20
    assert wrappers.main_text("<p>a<img alt='x < 3 > 2'>b</p>", None) == "ab"


def test_siblings_of_the_longest_part_are_kept():
    items = "".join(f"<li>Point {k} of a long list of many words" for k in range(20))
    page = f"<nav>Home</nav><div><h1>Title</h1><p>Intro.</p><ul>{items}</ul></div><div><p>Second part.</p></div>"
    points = [f"Point {k} of a long list of many words" for k in range(20)]
    assert wrappers.main_text(f"<body>{page}</body>", None).split("\n") == ["Title", "Intro.", *points, "Second part."]
    assert wrappers.main_text("<body><nav>Home</nav></body>", None) == ""


def test_any_input_can_be_parsed():
    for page in ("", "<", "<p", "</p></p>", "<a href='x>y'>z", "<" * 5_000, "<div>" * 5_000 + "deep", "<script>never closed", "&#0;&bogus;"):
        wrappers.main_text(page, None)
    assert wrappers.main_text("<div>" * 5_000 + "deep", None) == "deep"
    assert wrappers.main_text("plain words only", None) == "plain words only"


def test_template_is_induced_from_a_hosts_pages(spark):
    """No element says what it is: only what is the same on the host's pages gives the template away."""
    rng = random.Random(4)
    vocab = vocabulary(rng, 500)
    rows, want = [], {}
    for i in range(40):
        paragraphs = [prose(rng, rng.randint(5, 40), vocab) for _ in range(rng.randint(1, 6))]
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        page = (
            "<html><body><div class=c1><div class=c2><p>Acme Daily</p><p>World</p><p>Sport</p></div>"
            f"<div class=c3><p>Read on for more of our stories</p>{body}<p>Do not copy without asking us</p></div>"
            "<div class=c4><p>Imprint of Acme and all the other long legal words that fill the page again and again</p></div></div>"
        )
        rows.append((i, f"https://acme.example/{i}", page))
        want[i] = "\n".join(paragraphs)
    rows += [(100, None, None), (101, "nonsense", "<p>alone</p>"), (102, "https://one.example/", ARTICLE), (None, "https://one.example/", ARTICLE), (0, *rows[0][1:])]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'c' AS host", "1 AS tree", "2 AS constant", "3 AS text").repartition(3)
    got = wrappers.extract(pages).collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert all(texts[i] == want[i] for i in want)
    assert texts[100] == "" and texts[101] == "alone" and texts[102] == TEXT and texts[None] == TEXT
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert wrappers.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_content_is_where_a_hosts_pages_vary_most(spark):
    """Menus, adverts and footers that vary, without any name or tag that tells them from the article."""
    rng = random.Random(12)
    vocab = vocabulary(rng, 500)
    rows, want = [], {}
    for i in range(40):
        parts = [prose(rng, 6, vocab), *(prose(rng, rng.randint(30, 80), vocab) for _ in range(rng.randint(2, 7)))]
        menu = "".join(f"<li>{w}</li>" for w in rng.sample(vocab, 4))
        body = f"<div><h1>{parts[0]}</h1>" + "".join(f"<p>{p}</p>" for p in parts[1:]) + "</div>"
        beside = f"<div><ul>{menu}</ul></div><div>{prose(rng, 5, vocab)}</div>", f"<div>{prose(rng, 7, vocab)}</div>"
        rows.append((i, f"https://acme.example/{i}", f"<body>{beside[0]}{body}{beside[1]}</body>"))
        want[i] = "\n".join(parts)
    # A page of another kind, which has its text elsewhere, keeps all of it.
    rows.append((90, "https://acme.example/90", f"<body><table><tr><td>{prose(rng, 90, vocab)}</table><div>Short.</div></body>"))
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, PAGES).repartition(3)).collect()}
    assert {i: got[i] for i in want} == want and len(got[90].split()) == 91


def test_content_slot_leaves_no_title_or_part_behind():
    def at(tree, weights):
        return wrappers.content_slot(wrappers.numbered(wrappers.parse(tree)), weights)

    # Slots in page order: root 0, body 1, and what is in it.
    assert at("<body><div>menu</div><div>text</div>", {2: 5, 3: 95}) == 3
    assert at("<body><div>menu</div><div>text</div>", {2: 20, 3: 80}) == 1
    assert at("<body><div><h1>title</h1></div><div>text</div>", {3: 5, 4: 95}) == 1
    assert at("<body><div><h1>name of the site</h1></div><div>text</div>", {4: 95}) == 4
    assert at("<body><p>intro</p><div>text</div>", {2: 5, 3: 95}) == 1
    assert at("<body><p>intro</p><ul><li>text</ul>", {4: 95}) == 1
    assert at("<body><div><article>teaser</article></div><div>text</div>", {3: 5, 4: 95}) == 1
    assert at("<body><div>menu</div><article><div>text</div></article>", {2: 5, 4: 95}) == 3
    assert at("<body><div>text</div>", {}) == 0


@pytest.mark.parametrize("folder", ["sf0.1"])
def test_articles_are_found_without_tags_and_names(spark, folder):
    """The sample pages, with their article tags and all telling tags and names taken out."""
    import os
    import re
    from html import unescape

    path = f"/root/testdata/{folder}/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no sample pages")
    rows, want = [], {}
    for r in spark.read.parquet(path).collect():
        html = re.sub(r"<(/?)(?:article|nav|footer|aside|header|main)\b[^>]*>", r"<\1div>", r["html"])
        rows.append((r["page_id"], r["url"], re.sub(r' (?:class|id|role)="[^"]*"', "", html)))
        body = re.sub(r"</?(?:p|h1)[^>]*>", "\0", re.search(r"<article>(.*?)</article>", r["html"], re.S)[1])
        parts = (" ".join(unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in body.split("\0"))
        want[r["page_id"]] = "\n".join(p for p in parts if p)
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(rows, PAGES).repartition(8)).collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def test_copies_of_a_page_are_no_template(spark):
    rng = random.Random(8)
    vocab = vocabulary(rng, 500)
    rows, want = [], {}
    for i in range(100):  # page 0 is the longest, and 90 of the 100 rows are copies of it
        k = max(0, i - 90)
        paragraphs = [prose(rng, 20, vocab) for _ in range(3 if k else 6)] if i == 0 or k else paragraphs
        want[i] = "\n".join(paragraphs)
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        rows.append((i, f"https://acme.example/{i}", f"<div><p>Acme Daily</p>{body}<p>Imprint of Acme</p></div>"))
    got = wrappers.extract(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_own_text_in_a_template_slot_is_kept(spark):
    rng = random.Random(9)
    vocab = vocabulary(rng, 500)
    rows, want = [], {}
    for i in range(40):  # pages 0 and 1 lack the host's last line, so their last paragraph stands where it would
        paragraphs = [prose(rng, 20, vocab) for _ in range(4 if i < 2 else 3)]
        want[i] = "\n".join(paragraphs)
        body = "".join(f"<p>{p}</p>" for p in [*paragraphs, *["Do not copy"] * (i > 1)])
        rows.append((i, f"https://acme.example/{i}", f"<article>{body}</article>"))
    got = wrappers.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


def test_alignment_by_brute_force():
    def tree(rng, depth):
        node = wrappers.Node(rng.choice("xyz"))
        node.content = [tree(rng, depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)]
        return node

    def size(a, b):
        if a.label != b.label:
            return 0
        xs, ys = a.children(), b.children()
        m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i in range(len(xs)):
            for j in range(len(ys)):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + size(xs[i], ys[j]))
        return 1 + m[-1][-1]

    rng = random.Random(6)
    for _ in range(200):
        a, b = tree(rng, 3), tree(rng, 3)
        a.tag = a.label = b.tag = b.label = "root"
        assert len(wrappers.align(a, wrappers.numbered(b))) == size(a, b)


def test_long_pages_are_aligned_in_bounded_time():
    """Unique parts are matched first, and the rest in turn; the template around is found either way."""
    import time

    def page(seed, n, first="<p>", last="</p>"):
        body = "".join(f"{first}own words {seed} {k}{last}" for k in range(n))
        return wrappers.parse(f"<div class=top><p>Acme Daily</p></div><div class=mid>{body}<p>Shared line</p></div><div class=end><p>Imprint</p></div>")

    began = time.process_time()
    for one, two in ((page(1, 20_000), page(2, 20_000)), (page(1, 5_000, "<ul><li>", "</li></ul>"), page(2, 4_000, "<ul><li>", "</li></ul>"))):
        reference = wrappers.numbered(two)
        slots = wrappers.align(one, reference)
        texts, todo = {}, [reference]
        while todo:
            label, slot, children, text = todo.pop()
            texts[slot] = text
            todo.extend(children)
        todo, same = [one], 0
        while todo:
            node = todo.pop()
            todo.extend(node.children())
            same += bool(own := wrappers.own_text(node)) and texts.get(slots.get(id(node))) == own
        assert same == 3  # the frame's two lines and the shared one
    assert time.process_time() - began < 30


def test_anchors_keep_their_order():
    def nodes(texts):
        made = []
        for t in texts:
            node = wrappers.Node("p")
            node.add_text(t)
            made.append(node)
        return made

    def listed(texts):
        return [["p", k, [], wrappers.own_text(n)] for k, n in enumerate(nodes(texts))]

    found = wrappers._anchors(nodes("a b c d b e".split()), listed("c a d x e d2".split()))
    assert found in ([(0, 1), (3, 2), (5, 4)], [(2, 0), (3, 2), (5, 4)])
    assert wrappers._anchors([], []) == [] and wrappers._anchors(nodes("aa"), listed("aa")) == []


# --- pipeline ---


def test_pipeline_of_awkward_rows(spark, tmp_path):
    rows = labelled()
    docs = awkward(spark).unionByName(
        spark.createDataFrame([(i + 1_000, t, "en", "abc"[i % 3], 1) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long"),
        allowMissingColumns=True,
    )
    rng = random.Random(8)
    item = prose(rng, 40, vocabulary(rng, 90))
    docs = docs.unionByName(spark.createDataFrame([(5_000, "before " + item + " after")], "doc_id long, text string"), allowMissingColumns=True)
    root = str(tmp_path)
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i + 1_000, y, 1) for i, _, y in rows], LABELS + ", quality int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    at, kept = spark.read.parquet(f"{root}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, at, root)
        assert out.columns == docs.columns
        out.write.parquet(f"{root}/{name}")
        at = spark.read.parquet(f"{root}/{name}")
        kept[name] = Counter(r["doc_id"] for r in at.collect())
    toxic = {i + 1_000 for i, _, y in rows if y}
    assert not toxic & kept["toxicity"].keys() and len(kept["toxicity"]) == len({r["doc_id"] for r in docs.collect()} - toxic)
    judged = spark.read.parquet(f"{root}/toxicity").collect()
    # Rows without an id of their own are documents like all others; here they are numbered after the ids.
    own = {10**6 + k if r["doc_id"] is None or kept["toxicity"][r["doc_id"]] > 1 else r["doc_id"]: r for k, r in enumerate(judged)}
    brute = brute_components([{"doc_id": i, "text": r["text"]} for i, r in own.items()], 5, 80)
    assert kept["near_dedup"] == Counter(own[i]["doc_id"] for i, c in brute.items() if i == c)
    assert kept["near_dedup"][None] == 1 and kept["near_dedup"][12] == 2 and kept["near_dedup"][14] == 1
    assert kept["near_dedup"].keys() - kept["decontaminate"].keys() == {5_000}
    sizes = Counter({s: 0 for s in "abc"})
    for r in spark.read.parquet(f"{root}/decontaminate").collect():
        sizes[r["source"]] += len(words(r["text"]))
    mixed = Counter()
    for r in spark.read.parquet(f"{root}/mix").collect():
        mixed[r["source"]] += len(words(r["text"]))
    goals = {r["source"]: r["goal"] for r in mixing.targets(mixing.sizes(spark.read.parquet(f"{root}/decontaminate"))).collect()}
    longest = max(len(words(r["text"])) for r in judged)
    assert all(abs(mixed[s] - goal) <= longest for s, goal in goals.items())
    tokens = corpus_pipeline.run(spark, root)
    assert Counter(r["doc_id"] for r in tokens.collect()) == kept["mix"]


def test_rows_without_id_are_judged_one_by_one(spark, tmp_path):
    rng = random.Random(18)
    words_ = vocabulary(rng, 90)
    item = prose(rng, 40, words_)
    clean = [prose(rng, 60, words_) for _ in range(3)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for ids in ([None] * 4, [7] * 4, [None, None, 7, 7], [2**63 - 1] * 4, [-(2**63), -(2**63), 2**63 - 1, None]):
        rows = list(zip(ids, [*clean, f"before {item} after"]))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        left = corpus_pipeline.one_of_near_copies(spark, docs, str(tmp_path))
        assert sorted(r["text"] for r in left.collect()) == sorted(t for _, t in rows)
        left = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
        assert left.columns == docs.columns and sorted(r["text"] for r in left.collect()) == sorted(clean)


def test_pipeline_of_nothing(spark, tmp_path):
    root = str(tmp_path)
    empty(spark).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    assert corpus_pipeline.run(spark, root).count() == 0


def test_long_lists_of_children_have_the_best_matching_too(monkeypatch):
    """A list is matched by one rule whatever its length; before, the longest were matched by their places."""
    one = wrappers.parse("<div><h2>t</h2>" + "<p>a</p>" * 1_100 + "</div>")
    two = wrappers.numbered(wrappers.parse("<div>" + "<p>b</p>" * 1_100 + "</div>"))
    assert len(wrappers.align(one, two)) == 2 + 1_100
    rng = random.Random(7)

    def page() -> str:
        kinds = [lambda t: f"<p>{t}</p>", lambda t: f"<div>{t}</div>", lambda t: f"<ul><li>{t}</li><li>x</li></ul>",
                 lambda t: "<div>" + f"<p>{t}</p>" * rng.randrange(4) + "</div>"]
        return "<div>" + "".join(rng.choice(kinds)(rng.choice("xyz")) for _ in range(rng.randrange(1, 20))) + "</div>"

    for _ in range(60):
        root, reference, depth = wrappers.parse(page()), wrappers.numbered(wrappers.parse(page())), rng.randrange(1, 6)
        monkeypatch.setattr(wrappers, "CELLS", 1 << 40)
        expected = wrappers.align(root, reference, depth)
        monkeypatch.setattr(wrappers, "CELLS", 0)
        assert wrappers.align(root, reference, depth) == expected


def test_a_stage_run_alone_sends_small_batches(spark, monkeypatch):
    seen = []

    def sizes(docs, id_col):
        found = docs.coalesce(1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long"
        )
        seen.extend(r.n for r in found.collect())
        return docs.selectExpr(f"`{id_col}` AS doc_id", "true AS kept")

    monkeypatch.setattr(corpus_pipeline.near_dedup, "near_duplicates", sizes)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        docs = spark.range(2_500).selectExpr("id AS doc_id", "'a' AS text")
        assert dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "").count() == 2_500
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sum(seen) == 2_500 and max(seen) <= 1_000


def test_sets_do_not_depend_on_the_block(monkeypatch):
    from loadweave.llm import shingle_sets as module

    texts = [" ".join(f"w{(k * k) % 97}{n}" for k in range(n)) for n in (0, 1, 4, 5, 40, 700)] + [None, "  "]
    one = [v.tolist() for v in module.shingle_sets(texts, 5)]
    monkeypatch.setattr(module, "BLOCK_BYTES", 64)
    assert [v.tolist() for v in module.shingle_sets(texts, 5)] == one
