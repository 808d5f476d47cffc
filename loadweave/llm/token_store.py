"""Token ids in a seekable binary format: independent zstandard frames with a trailing seek table.

A store is a folder of shards in ascending order of document id, and an index of them. A shard holds

* one zstandard frame a document (with a content checksum): its token ids and the end id, little-endian unsigned
  32-bit integers;
* a skippable frame with the document ids (zstandard-compressed signed 64-bit integers), entered in the seek table
  as a frame without content;
* the seek table of the public seekable format: a skippable frame with compressed size, size and the low 32 bits of
  XXH64 of each frame, and a footer that says how many frames there are.

Plain zstandard decoders read a shard from end to end; ``read_frames`` decompresses the requested documents only.

Each task writes one shard, under a name of its own until it is complete, so a task that is run again replaces equal
bytes. Words are encoded once per worker: the tokenizer never joins anything across white space, so the ids of a text
are those of its words in a row. The cache is bounded and emptied when full.

Defined results: null text is an empty document (just the end id); a null id comes first and is written as the
smallest 64-bit integer; rows with equal ids follow in order of their texts' hashes, whatever the input's
partitioning; repeated rows are written each time; an empty table gives an empty store. Columns other than
id and text are not read.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweave.llm.common import fetch, kept_at, publish, whole

#: Fixed values of the seekable format.
SKIPPABLE_IDS, SKIPPABLE_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80

NO_ID = -(2**63)
END_ID = 1
CACHED_WORDS = 400_000
#: The last letter that is surely composed and lower-cased alike everywhere.
LAST_LATIN = "\u017f"
MARKS = string.punctuation.encode()
LEVEL = 1
SHARD = "shard int, name string, first_id long, documents long, n_tokens long"
ROW = "doc_id long, start long, n_tokens long, ids_crc32 long, shard string, frame int"

_encoders: dict[str, "WordEncoder"] = {}


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet's rule: bytes that print stand for themselves, the others for 256 and on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


def splits_letters(tokenizer) -> bool:
    """Whether the tokenizer lower-cases, then takes a run of letters as one piece of the byte-level alphabet.

    Asked by example: the short way for such words must give the tokenizer's own ids.
    """
    table = byte_letters()
    for text in ("Winter", "stra\u00dfe", "\u00c9tude", "\u0159eka"):
        piece = text.lower().encode().decode("latin-1").translate(table)
        for marks in ("", ".", ",.", "'!", string.punctuation):
            want = tokenizer.encode(text + marks, add_special_tokens=False).ids
            tail = tokenizer.encode(marks, add_special_tokens=False).ids
            if [t.id for t in tokenizer.model.tokenize(piece)] + tail != want:
                return False
    return True


class WordEncoder(dict):
    """Words to the bytes of their token ids, looked up in the tokenizer when missing.

    At most two generations of ``CACHED_WORDS`` words are held: a full one becomes the older one, and words found there
    move back, so frequent words stay.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.older: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {}
        self.plain = splits_letters(self.tokenizer)
        self.alphabet = byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._letters(word) if self.plain else None
        if ids is None:
            ids = array("I", self.tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _letters(self, word: bytes) -> bytes | None:
        """Ids of a word of Latin letters, and of one with ASCII marks behind it; None for any other word.

        Such letters are composed already and make one piece, so only the tokenizer's model is needed for them.
        """
        core = word.rstrip(MARKS)
        text = core.decode("utf-8", "replace").lower()
        if not text.isalpha() or not (text.isascii() or max(text) <= LAST_LATIN):
            return None
        key = text.encode()
        ids = self.get(key) or self.older.get(key)
        if ids is None:
            piece = text if len(key) == len(text) else key.decode("latin-1").translate(self.alphabet)
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()
        return ids if len(core) == len(word) else ids + self._tail(word[len(core):])

    def _tail(self, marks: bytes) -> bytes:
        if marks not in self.tails:
            ids = self.tokenizer.encode(marks.decode(), add_special_tokens=False).ids
            self.tails[marks] = array("I", ids).tobytes()
        return self.tails[marks]

    def encode(self, text: bytes) -> bytes:
        """The ids of a text in UTF-8."""
        return b"".join(map(self.__getitem__, text.split()))


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class ShardWriter:
    """Appends frames to an open stream and closes with the seek table."""

    def __init__(self, out, level: int = LEVEL):
        import zstandard

        self.out, self.entries, self.doc_ids, self.tokens = out, [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        import xxhash

        frame = self.compressor.compress(ids)
        self.out.write(frame)
        self.entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.tokens += len(ids) // 4

    def close(self) -> None:
        import xxhash

        held = self.compressor.compress(np.array(self.doc_ids, "<i8").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_IDS, len(held)) + held)
        self.entries.append((len(held) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = np.array(self.entries, "<u4").tobytes() + struct.pack("<IBI", len(self.entries), HAS_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(table)) + table)


def seek_table(file) -> tuple[np.ndarray, np.ndarray]:
    """Entries (offset, compressed size, size, checksum) of a shard's document frames, and their document ids."""
    import zstandard

    end = file.size()
    frames, flags, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
    if magic != SEEKABLE or flags != HAS_CHECKSUMS:
        raise ValueError("no seek table with checksums at the end of the file")
    raw = file.read_at(12 * frames + 8, end - 17 - 12 * frames)
    kind, size = struct.unpack("<II", raw[:8])
    if kind != SKIPPABLE_TABLE or size != 12 * frames + 9:
        raise ValueError("the seek table's own frame does not fit its footer")
    entries = np.frombuffer(raw[8:], "<u4").reshape(-1, 3).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(entries[:-1, 0])]).astype(np.int64)
    held = file.read_at(int(entries[-1, 0]), int(offsets[-1]))
    doc_ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(held[8:]), "<i8")
    return np.column_stack([offsets, entries])[:-1], doc_ids


def read_frames(file, wanted: set[int] | None = None) -> Iterator[tuple[int, int, int, bytes]]:
    """Frame number, document id, tokens of the shard before it, and the ids' bytes, checked against the table.

    With ``wanted``, only the frames of those document ids are read and decompressed.
    """
    import xxhash
    import zstandard

    entries, doc_ids = seek_table(file)
    before = (np.cumsum(entries[:, 2]) - entries[:, 2]) // 4
    decompressor = zstandard.ZstdDecompressor()
    for k, (offset, packed, size, check) in enumerate(entries.tolist()):
        doc_id = int(doc_ids[k])
        if wanted is not None and doc_id not in wanted:
            continue
        ids = decompressor.decompress(file.read_at(packed, offset), max_output_size=size)
        if len(ids) != size or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} does not match its checksum")
        yield k, doc_id, int(before[k]), ids


def _shard_writer(tokenizer: str, folder: str, end_id: int):
    tail = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        shard = TaskContext.get().partitionId()
        name, encode = f"tokens-{shard:06d}.zst", encoder(tokenizer).encode
        with publish(folder, name) as out:
            writer = ShardWriter(out)
            for batch in (b for group in ((first,), batches) for b in group):
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                    writer.add(doc_id, encode(text.as_py()) + tail)
            writer.close()
        low = writer.doc_ids[0]
        yield pa.RecordBatch.from_pylist([{
            "shard": shard, "name": name, "first_id": low, "documents": len(writer.doc_ids), "n_tokens": writer.tokens,
        }], schema=pa.schema([
            ("shard", pa.int32()), ("name", pa.string()), ("first_id", pa.int64()), ("documents", pa.int64()),
            ("n_tokens", pa.int64()),
        ]))

    return write


def write_store(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write the store and return its index: shard, name, first_id, documents, n_tokens, start.

    The documents are range-partitioned by id and, within one id, by a hash of their texts; each range is one shard. Only the index, one row a shard, goes
    through the driver, which adds up how many tokens lie before each shard.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    # Rows that share an id follow in order of their texts, so the store is the same however the input is partitioned,
    # and their ranges can be parted.
    order = ["doc_id", F.xxhash64("text"), "text"]
    dealt = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    shards = kept_at(dealt.mapInArrow(_shard_writer(tokenizer, folder, end_id), SHARD), f"{folder}/shards")
    start, index = 0, []
    for row in sorted(shards.collect(), key=lambda r: r["shard"]):
        index.append((*row, start))
        start += row["n_tokens"]
    return kept_at(spark.createDataFrame(index, f"{SHARD}, start long").coalesce(1), f"{folder}/index")


def _shard_reader(folder: str, wanted: set[int] | None):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                out: list[tuple] = []
                with fetch(folder, shard["name"]) as file:
                    for k, doc_id, before, ids in read_frames(file, wanted):
                        out.append((
                            None if doc_id == NO_ID else doc_id, shard["start"] + before, len(ids) // 4,
                            zlib.crc32(ids), shard["name"], k,
                        ))
                        if len(out) >= 10_000:
                            yield _rows(out)
                            out = []
                yield _rows(out)

    return read


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32()]
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "frame"]
    columns = list(zip(*out)) if out else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def read_store(spark: SparkSession, folder: str, wanted: set[int] | None = None) -> DataFrame:
    """A row per stored document, from the shards: doc_id, start, n_tokens, ids_crc32, shard, frame."""
    index = spark.read.parquet(f"{folder}/index").select("name", "start")
    shards = index.count()
    return index.repartition(max(1, shards)).mapInArrow(_shard_reader(folder, wanted), ROW)
