"""Pack tokenised examples into sequences: vector bin packing under limits on tokens, segments and loss-bearing tokens.

An example is a run of token ids and a mask of those that bear loss. It is cut into pieces that keep all limits by
themselves; a piece that fills a sequence is one. The others wait in a pool of bounded size, and each full pool is packed
by the dot-product heuristic: one sequence is open at a time, and of the pieces that fit it takes the one whose demand
(tokens, one segment, loss, each as a share of its limit) has the largest dot product with what the sequence has left of
each limit. When no whole piece fits, the piece with the largest product is cut to fill the rest, and what is cut off goes
back to the pool.

Sequences are padded to the token limit, but one whose length is a power of two is not. So a sequence that ends short (its
segments or its loss are used up, or the pool is empty) is cut back to the largest power of two below and the rest goes
back to the pool: nothing is padded. With ``cut=False`` examples are cut only where they alone exceed a limit, and short
sequences stay as they are.

Every task packs the examples of its own partition while it reads them: no shuffle, and no more in memory than one pool,
one Arrow batch and one example. Only the end of a partition makes short sequences, at most one of each power of two
where segments and loss allow more. Sequence numbers are unique: the task's number times 2^40, then its own count. A task
that is run again on the same partition gives the same rows.

Defined results: null text is an empty example (its end id alone); null and repeated ids are examples of their own, told
apart by their rows; an empty table gives no rows. Columns other than those named are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import whole
from loadweave.llm.token_store import byte_letters

END_ID = 0
#: Pieces of one pool, and bytes of ids in one batch of results.
POOL, BATCH_BYTES = 2_048, 8 << 20
#: Room for a task's own count in a sequence number.
PER_TASK = 1 << 40
PIECE = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"
)


class Limits(NamedTuple):
    """What a sequence may hold at most."""

    tokens: int = 1_024
    segments: int = 64
    loss: int = 1_024


def checked(limits: Limits) -> Limits:
    """The limits, if a single id that bears loss keeps them."""
    if min(limits) < 1:
        raise ValueError("each limit must be at least 1")
    return limits


class Piece(NamedTuple):
    """Consecutive ids of an example, ``start`` of them after its first; ``loss`` marks those that bear loss."""

    doc_id: int | None
    start: int
    doc_tokens: int
    ids: np.ndarray
    loss: np.ndarray

    def split(self, k: int) -> tuple["Piece", "Piece"]:
        """The first k ids, and the rest."""
        return (
            self._replace(ids=self.ids[:k], loss=self.loss[:k]),
            self._replace(start=self.start + k, ids=self.ids[k:], loss=self.loss[k:]),
        )


def within(piece: Piece, tokens: int, loss: int) -> int:
    """How many of the piece's first ids keep both limits."""
    head = np.cumsum(piece.loss[:tokens])
    return int(np.searchsorted(head, loss, side="right"))


def fitting(piece: Piece, limits: Limits) -> Iterator[Piece]:
    """The piece in parts that each keep the limits."""
    while len(piece.ids):
        part, piece = piece.split(within(piece, limits.tokens, limits.loss))
        yield part


def power_below(n: int) -> int:
    return 1 << (n.bit_length() - 1)


class Pool:
    """Pieces that wait, as objects and as rows of demands."""

    def __init__(self, pieces: list[Piece], limits: Limits):
        self.limits = limits
        self.pieces: list[Piece] = []
        self.demand = np.zeros((0, 2), np.int64)
        self.alive = np.zeros(0, bool)
        self.add(pieces)

    def add(self, pieces: list[Piece]) -> None:
        """Puts pieces into the pool; places of taken ones are given up when they are more than half."""
        held = np.flatnonzero(self.alive)
        if len(held) * 2 < len(self.pieces):
            self.pieces = [self.pieces[i] for i in held]
            self.demand, self.alive = self.demand[held], np.ones(len(held), bool)
        self.pieces += pieces
        new = np.array([(len(p.ids), int(p.loss.sum())) for p in pieces], np.int64).reshape(-1, 2)
        self.demand = np.concatenate([self.demand, new])
        self.alive = np.concatenate([self.alive, np.ones(len(pieces), bool)])

    def __len__(self) -> int:
        return int(self.alive.sum())

    def take(self, i: int) -> Piece:
        self.alive[i] = False
        return self.pieces[i]

    def products(self, left: tuple[int, int, int]) -> np.ndarray:
        """The dot product of each piece's demand with what is left, both as shares of the limits."""
        share = [have / limit if limit else 0.0 for have, limit in zip(left, self.limits)]
        return (
            self.demand[:, 0] * (share[0] / self.limits.tokens) + share[1] / self.limits.segments
            + self.demand[:, 1] * (share[2] / self.limits.loss if self.limits.loss else 0.0)
        )

    def best(self, left: tuple[int, int, int]) -> int | None:
        """The piece to take whole: of those that fit, the one with the largest product, then the first."""
        fits = self.alive & (self.demand[:, 0] <= left[0]) & (self.demand[:, 1] <= left[2])
        if not fits.any():
            return None
        return int(np.argmax(np.where(fits, self.products(left), -1.0)))

    def to_cut(self, left: tuple[int, int, int]) -> tuple[int, int] | None:
        """A piece to cut and how many ids to take: one that fills the sequence, else the one that gives most."""
        longer = self.alive & ((self.demand[:, 0] > left[0]) | (self.demand[:, 1] > left[2]))
        if not longer.any():
            return None
        products = np.where(longer, self.products(left), -1.0)
        if left[2] >= left[0]:  # no prefix of that length can bear too much loss
            filling = longer & (self.demand[:, 0] > left[0])
            if filling.any():
                return int(np.argmax(np.where(filling, products, -1.0))), left[0]
        most = (0, -1)
        for i in np.argsort(-products, kind="stable")[: int(longer.sum())].tolist():
            size = within(self.pieces[i], left[0], left[2])
            if size > most[0]:
                most = size, i
            if size == left[0]:
                break
        return (most[1], most[0]) if most[0] else None


def packed(pieces: list[Piece], limits: Limits, cut: bool = True) -> Iterator[list[Piece]]:
    """Sequences of the pieces, each of which keeps the limits."""
    pool = Pool(pieces, limits)
    while len(pool):
        out: list[Piece] = []
        left = tuple(limits)
        while left[0] and left[1] and len(pool):
            # The last segment is better used up by a cut that fills the sequence than by what happens to fit.
            choice = pool.to_cut(left) if cut and left[1] == 1 else None
            if choice is not None and choice[1] < left[0]:
                choice = None
            whole_piece = pool.best(left) if choice is None else None
            if choice is None and whole_piece is None and cut:
                choice = pool.to_cut(left)
            if whole_piece is not None:
                piece = pool.take(whole_piece)
            elif choice is not None:
                piece, rest = pool.take(choice[0]).split(choice[1])
                pool.add([rest])
            else:
                break
            out.append(piece)
            left = left[0] - len(piece.ids), left[1] - 1, left[2] - int(piece.loss.sum())
        length = limits.tokens - left[0]
        if cut and length < limits.tokens:
            out, surplus = shortened(out, power_below(length))
            pool.add(surplus)
        yield out


def shortened(pieces: list[Piece], length: int) -> tuple[list[Piece], list[Piece]]:
    """The pieces up to a length, and the rest of them."""
    out: list[Piece] = []
    rest: list[Piece] = []
    for piece in pieces:
        head, tail = piece.split(min(length, len(piece.ids)))
        length -= len(head.ids)
        out += [head] if len(head.ids) else []
        rest += [tail] if len(tail.ids) else []
    return out, rest


def sequences(examples: Iterable[Piece], limits: Limits, cut: bool = True, pool: int = POOL) -> Iterator[list[Piece]]:
    """All sequences of a stream of examples, with at most ``pool`` pieces waiting."""
    waiting: list[Piece] = []
    for example in examples:
        for part in fitting(example, limits):
            if len(part.ids) == limits.tokens:
                yield [part]
                continue
            waiting.append(part)
            if len(waiting) >= pool:
                yield from packed(waiting, limits, cut)
                waiting = []
    yield from packed(waiting, limits, cut)


def byte_encoder(path: str) -> Callable[[str], np.ndarray]:
    """Encodes texts to the ids that the tokenizers library gives for a byte-level tokenizer file.

    A plain file (pair merges in the order of their ids, the usual split, nothing added but special tokens) is handed to
    tiktoken, which gives the same ids in a third of the time; other files, and texts that hold an added token, go to
    the library itself.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()

    def slow(text: str) -> np.ndarray:
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")

    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    model, split = held["model"], held["pre_tokenizer"] or {}
    added = [t["content"] for t in held["added_tokens"]]
    letters = {chr(b): b for b in range(256)} | {letter: b for b, letter in byte_letters().items()}
    merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", [])]
    ids = [model["vocab"].get(m.replace(" ", "")) for m in merges]
    plain = (
        model.get("type", "BPE") == "BPE" and held["normalizer"] is None and None not in ids and ids == sorted(ids)
        and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
    )
    if not plain:
        return slow
    ranks = {bytes(letters[c] for c in piece): k for piece, k in model["vocab"].items() if piece not in added}
    fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        return slow(text) if any(a in text for a in added) else np.array(fast.encode_ordinary(text), "<u4")

    return encode


_encoders: dict[str, Callable[[str], np.ndarray]] = {}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """This worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = byte_encoder(path)
    return _encoders[path]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
    kinds = [pa.binary() if n == "ids" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def _emitted(found: Iterable[list[Piece]]) -> Iterator[pa.RecordBatch]:
    """Rows of a task's sequences, in batches of bounded size."""
    first = TaskContext.get().partitionId() * PER_TASK
    out: list[tuple] = []
    size = 0
    for number, sequence in enumerate(found):
        offset = 0
        for p in sequence:
            out.append((
                p.doc_id, p.start, len(p.ids), p.ids.tobytes(), p.doc_tokens, int(p.loss.sum()), first + number, offset,
            ))
            offset += len(p.ids)
        size += 4 * offset
        if size >= BATCH_BYTES:
            yield _rows(out)
            out, size = [], 0
    if out:
        yield _rows(out)


def pack_documents(
    docs: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = END_ID, cut: bool = True,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Documents as examples: the ids of the text, then the end id, all of which bear loss.

    One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, loss_tokens, sequence_id,
    offset.
    """
    end = np.array([end_id], "<u4")

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
        encode = encoder(tokenizer)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(text.as_py()), end])
                yield Piece(doc_id, 0, len(ids), ids, np.ones(len(ids), bool))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emitted(sequences(examples(batches), checked(limits), cut))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return rows.mapInArrow(work, PIECE)


def pack_examples(
    examples: DataFrame, limits: Limits = Limits(), cut: bool = False, id_col: str = "doc_id", ids_col: str = "ids",
    loss_col: str = "loss",
) -> DataFrame:
    """Tokenised examples, one a row: ids (array of int) and which of them bear loss (array of boolean, null: all).

    Meant for instruction data, where prompts bear no loss: so by default examples are not cut to fill sequences. A null
    or empty array of ids gives no piece; a mask that is shorter than the ids counts as false beyond its end. The rows are
    those of ``pack_documents``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Piece]:
        for batch in batches:
            for doc_id, ids, loss in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.array(ids or [], "<u4")
                mask = np.zeros(len(ids), bool) if loss is not None else np.ones(len(ids), bool)
                given = np.array([bool(x) for x in (loss or [])][: len(ids)], bool)
                mask[: len(given)] = given
                yield Piece(doc_id, 0, len(ids), ids, mask)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _emitted(sequences(read(batches), checked(limits), cut))

    rows = examples.select(
        F.col(id_col).cast("long"), F.col(ids_col).cast("array<long>"), F.col(loss_col).cast("array<boolean>")
    )
    return rows.mapInArrow(work, PIECE)
