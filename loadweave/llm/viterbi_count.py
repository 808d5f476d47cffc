"""Token counts of a unigram tokenizer, without building the tokens.

A text is cut before each meta space, as the tokenizer's pre-tokenizer does. For each distinct piece of text an
Aho-Corasick automaton names every vocabulary entry that ends at each character; dynamic programming over the
characters keeps the best score and, with it, the number of tokens, never the tokens.

The tokenizer's rules are kept to the letter: entries are added up from the left in double precision, of equal scores
the earliest start (the longest entry) wins, a character that no entry of one character covers costs the least score
less 10, neighbouring unknown stretches are one, and an unknown stretch counts as its UTF-8 bytes where the
vocabulary has all byte entries, else as one token.

Defined results: null and empty texts have no tokens; repeated rows are counted each; an empty table gives no rows;
texts are never cut. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import whole

#: Fixed values of the tokenizer.
META, UNKNOWN_PENALTY = "▁", 10.0

CACHED_PIECES = 300_000
ROW = "doc_id long, n_pieces long, n_tokens long"

_counters: dict[str, "UnigramCounter"] = {}


def vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Entries with scores, and the number of the unknown entry, of a sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class UnigramCounter:
    """Number of tokens of a piece of text under a unigram vocabulary."""

    def __init__(self, entries: list[tuple[str, float]], unknown: int):
        import ahocorasick

        self.names = {name for name, _ in entries}
        self.single = {name for name in self.names if len(name) == 1}
        self.bytes = all(f"<0x{b:02X}>" in self.names for b in range(256))
        self.worst = min(score for _, score in entries) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for k, (name, score) in enumerate(entries):
            if name:
                self.automaton.add_word(name, (len(name), score, k == unknown))
        self.automaton.make_automaton()
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        n = len(text)
        score: list[float | None] = [0.0] + [None] * n
        tokens = [0] * (n + 1)  # without an unknown stretch that reaches up to here
        since = [-1] * (n + 1)  # where that stretch begins
        matches: list[list[tuple[int, float, bool]]] = [[] for _ in range(n)]
        for last, found in self.automaton.iter(text):
            matches[last].append(found)
        for end in range(1, n + 1):
            best, start, strange = None, end, False
            for length, own, is_unknown in sorted(matches[end - 1], reverse=True):
                total = own + score[end - length]
                if best is None or total > best:
                    best, start, strange = total, end - length, is_unknown
            if text[end - 1] not in self.single:
                total = self.worst + score[end - 1]
                if best is None or total > best:
                    best, start, strange = total, end - 1, True
            score[end] = best
            if strange:
                tokens[end] = tokens[start]
                since[end] = start if since[start] < 0 else since[start]
            else:
                tokens[end] = tokens[start] + self._stretch(text, since[start], start) + 1
        return tokens[n] + self._stretch(text, since[n], n)

    def _stretch(self, text: str, start: int, end: int) -> int:
        if start < 0:
            return 0
        part = text[start:end]
        return len(part.encode()) if self.bytes and part not in self.names else 1

    def total(self, text: str) -> tuple[int, int]:
        """Pieces and tokens of a whole text."""
        if not text:
            return 0, 0
        spaced = text.replace(" ", META)
        pieces = (spaced if spaced[0] == META else META + spaced)[1:].split(META)
        known = self.known
        for piece in set(pieces).difference(known):
            if len(known) >= CACHED_PIECES:
                known.clear()
                return self._long(pieces)
            known[piece] = self.count(META + piece)
        return len(pieces), sum(map(known.__getitem__, pieces))

    def _long(self, pieces: list[str]) -> tuple[int, int]:
        """The same for a text that meets a full cache: the cache starts again, and may do so more than once."""
        tokens = 0
        for piece in pieces:
            if (found := self.known.get(piece)) is None:
                if len(self.known) >= CACHED_PIECES:
                    self.known.clear()
                found = self.known[piece] = self.count(META + piece)
            tokens += found
        return len(pieces), tokens


def counter(path: str) -> UnigramCounter:
    """This worker's counter for a model file."""
    if path not in _counters:
        _counters[path] = UnigramCounter(*vocabulary(path))
    return _counters[path]


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_pieces, n_tokens. No shuffle; a task holds one batch and its cache."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model)
        for batch in batches:
            found = [own.total(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for p, _ in found], pa.int64()), pa.array([t for _, t in found], pa.int64())],
                names=["doc_id", "n_pieces", "n_tokens"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return rows.mapInArrow(count, ROW)
