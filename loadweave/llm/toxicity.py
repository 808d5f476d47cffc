"""Toxicity by a support vector machine on a gap-weighted subsequence string kernel with Nystroem landmarks.

The kernel of two strings sums over the subsequences of three characters they share; each occurrence weighs the product
of the decays of the characters it spans. Letters decay by 0.5, anything else by 0.95, so ``i.d.i.o.t`` and ``idi*ot``
stay close to ``idiot`` while a long word that happens to hold the letters does not; occurrences span nine characters
at most.

Learning (in one task, from a sample of labelled documents of at most ``SAMPLE`` a class):

Near copies among the sample are left out first, so that no text speaks many times.

1. Landmarks are letter runs that tell toxic documents from clean ones, chosen one after the other by the likelihood
   ratio over the words no earlier one explains, plus the clean words that resemble them most.
2. A string is mapped to the kernel values with the landmarks, whitened by their own kernel matrix (Nystroem).
3. A document is toxic because of some word in some sentence. So the machine is trained on words: every word of the
   clean documents must score below the margin (the hardest are chosen anew with each machine), the words of toxic
   sentences that hold a landmark, and landmarks with inserted characters, above.
4. A logistic curve over the best word of a document gives the score. It starts from the share of toxic labels among
   documents without any landmark, as those labels are a matter of chance to the model.

Scoring maps each distinct word once per batch; a text's score is that of its best word. Words longer than ``WINDOW``
are read in overlapping windows and runs of single characters as one word, so whole texts count.

Defined results: null and empty texts get the lowest score; with no toxic or no clean label to learn from every text
gets the share of toxic labels (0 without any). Labels without id or value are not learned from; repeated rows are
scored each. Empty tables give no rows. Only id and text (and the labels' id and value) are read.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import whole

SAMPLE = 2_500
LANDMARKS, LOOKALIKES = 48, 24
WINDOW, SPAN = 16, 9
LETTER_DECAY, OTHER_DECAY = 0.5, 0.95
#: Lengths of the letter runs tried as landmarks, and how much rarer one must be in clean documents.
SHORTEST, LONGEST, RARER = 4, 10, 10
THRESHOLD = 0.7
CACHED_WORDS = 300_000
#: Strings whose kernel values are computed at once; one of ten letters takes up to some 20 kB of arrays meanwhile.
AT_ONCE = 1_024

_SPACED = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_KINDS = 64


def _kind(character: str) -> int:
    """Small numbers for letters; characters that no landmark can hold share 0."""
    if "a" <= character <= "z":
        return ord(character) - 96
    return 27 + ord(character) % 36 if character.isalpha() else 0


def units(text: str) -> set[str]:
    """The distinct strings of a text that are looked at: its words, and runs of single characters as one."""
    low = text.lower()
    found = {w.strip(_EDGES) or w for w in low.split()}
    for run in _SPACED.findall(low):
        found.add("".join(run.split()))
    return found


def windows(word: str) -> list[str]:
    """The word, or overlapping parts of a long one."""
    if len(word) <= WINDOW:
        return [word]
    step = WINDOW - SPAN
    return [word[i: i + WINDOW] for i in range(0, len(word) - SPAN, step)]


_picks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _triples(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all subsequences of three within the span, for strings of a length."""
    if length not in _picks:
        found = [t for t in combinations(range(length), 3) if t[2] - t[0] < SPAN]
        _picks[length] = tuple(np.array(c, dtype=np.int64) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    return _picks[length]


class SubsequenceKernel:
    """Kernel values of many strings with fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        where: dict[int, int] = {}
        rows: list[Counter] = []
        for name in landmarks:
            row: Counter = Counter()
            for code, weight in self._subsequences(name):
                row[where.setdefault(code, len(where) + 1)] += weight
            rows.append(row)
        self.place = np.zeros(_KINDS**3, np.int32)
        self.place[list(where)] = list(where.values())
        self.weights = np.zeros((len(where) + 1, len(landmarks)), np.float32)
        for k, row in enumerate(rows):
            for place, weight in row.items():
                self.weights[place, k] = weight

    @staticmethod
    def _subsequences(text: str) -> Iterator[tuple[int, float]]:
        kinds = [_kind(c) for c in text]
        decay = [LETTER_DECAY if c.isalpha() else OTHER_DECAY for c in text]
        for i, j, k in zip(*(a.tolist() for a in _triples(len(text)))):
            if kinds[i] and kinds[j] and kinds[k]:
                yield (kinds[i] * _KINDS + kinds[j]) * _KINDS + kinds[k], math.prod(decay[i: k + 1])

    def __call__(self, strings: list[str]) -> np.ndarray:
        out = np.zeros((len(strings), len(self.landmarks)), np.float32)
        by_length = defaultdict(list)
        for at, text in enumerate(strings):
            by_length[len(text)].append(at)
        for length, places in by_length.items():
            first, middle, last = _triples(length)
            if not len(first):
                continue
            for low in range(0, len(places), AT_ONCE):
                part = places[low: low + AT_ONCE]
                points = np.frombuffer("".join(strings[p] for p in part).encode("utf-32-le", "surrogatepass"), "<u4")
                kinds, decay = _character_tables(points)
                kinds, decay = kinds.reshape(-1, length), decay.reshape(-1, length)
                codes = (kinds[:, first] * _KINDS + kinds[:, middle]) * _KINDS + kinds[:, last]
                codes[(kinds[:, first] == 0) | (kinds[:, middle] == 0) | (kinds[:, last] == 0)] = 0
                spots = self.place[codes]
                row, column = np.nonzero(spots)
                if not len(row):
                    continue
                sums = np.concatenate([np.zeros((len(part), 1)), np.cumsum(decay, axis=1)], axis=1)
                weight = np.exp(sums[row, last[column] + 1] - sums[row, first[column]]).astype(np.float32)
                begins = np.flatnonzero(np.diff(row, prepend=-1))
                added = np.add.reduceat(self.weights[spots[row, column]] * weight[:, None], begins, axis=0)
                out[np.array(part)[row[begins]]] = added
        return out


_kind_table = np.zeros(0, np.int32)
_decay_table = np.zeros(0, np.float64)


def _character_tables(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kinds and log decays of code points."""
    global _kind_table, _decay_table
    if not len(_kind_table):
        known = [chr(c) for c in range(0x10000)]
        _kind_table = np.array([_kind(c) for c in known], np.int32)
        _decay_table = np.log(np.where([c.isalpha() for c in known], LETTER_DECAY, OTHER_DECAY))
    points = np.minimum(points, 0xFFFF)
    return _kind_table[points], _decay_table[points]


# --- learning ---


def _likelihood_ratio(a: float, b: float, n1: float, n0: float) -> float:
    """How much better two rates explain a of n1 and b of n0 than one rate; 0 if the first is not much higher."""
    if a * n0 < RARER * b * n1 or not a:
        return 0.0

    def fit(k: float, n: float, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)

    pooled = (a + b) / (n1 + n0)
    return fit(a, n1, a / n1) + fit(b, n0, b / n0) - fit(a, n1, pooled) - fit(b, n0, pooled)


def _letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all runs of ``SHORTEST`` letters of all words in a row, and where each word's begin (one entry more)."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(w) for w in words])
    codes = np.zeros(max(0, len(points) - SHORTEST + 1), np.uint64)
    for k in range(SHORTEST):
        codes = codes * np.uint64(0x9E3779B97F4A7C15) + points[k: k + len(codes)]
    inside = np.ones(len(codes), bool)
    for k in range(1, SHORTEST):
        cut = ends - k
        inside[cut[(cut >= 0) & (cut < len(codes))]] = False
    begins = np.concatenate([[0], np.cumsum(inside)])[np.minimum(np.concatenate([[0], ends]), len(codes))]
    return codes[inside], begins


def first_copies(docs: list[set[str]], sketch: int = 32) -> list[int]:
    """Places of documents that are no near copy of an earlier one; copies would count one text many times.

    The least hashes of a document's words are compared; half of them in common makes a copy.
    """
    seen: dict[int, list[int]] = defaultdict(list)
    kept = []
    for k, doc in enumerate(docs):
        least = sorted(zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in doc)[:sketch]
        shared = Counter(other for h in least for other in seen[h])
        if max(shared.values(), default=0) * 2 < max(1, len(least)):
            kept.append(k)
            for h in least:
                seen[h].append(k)
    return kept


def _hot_grams(toxic: list[set[str]], clean: list[set[str]]) -> tuple[set[str], float]:
    """The shortest runs that toxic documents hold more often than chance allows; and what chance allows."""
    order = sorted(set().union(*toxic, *clean))
    place = {w: k for k, w in enumerate(order)}
    letters = [_letters(w) for w in order]
    codes, begins = _grams(letters)
    kinds, codes = np.unique(codes, return_inverse=True)
    counts = np.zeros((2, len(kinds)))
    for side, docs in enumerate((toxic, clean)):
        for doc in docs:
            ids = [place[w] for w in doc]
            if ids:
                counts[side][np.unique(np.concatenate([codes[begins[i]: begins[i + 1]] for i in ids]))] += 1
    n1, n0 = len(toxic), len(clean)
    chance = math.log(max(2, len(kinds))) + 3
    ratio = np.zeros(len(kinds))
    for k in np.flatnonzero((counts[0] > 1) & (counts[0] * n0 >= RARER * counts[1] * n1)):
        ratio[k] = _likelihood_ratio(counts[0, k], counts[1, k], n1, n0)
    # With few toxic documents nothing can be beyond chance; then the best runs there are must do.
    least = max(1e-9, min(chance, 0.8 * ratio.max(initial=0.0)))
    found = set()
    for at in np.flatnonzero(ratio[codes] >= least) if len(kinds) else ():
        word = int(np.searchsorted(begins, at, side="right")) - 1
        found.add(letters[word][at - begins[word]: at - begins[word] + SHORTEST])
    return found, least


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]], most: int = LANDMARKS) -> list[str]:
    """Letter runs that tell toxic documents from clean ones, each by the words that no earlier one explains."""
    hot, least = _hot_grams(toxic, clean)
    runs_of: dict[str, set[str]] = {}
    for word in set().union(*toxic, *clean):
        letters = _letters(word)
        if any(letters[i: i + SHORTEST] in hot for i in range(len(letters) - SHORTEST + 1)):
            runs_of[word] = {r for r in _runs(word) if any(r[i: i + SHORTEST] in hot for i in range(len(r) - SHORTEST + 1))}
    spread: dict[str, set[int]] = defaultdict(set)
    for k, doc in enumerate(toxic):
        for word in doc & runs_of.keys():
            spread[word].add(k)
    against: dict[str, set[int]] = defaultdict(set)
    for k, doc in enumerate(clean):
        for word in doc & runs_of.keys():
            for run in runs_of[word]:
                against[run].add(k)
    holding: dict[str, list[str]] = defaultdict(list)
    for word in spread:
        for run in runs_of[word]:
            holding[run].append(word)

    def value(run: str) -> tuple[float, int]:
        docs = set().union(*(spread[w] for w in holding[run] if w in spread))
        return _likelihood_ratio(len(docs), len(against[run]), len(toxic), len(clean)), len(docs)

    worth = {r: value(r) for r in list(holding)}
    chosen: list[str] = []
    while worth and len(chosen) < most:
        # Values only fall as words are explained, so an old value that is still the best is the best.
        run = max(worth, key=lambda r: (worth[r][0], len(r), r))
        now = value(run)
        if now[0] < worth[run][0]:
            worth[run] = now
            continue
        if now[0] < least or not now[1]:
            break
        # The longest run that nearly the same documents hold says most.
        run = max((r for r in worth if run in r and value(r)[1] >= 0.9 * now[1]), key=lambda r: (len(r), r), default=run)
        chosen.append(run)
        for word in holding[run]:
            spread.pop(word, None)
        del worth[run]
    return chosen


def _runs(word: str) -> set[str]:
    letters = _letters(word)[: 4 * WINDOW]
    n = len(letters)
    return {letters[i: i + k] for k in range(SHORTEST, min(LONGEST, n) + 1) for i in range(n - k + 1)}


def disguised(word: str) -> list[str]:
    """The word with inserted characters."""
    n = len(word)
    return [".".join(word), word[: n // 2] + "-" + word[n // 2:], word[:1] + "*" + word[1:], "_".join(word)]


def fit_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5, steps: int = 30) -> np.ndarray:
    """Weights and intercept of a linear machine with squared hinge loss, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty * weight.sum())
    ridge[-1] = 1e-9
    for _ in range(steps):
        slack = 1 - y * (x @ w)
        on = slack > 0
        gradient = ridge * w - 2 * (x[on] * (weight * y * slack)[on, None]).sum(axis=0)
        hessian = np.diag(ridge) + 2 * (x[on] * weight[on, None]).T @ x[on]
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def fit_logistic(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, with the targets pulled from 0 and 1 by the class sizes (Platt)."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([score, np.ones(len(score))])
    b = np.array([1.0, math.log((n1 + 1) / (n0 + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target))
        b -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(b[0], 1e-6)), float(b[1])


class ToxicityModel:
    """A trained machine; ``constant`` is set when there was nothing to learn."""

    def __init__(self, constant: float | None = None):
        self.constant = constant
        self.known: dict[str, float] = {}

    @classmethod
    def train(cls, texts: list[str], labels: list[int], rounds: int = 5) -> ToxicityModel:
        pool: dict[str, str] = {}  # a word is held once, in however many documents it is
        docs = [{pool.setdefault(w, w) for w in units(t)} for t in texts]
        del pool
        fresh = first_copies(docs)
        docs, labels = [docs[i] for i in fresh], [labels[i] for i in fresh]
        y = np.array(labels, np.float64)
        toxic, clean = [d for d, k in zip(docs, labels) if k], [d for d, k in zip(docs, labels) if not k]
        if not toxic or not clean:
            return cls(float(y.mean()) if len(y) else 0.0)
        runs = choose_landmarks(toxic, clean)
        if not runs:
            return cls(float(y.mean()))
        model = cls()
        clean_parts = sorted({p for w in set().union(*clean) for p in windows(w)})
        probe = SubsequenceKernel(runs)
        scale = np.diag(probe(runs))
        near = np.concatenate([
            (probe(clean_parts[k: k + 20_000]) / scale).max(axis=1) for k in range(0, len(clean_parts), 20_000)
        ]) if clean_parts else np.zeros(0)
        order = np.argsort(-near, kind="stable")
        model.kernel = SubsequenceKernel(runs + [clean_parts[i] for i in order[:LOOKALIKES]])
        own = model.kernel(model.kernel.landmarks).astype(np.float64)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        model.whiten = (vectors / np.sqrt(np.maximum(values, 1e-4 * values.max())) @ vectors.T).astype(np.float32)
        # The clean words that come closest to a landmark, and an even share of the others.
        negative = model.features([clean_parts[i] for i in np.concatenate([order[:15_000], order[15_000::20]])])
        del near, order, clean_parts
        holding = re.compile("|".join(map(re.escape, runs)))
        marked = {w for w in set().union(*docs) if holding.search(_letters(w))}
        held = sorted({p for w in marked & set().union(*toxic) for p in windows(w) if holding.search(_letters(p))})
        sure, of = model.features(held), [holding.search(_letters(p))[0] for p in held]
        # Each landmark's words weigh the same together, however many there are.
        many = Counter(of)
        fair = np.array([1 / many[r] for r in of]) / max(1, len(many))
        changed = model.features([d for r in runs for d in disguised(r)])
        model.w = np.concatenate([(model.kernel(runs) @ model.whiten).sum(axis=0), [0.0]])
        for _ in range(rounds):
            hardest = np.argsort(-(negative @ model.w[:-1]), kind="stable")
            rows = [negative[hardest[:300]], negative[hardest[300:4_000]], negative[::4], sure, changed]
            shares = (3.0, 1.0, 1.0, 2.0, 0.3)
            weight = np.concatenate([np.full(len(b), k / max(1, len(b))) for b, k in zip(rows, shares)])
            weight[sum(map(len, rows[:3])): sum(map(len, rows[:4]))] = 2 * fair
            mark = np.concatenate([np.full(len(b), k) for b, k in zip(rows, (-1.0, -1.0, -1.0, 1.0, 1.0))])
            model.w = fit_machine(np.concatenate(rows), mark, weight)
        # Labels that no landmark explains are a matter of chance to this model: they raise the floor of the scores.
        found = np.array([not marked.isdisjoint(d) for d in docs])
        decisions = np.array(model.decisions(docs))
        plain = found | (y == 0)
        model.slope, model.offset = fit_logistic(decisions[plain], y[plain])
        model.floor = float(y[~found].mean()) if (~found).any() else 0.0
        model.known = {}
        return model

    def features(self, strings: list[str]) -> np.ndarray:
        return self.kernel(strings) @ self.whiten

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The decision value of each word, the best of its windows."""
        cut = [windows(w) for w in words]
        flat = [p for c in cut for p in c]
        values = self.features(flat) @ self.w[:-1] + self.w[-1]
        if len(flat) == len(words):
            return values
        return np.maximum.reduceat(values, np.cumsum([0] + [len(c) for c in cut[:-1]]))

    def learn(self, docs: list[set[str]]) -> None:
        new = set().union(*docs).difference(self.known)
        if len(self.known) + len(new) > CACHED_WORDS:
            self.known.clear()
            new = set().union(*docs)
        order = list(new)
        self.known.update(zip(order, self.word_scores(order).tolist() if order else []))

    def decisions(self, docs: list[set[str]], at_once: int = 200) -> list[float]:
        """The best word's decision value of each document."""
        out = []
        for k in range(0, len(docs), at_once):
            self.learn(docs[k: k + at_once])
            out += [max(map(self.known.__getitem__, d), default=float(self.w[-1])) for d in docs[k: k + at_once]]
            self.known.clear()
        return out

    def scores(self, texts: Iterable[str]) -> Iterator[float]:
        """The score of each text, a few texts at a time."""
        if self.constant is not None:
            for _ in texts:
                yield self.constant
            return
        batch, size = [], 0
        for text in texts:
            batch.append(units(text))
            size += len(batch[-1])
            if size >= CACHED_WORDS // 10:
                yield from self._batch(batch)
                batch, size = [], 0
        yield from self._batch(batch)

    def _batch(self, batch: list[set[str]]) -> Iterator[float]:
        self.learn(batch)
        for doc in batch:
            best = max(map(self.known.__getitem__, doc), default=float(self.w[-1]))
            chance = 1 / (1 + math.exp(-min(35.0, max(-35.0, self.slope * best + self.offset))))
            yield self.floor + (1 - self.floor) * chance


# --- jobs ---


def held_out(doc_id: Column) -> Column:
    """Whether a document's label must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """A model from at most ``sample`` labelled documents of each class, chosen by a hash of their ids.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic. The sample, and nothing else, goes to one task, which is
    run again if its executor is lost; the driver gets the model.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rank = F.xxhash64("doc_id", F.lit("sample"))
    one, none = (usable.where(F.col("toxic") == k).orderBy(rank, "doc_id").limit(sample) for k in (1, 0))
    picked = F.broadcast(one.unionByName(none))  # two times ``sample`` rows of two numbers at most
    rows = docs.join(picked, "doc_id").select("doc_id", "toxic", whole("text").alias("text"))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if held:
            seen = pd.concat(held).drop_duplicates("doc_id").sort_values("doc_id")
            model = ToxicityModel.train(seen["text"].tolist(), seen["toxic"].astype(int).tolist())
            yield pd.DataFrame({"model": [pickle.dumps(model)]})

    made = rows.repartition(1).mapInPandas(fit, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made else ToxicityModel(0.0)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of each row. No shuffle; a task holds one batch and its cache of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(model.scores(t.as_py() for t in batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def scorer(model: ToxicityModel):
    """A function of a text column that gives the score, to filter rows without a join."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(model.scores(texts)), dtype="float64")

    return run


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    scored = score(rows, train(rows, marks, sample))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
