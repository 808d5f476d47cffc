"""Word-shingle sets as sorted 64-bit hashes, and their min-max signatures, for blocks of texts in numpy.

Words are runs of anything but ASCII white space, with A-Z in lower case. All texts of a block are hashed at once: a
prefix sum of byte values times powers of an odd number gives the hash of any run of bytes by a subtraction.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Texts hashed at once. A block's arrays take some 60 bytes a byte, which a worker that lives on keeps from the system.
BLOCK_BYTES = 1 << 18

_random = np.random.Generator(np.random.PCG64(20_240_229))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDER = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = _random.integers(0, 2**64, 4_096, dtype=np.uint64)
_FACTORS = _random.integers(1, 2**63, 4_096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + BLOCK_BYTES // 4)
        tables = []
        for base in (_BASE, _UNBASE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if n > BLOCK_BYTES * 8:  # one very long text: not kept
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in a row, and where each text's words begin (one more entry than texts)."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
    blank = _BLANK[data]
    edge = np.diff(blank.view(np.int8), prepend=np.int8(1))
    first, after = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = powers(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    hashed = mix((total[after] - total[first]) * down[first] + (after - first).astype(np.uint64))
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return hashed, np.searchsorted(first, begins)


def shingle_sets(texts: Iterable[str | None], n: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its n-word shingles.

    A text with fewer words is one shingle; one without words, or null, has none.
    """
    for block in _blocks(texts):
        hashed, begins = word_hashes(block)
        runs = np.zeros(max(0, len(hashed) - n + 1), np.uint64)
        for k in range(n):
            runs += hashed[k: k + len(runs)] * _ORDER[k]
        runs = mix(runs)
        for low, high in zip(begins[:-1].tolist(), begins[1:].tolist()):
            if high - low >= n:
                yield np.unique(runs[low: high - n + 1])
            else:
                few = hashed[low:high]
                yield mix((few * _ORDER[: len(few)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(few))) if len(
                    few
                ) else few


def _blocks(texts: Iterable[str | None]) -> Iterator[list[bytes]]:
    block, size = [], 0
    for text in texts:
        block.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(block[-1])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def min_max(values: np.ndarray, permutations: int) -> np.ndarray:
    """The signature: least values of a set under each permutation, then the greatest.

    A permutation is the upper half of the hash, after an exclusive or with a random seed, times a random odd number;
    it is evaluated once for both.
    """
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    seeds, factors = _SEEDS[:permutations, None], _FACTORS[:permutations, None]
    for at in range(0, len(values), 1_024):
        seen = values[None, at: at + 1_024] ^ seeds
        seen *= factors
        np.minimum(low, seen.min(axis=1), out=low)
        np.maximum(high, seen.max(axis=1), out=high)
    return (np.concatenate([low, high]) >> np.uint64(32)).astype(np.uint32)


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A hash for each band of each signature; a band takes minima and maxima of several permutations."""
    rows = signatures.reshape(len(signatures), -1, bands).astype(np.uint64)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(signatures), bands))
    for k in range(rows.shape[1]):
        keys = mix(keys * _ORDER[0] + rows[:, k])
    return keys


def jaccard_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared, len(both) - shared
