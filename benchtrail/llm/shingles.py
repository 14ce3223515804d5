"""Hashed word shingles of texts, as numpy arrays."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
_WEIGHTS = np.random.default_rng(5).integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every bit of the input moves all bits of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash per word (bytes between white space), in order."""
    b = np.frombuffer(raw, np.uint8)
    inside = ~_GAP[b]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    letters = b[inside].astype(np.uint64) + np.uint64(1)
    first = np.append(0, np.cumsum(sizes)[:-1])
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    return mix(np.add.reduceat(letters * _powers(int(sizes.max()))[place], first) + sizes.astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the word 5-grams of a text in lower case (A-Z);
    a shorter text is one shingle, one without a word has none."""
    words = word_hashes((text or "").encode(errors="replace").lower())
    k = min(SHINGLE, len(words))
    if not k:
        return words
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        total += words[i:len(words) - k + 1 + i] * _WEIGHTS[i]
    return np.unique(mix(total))


def set_key(members: np.ndarray) -> int:
    """A 64-bit key of a set, as a signed integer."""
    key = mix(np.array([mix(members).sum(dtype=np.uint64) + np.uint64(len(members))], np.uint64))
    return int(key.astype(np.int64)[0])
