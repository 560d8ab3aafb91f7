"""Vectorised hashes of the words of a batch of texts (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    return x


def word_table(data: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every run of bytes that ``letter`` marks.

    A word's hash sums a scramble of each (byte, place in the word), so it takes
    a few array passes whatever the words are. The last byte is no letter.
    """
    edge = np.diff(letter.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    sizes = ends - starts
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    each = mix((data[letter].astype(np.uint64) + np.uint64(1)) + (place.astype(np.uint64) << np.uint64(9)))
    return mix(np.add.reduceat(each, first) + sizes.astype(np.uint64)), starts, ends


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the index of each text's first word (and the end).

    Words are the runs between the six white-space bytes.
    """
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    stops = np.cumsum([len(t) + 1 for t in texts])
    words, starts, _ = word_table(data, ~_SPACE[data])
    if not len(words):
        return words, np.zeros(len(texts) + 1, np.int64)
    return words, np.concatenate(([0], np.searchsorted(starts, stops)))


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words (none if there are fewer)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out = mix(out + words[j:j + n])
    return out


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle, no word none."""
    return np.unique(grams(words, min(size, len(words)))) if len(words) else words
