"""64-bit hashes of the words of a text and of their shingles, by array operations over the bytes."""

from __future__ import annotations

import numpy as np

WIDTH = 5
PLACES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A") : ord("Z") + 1] += np.uint64(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(data: np.ndarray, fold: bool = True) -> np.ndarray:
    """One hash per word of UTF-8 bytes; words stand between ASCII white space, A-Z count as a-z with ``fold``."""
    blank = SPACE[data]
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(data) else np.zeros(0, np.int64)
    if not len(begins):
        return np.zeros(0, np.uint64)
    # Where each byte stands in its word; blanks add nothing.
    kind = np.int32 if len(data) < 1 << 31 else np.int64
    start = np.zeros(len(data), kind)
    start[begins] = begins
    place = np.arange(len(data), dtype=kind) - np.maximum.accumulate(start, out=start)
    values = LOWER[data] if fold else data.astype(np.uint64)
    values += np.uint64(1)
    values *= PLACES[place & 255]
    # Words beyond 256 bytes: the same place in another turn counts differently.
    if place.max() > 255:
        values = values * (np.uint64(2) * (place >> 8).astype(np.uint64) + np.uint64(1))
    values[blank] = 0
    return mixed(np.add.reduceat(values, begins))


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``WIDTH`` words in a row, ascending, and how often each occurs.

    A text of fewer words has one shingle of all of them; one without words has none.
    """
    words = word_hashes(np.frombuffer(text.encode(), np.uint8))
    if not len(words):
        return words, np.zeros(0, np.int64)
    width = min(WIDTH, len(words))
    joined = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        joined = mixed(joined * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - width + 1 + i])
    return np.unique(joined, return_counts=True)
