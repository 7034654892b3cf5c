"""Stretches of words that repeat with a period inside a document, from the maximal pairs of its words.

A maximal pair is two equal stretches of words that differ in the word before and in the word after. Two equal stretches of ``n`` words
whose starts are ``q <= n`` words apart form one stretch of ``n + q`` words with period ``q``; if the pair is maximal, no
neighbouring word extends it. So the maximal pairs with a distance of at most their length are the runs, and no run has to be
extended. The pair of a run and its smallest period is one of neighbouring occurrences: another one between would give
a smaller period. Pairs of larger periods give the same stretch, of which the smallest period stays.

Pairs are enumerated over the LCP-interval tree of the suffix array, bottom-up. The places of an interval stand in a list
ordered by place, each with its class, the word left of it. Where intervals are joined, places of the smaller list go
into the larger one; a place and its new neighbours are pairs of the interval's depth, and those of different class are
maximal. Only intervals of depth ``least / 2`` or more can hold a run, so the tree is built over the stretches that
repeat so many words; other words are left out, with a mark that matches nothing in their place.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.llm.pieces import chunks
from covercast.llm.storage import importable

LEAST = 12
#: Places in one piece of an ordered list.
PIECE = 512
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Places:
    """Ordered whole numbers in pieces of bounded size, with the neighbours of each one that is put in."""

    def __init__(self, place: int):
        self.pieces = [[place]]
        self.tops = [place]
        self.size = 1

    def put(self, place: int) -> tuple[int, int]:
        """Insert; the places before and after, -1 where there is none."""
        pieces, tops = self.pieces, self.tops
        at = bisect_left(tops, place)
        if at == len(tops):
            at -= 1
            tops[at] = place
        piece = pieces[at]
        i = bisect_left(piece, place)
        before = piece[i - 1] if i else pieces[at - 1][-1] if at else -1
        after = piece[i] if i < len(piece) else pieces[at + 1][0] if at + 1 < len(pieces) else -1
        piece.insert(i, place)
        self.size += 1
        if len(piece) > 2 * PIECE:
            pieces[at : at + 1] = [piece[:PIECE], piece[PIECE:]]
            tops[at : at + 1] = [piece[PIECE - 1], piece[-1]]
        return before, after

    def __iter__(self) -> Iterator[int]:
        for piece in self.pieces:
            yield from piece


def numbered(words: list[bytes]) -> np.ndarray:
    """A number per word, equal for equal words, from 0."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def repeated_places(ids: np.ndarray, width: int) -> np.ndarray:
    """Places where ``width`` words begin that begin elsewhere too, and, by chance of a hash, few others."""
    n = len(ids) - width + 1
    if n < 2:
        return np.zeros(0, np.int64)
    values = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    mixed = np.zeros(n, np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + values[i : i + n]
    order = np.argsort(mixed)
    ranked = mixed[order]
    same = ranked[1:] == ranked[:-1]
    often = np.zeros(n, bool)
    often[1:] = same
    often[:-1] |= same
    return np.sort(order[often])


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in ascending order, by ranks of their first words, twice as many in each round."""
    n = len(ids)
    base = int(ids.max()) + 2
    # As many words as fit one number are compared at once; 0 stands past the end.
    width = max(1, min(n, int(62 / max(1.0, np.log2(base)))))
    padded = np.concatenate([ids + 1, np.zeros(width, np.int64)])
    keys = np.zeros(n, np.int64)
    for i in range(width):
        keys = keys * base + padded[i : i + n]
    while True:
        order = np.argsort(keys)
        ranked = keys[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], ranked[1:] != ranked[:-1]]))
        if rank[order[-1]] == n or width >= n:
            return order
        keys = rank * (n + 1)
        keys[: n - width] += rank[width:]
        width *= 2


def common_lengths(ids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words that each suffix in order has in common with the one before it; 0 for the first."""
    n = len(ids)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words, found, length = ids.tolist(), [0] * n, 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            length = 0
            continue
        end = n - max(i, j)
        while length < end and words[i + length] == words[j + length]:
            length += 1
        found[i] = length
        if length:
            length -= 1
    return np.array(found, np.int64)[order]


def maximal_pairs(order: np.ndarray, common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(place, later place, words in common) of neighbouring occurrences, bottom-up over the intervals of depth ``least`` or more."""
    shallow = np.flatnonzero(common < least)
    bounds = np.append(shallow, len(common))
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if stop - start < 2:
            continue
        places, depths = order[start:stop].tolist(), common[start:stop].tolist()
        if stop - start == 2:
            yield min(places), max(places), depths[1]
            continue
        # Open intervals, from the root down: depth and list of places.
        open_depths, open_lists = [], [Places(places[0])]
        for place, depth in zip(places[1:] + [-1], depths[1:] + [0]):
            while open_depths and open_depths[-1] > depth:
                yield from _join(open_lists, open_depths.pop())
            if place >= 0:
                if open_depths and open_depths[-1] == depth:
                    yield from _join(open_lists, depth)
                else:
                    open_depths.append(depth)
                open_lists.append(Places(place))


def _join(lists: list[Places], depth: int) -> Iterator[tuple[int, int, int]]:
    """Make the last two lists one; the pairs of each place of the smaller one and its neighbours in the larger one."""
    small, large = lists.pop(), lists.pop()
    if small.size > large.size:
        small, large = large, small
    last = -1
    for place in small:
        before, after = large.put(place)
        # Two places of the smaller list have more than this depth in common.
        if before != last:
            yield before, place, depth
        if after >= 0:
            yield place, after, depth
        last = place
    lists.append(large)


def runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``least`` words and two periods, by start, then period."""
    depth = -(-least // 2)
    at = repeated_places(ids, depth)
    if not len(at):
        return []
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + depth, -1)
    kept = np.flatnonzero(np.cumsum(covered[:-1]) > 0)
    # Kept words, and after each stretch of them a mark that is like no other.
    new = np.flatnonzero(np.diff(kept) > 1) + 1
    place = np.insert(kept, new, -1)
    marks = place < 0
    words = ids[place]
    words[marks] = int(ids.max()) + 1 + np.arange(marks.sum())
    _, words = np.unique(words, return_inverse=True)
    order = suffix_order(words)
    common = common_lengths(words, order)
    found: dict[tuple[int, int], int] = {}
    # The class of a place: the word left of it; the first word of all has one of its own.
    left = np.concatenate([[-1], ids[:-1]])[place].tolist()
    original = place.tolist()
    for i, j, length in maximal_pairs(order, common, depth):
        period = j - i
        if period <= length and length + period >= least and left[i] != left[j]:
            key = (original[i], length + period)
            found[key] = min(found.get(key, period), period)
    return sorted(((start, length, q) for (start, length), q in found.items()), key=lambda r: (r[0], r[2]))


def first_periods(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


Rewrite = Callable[[object, list[bytes]], list[bytes]]


def _runs_partition(batches: Iterator[pa.RecordBatch], least: int, rewrite: Rewrite | None) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, n_words, runs, collapsed)."""
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    for batch in batches:
        for at, texts in chunks(batch, 1):
            keys = batch.column(0).slice(at, len(texts))
            rows = []
            for key, text in zip(keys.to_pylist(), texts):
                words = text.encode().split()
                if rewrite:
                    words = rewrite(key, words)
                found = runs(numbered(words), least) if len(words) >= least else []
                stay = compress(words, first_periods(len(words), found)) if found else words
                stretches = [dict(zip(("start", "length", "period"), r)) for r in found]
                rows.append((len(words), stretches, b" ".join(stay).decode()))
            new = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), kind, pa.string()))]
            yield pa.RecordBatch.from_arrays([keys, *new], ["doc_id", "n_words", "runs", "collapsed"])


def detect(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, rewrite: Rewrite | None = None
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row, in the place of the row: no shuffle.

    Words stand between ASCII white space and are numbered from 0. runs: start, length and smallest period of each stretch of at
    least ``least`` words and two periods that no neighbouring word extends, by start, then period. collapsed: the text without the words
    of any run after its first period, joined by one space. rewrite: from key and words to the words to be looked at. Null and empty
    texts have no words, no runs and an empty collapsed text; the key may be null and repeat; other columns are not read. Time
    grows with n log n and memory with n for a text of n words, however often a word repeats.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda it: _runs_partition(it, least, rewrite), f"doc_id {kind}, n_words bigint, runs {RUNS}, collapsed string"
    )
