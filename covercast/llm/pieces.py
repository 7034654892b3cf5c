"""Encoding whole texts piece by piece, with every piece that repeats encoded once.

A byte-level tokenizer never joins what stands left of a space with what stands right of it when a visible
character follows the space: the space begins a new pre-token there. So a text may be cut at such spaces,
and the ids of the pieces in order are the ids of the text. Pieces are cut further into pre-tokens, which are
encoded once as well.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space that a visible character follows; and a space that something else follows.
CUT = re.compile(r" (?=\S)")
UNCUT = re.compile(r" (?:\s|$)")

#: ``UNCUT`` for Arrow, whose ``\\s`` knows ASCII only.
SPACE_PAIR = r" (?:[\t-\r\x1c-\x1f\x{85}\p{Z}]|\z)"

#: Fixed value: how byte-level vocabularies of this kind cut a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pieces(text: str) -> list[str]:
    """The text cut at every space before a visible character; all but the first piece lost that space."""
    return CUT.split(text) if UNCUT.search(text) else text.split(" ")


#: Closing marks: neither letters, numbers nor white space.
MARKS = ".,;:!?"


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def piece_lists(texts: pa.StringArray) -> pa.ListArray:
    """The pieces of each text, as a list column."""
    odd = np.array(pc.match_substring_regex(texts, SPACE_PAIR), bool)
    plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    if not odd.any():
        return plain
    others = pa.array([pieces(t) for t in strings(texts.filter(pa.array(odd)))], pa.list_(pa.string()))
    order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
    return pa.concat_arrays([plain, others]).take(pa.array(order))


class Memory(dict):
    """A dict of bounded size: past half of ``limit`` entries it starts anew and keeps the ones it had as ``old``."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def age(self) -> None:
        if len(self) > self.limit // 2:
            self.old = dict(self)
            self.clear()

    def lacking(self, wanted: set[str]) -> list[str]:
        """The wanted keys that are in neither generation; those of the old one are taken over."""
        new = wanted - self.keys()
        if self.old:
            again = new & self.old.keys()
            old = self.old
            self.update((k, old[k]) for k in again)
            new -= again
        return list(new)


class PieceEncoder:
    """Ids of texts as little-endian 32-bit integers.

    encode gives such bytes for each of a list of distinct pre-tokens. A piece that spells out one of the
    ``special`` strings goes to ``encode`` as it is. About ``piece_limit`` pieces and ``word_limit`` pre-tokens
    are remembered, besides those of one call.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        special: Iterable[str] = (),
        piece_limit: int = 200_000,
        word_limit: int = 300_000,
    ):
        import regex

        self.encode = encode
        self.special = [*special]
        self.words_of = regex.compile(PRE_TOKEN).findall
        spelt = "|".join(re.escape(x) for x in self.special)
        self.spelt = re.compile(spelt).search if spelt else None
        self.first, self.spaced, self.words = Memory(piece_limit // 8), Memory(piece_limit), Memory(word_limit)

    def texts(self, texts: list[str]) -> list[bytes]:
        for memory in (self.first, self.spaced, self.words):
            memory.age()
        cut = [pieces(t) for t in texts]
        self._learn(self.first, {c[0] for c in cut}, "")
        self._learn(self.spaced, set(filterfalse(self.spaced.__contains__, chain.from_iterable(cut))), " ")
        first, spaced = self.first, self.spaced
        out = []
        for parts in cut:
            head = first[parts[0]]
            out.append(head + b"".join(map(spaced.__getitem__, parts[1:])) if len(parts) > 1 else head)
        return out

    def lists(self, texts: pa.StringArray, end: bytes = b"") -> pa.ListArray:
        """The ids of each text (no nulls) as a list column, each followed by those of ``end``.

        The texts are cut, and their pieces numbered and replaced by ids, column by column; only distinct ones become strings.
        A piece of letters and closing marks counts as two: the letters are one pre-token, the marks another.
        """
        if not len(texts):
            return id_lists([])
        for memory in (self.first, self.spaced, self.words):
            memory.age()
        cut = piece_lists(texts)
        ends = np.asarray(cut.offsets)[1:].astype(np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        heads = strings(cut.values.take(pa.array(starts)))
        coded = cut.values.dictionary_encode()
        numbers = np.asarray(coded.indices).astype(np.int64)
        after_space = np.ones(len(numbers), bool)
        after_space[starts] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[numbers[after_space]] = True
        spaced = coded.dictionary.filter(pa.array(used))
        letters = pc.utf8_rtrim(spaced, characters=MARKS)
        worded = np.array(pc.utf8_is_alpha(letters), bool)
        for x in self.special:
            worded &= ~np.array(pc.match_substring(spaced, x), bool)
        longer = worded & np.array(pc.greater(pc.binary_length(spaced), pc.binary_length(letters)), bool)
        bodies = letters.filter(pa.array(worded)).dictionary_encode()
        tails = pc.replace_substring_regex(spaced.filter(pa.array(longer)), f"[^{MARKS}]+", "").dictionary_encode()
        others = strings(spaced.filter(pa.array(~worded)))
        self._learn(self.first, set(heads), "")
        found = [end, b""]
        # The places in ``found`` of the two parts of each distinct piece, each head and the end.
        parts = np.ones((len(spaced) + len(heads) + 1, 2), np.int64)
        of_spaced, of_heads = parts[: len(spaced)], parts[len(spaced) : -1]
        of_spaced[worded, 0] = len(found) + np.asarray(bodies.indices)
        found += self._letters(strings(bodies.dictionary))
        of_spaced[longer, 1] = len(found) + np.asarray(tails.indices)
        found += self._marks(strings(tails.dictionary))
        of_spaced[~worded, 0] = len(found) + np.arange(len(others))
        found += self._mixed(others)
        of_heads[:, 0] = len(found) + np.arange(len(heads))
        found += map(self.first.__getitem__, heads)
        parts[-1, 0] = 0
        numbers = (np.cumsum(used) - 1)[numbers]
        numbers[starts] = len(spaced) + np.arange(len(heads))
        numbers = np.insert(numbers, ends, len(parts) - 1)
        places = parts[numbers].ravel()
        ids = id_lists(found)
        at = np.concatenate([[0], np.cumsum(np.diff(np.asarray(ids.offsets))[places], dtype=np.int64)])
        offsets = at[2 * np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), ids.take(pa.array(places)).values)

    def _letters(self, words: list[str]) -> list[bytes]:
        """The ids of pieces of letters alone."""
        known = self.spaced
        missing = known.lacking({w for w in words if w not in known})
        known.update(zip(missing, self.encode([" " + w for w in missing])))
        return [*map(known.__getitem__, words)]

    def _marks(self, marks: list[str]) -> list[bytes]:
        """The ids of closing marks that follow letters."""
        known = self.words
        missing = known.lacking(set(marks))
        known.update(zip(missing, self.encode(missing)))
        return [*map(known.__getitem__, marks)]

    def _mixed(self, pieces: list[str]) -> list[bytes]:
        """The ids of other pieces. They seldom repeat, so only their pre-tokens are remembered."""
        cut = [self._words(" " + p) for p in pieces]
        wanted = set().union(*cut)
        spaced = [w for w in wanted if w[0] == " " and w[1:].isalpha()]
        found = dict(zip(spaced, self._letters([w[1:] for w in spaced])))
        wanted.difference_update(spaced)
        missing = self.words.lacking(wanted)
        self.words.update(zip(missing, self.encode(missing)))
        found.update((w, self.words[w]) for w in wanted)
        return [b"".join(map(found.__getitem__, parts)) for parts in cut]

    def _learn(self, known: Memory, wanted: set[str], before: str) -> None:
        missing = known.lacking(wanted)
        if not missing:
            return
        # Letters alone are one pre-token.
        cut = [[before + m] if m.isalpha() else self._words(before + m) for m in missing]
        words = self.words
        unknown = words.lacking(set().union(*cut))
        if unknown:
            words.update(zip(unknown, self.encode(unknown)))
        known.update(
            (piece, words[parts[0]] if len(parts) == 1 else b"".join([words[w] for w in parts]))
            for piece, parts in zip(missing, cut)
        )

    def _words(self, piece: str) -> list[str]:
        return [piece] if self.spelt and self.spelt(piece) else self.words_of(piece)


@contextmanager
def without_cycles() -> Iterator[None]:
    """No search for cycles meanwhile: strings in lists and dicts form none, but would be walked again and again."""
    was_on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()


def chunks(batch: pa.RecordBatch, column: int, size: int = 2_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows with about ``size`` characters of text: where each starts, and its texts (null: empty)."""
    held: list[str] = []
    start, chars = 0, 0
    values = batch.column(column)
    for i in range(batch.num_rows):
        text = values[i].as_py() or ""
        held.append(text)
        chars += len(text)
        if chars >= size:
            yield start, held
            held, start, chars = [], i + 1, 0
    if held:
        yield start, held


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text (null: none)."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = min(int(np.searchsorted(ends, before + size)) + 1, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def id_lists(ids: Iterable[bytes]) -> pa.ListArray:
    """A list column of 32-bit integers from the bytes of each list."""
    ids = list(ids)
    sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def id_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column, as arrays; row ``i`` is ``values[offsets[i]:offsets[i + 1]]``."""
    offsets = np.asarray(column.offsets)
    values = np.ascontiguousarray(np.asarray(column.values), "<i4")
    return values, offsets
