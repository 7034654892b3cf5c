"""Byte-level BPE with a pair occurrence index.

All distinct pre-tokens of a batch stand in one array of symbols with links to the next and the previous
symbol. An index maps each adjacent pair to all its positions. The ranks that occur are applied in ascending
order; a merge at all positions of its pair is a few array operations, after which only the lists of the pairs
left and right of the merged places grow. A pair that contains a merged symbol ranks after the merge that
made the symbol, so no rank has to be visited twice.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.llm.pieces import PRE_TOKEN, PieceEncoder, chunks, id_lists, id_values, without_cycles
from covercast.llm.storage import importable

def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


def rising(places: np.ndarray) -> np.ndarray:
    """The places in ascending order, each once."""
    places.sort()
    new = np.ones(len(places), bool)
    np.not_equal(places[1:], places[:-1], out=new[1:])
    return places[new]


class PairIndexBpe:
    """Encoder and decoder for the vocabulary, merges and added tokens of a tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        vocab: dict[str, int] = content["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_ids = np.array([vocab[c] for c in letters], np.int64)
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in content.get("added_tokens", []))])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
        left, right, made = (
            np.array([vocab[x] for x in column], np.int64)
            for column in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs])
        )
        keys = left * self.size + right
        self.left, self.right, self.made = left, right, made
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.added = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.pre_token = regex.compile(PRE_TOKEN)
        spelt = "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.special = regex.compile(f"({spelt})") if spelt else None

    def rank_of(self, keys: np.ndarray) -> np.ndarray:
        """Rank of each pair key, or -1."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit integers."""
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        sym = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        n = len(sym)
        # Links; -1 stands before the first and after the last symbol of a word.
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[ends[sizes > 0] - 1] = -1
        prv[(ends - sizes)[sizes > 0]] = -1
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def enlist(places: np.ndarray) -> None:
            """Add the pairs that start at these places to the index."""
            ranks = self.rank_of(sym[places] * self.size + sym[nxt[places]])
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not len(places):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, group in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts)):
                if rank in index:
                    index[rank].append(group)
                else:
                    index[rank] = [group]
                    heapq.heappush(queue, rank)

        enlist(np.flatnonzero(nxt >= 0))
        while queue:
            rank = heapq.heappop(queue)
            held = index.pop(rank)
            at = held[0] if len(held) == 1 else rising(np.concatenate(held))
            a, b, c = self.left[rank], self.right[rank], self.made[rank]
            after = nxt[at]
            # Places whose pair went away in an earlier merge drop out; a consumed symbol is -1.
            at = at[(sym[at] == a) & (after >= 0) & (sym[after] == b)]
            if a == b and len(at) > 1:
                at = self._apart(at, nxt)
            if not len(at):
                continue
            gone = nxt[at]
            beyond = nxt[gone]
            sym[at], sym[gone] = c, -1
            nxt[at] = beyond
            prv[beyond[beyond >= 0]] = at[beyond >= 0]
            before = prv[at]
            enlist(rising(np.concatenate([at[beyond >= 0], before[before >= 0]])))
        kept = sym >= 0
        ids = sym[kept].astype("<i4")
        stops = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])] * 4
        data = ids.tobytes()
        return [data[x:y] for x, y in zip(stops[:-1].tolist(), stops[1:].tolist())]

    @staticmethod
    def _apart(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Of overlapping places of a pair of equal symbols every second, from the left."""
        starts = np.flatnonzero(np.concatenate([[True], nxt[at[:-1]] != at[1:]]))
        lengths = np.diff(np.concatenate([starts, [len(at)]]))
        return at[(np.arange(len(at)) - np.repeat(starts, lengths)) % 2 == 0]

    def pre_tokens(self, text: str) -> list[str | int]:
        """Pre-tokens of a text, and ids where added tokens are spelt out."""
        if self.special is None or not self.special.search(text):
            return self.pre_token.findall(text)
        found: list[str | int] = []
        for part in self.special.split(text):
            found.extend([self.added[part]] if part in self.added else self.pre_token.findall(part))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        cut = [self.pre_tokens(t) for t in texts]
        words = list({w for parts in cut for w in parts if isinstance(w, str)})
        known: dict[str | int, bytes] = dict(zip(words, self.merge([w.encode() for w in words])))
        for i in self.added.values():
            known[i] = np.int32(i).astype("<i4").tobytes()
        return [known[p[0]] if len(p) == 1 else b"".join(map(known.__getitem__, p)) for p in cut]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that form no character become the replacement character."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


#: Characters of text that are encoded and decoded at a time.
BOTH_CHARS = 1_000_000


@lru_cache(maxsize=2)
def bpe(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


@lru_cache(maxsize=2)
def bpe_pieces(path: str) -> PieceEncoder:
    return PieceEncoder(bpe(path).encode, bpe(path).added)


def _encode_partition(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder = bpe_pieces(path)
    for batch in batches:
        for at, texts in chunks(batch, 1):
            some = batch.slice(at, len(texts))
            with without_cycles():
                ids = id_lists(encoder.texts(texts))
            yield pa.RecordBatch.from_arrays([some.column(0), ids], ["doc_id", "ids"])


def _decode_partition(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = bpe(path)
    for batch in batches:
        values, offsets = id_values(batch.column(1))
        texts = [model.decode(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
        )


def _both_partition(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encoder, model = bpe_pieces(path), bpe(path)
    for batch in batches:
        for at, texts in chunks(batch, 1, BOTH_CHARS):
            keys = batch.column(0).slice(at, len(texts))
            with without_cycles():
                ids = id_lists(encoder.texts(texts))
            values, offsets = id_values(ids)
            texts = [model.decode(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([keys, ids, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every row, in the place of the row: no shuffle.

    tokenizer: tokenizer file with byte-level BPE, no normalizer and the usual pre-token pattern; special
    tokens are not added, and those spelt out in a text become their id. Null and empty texts give no ids; rows that repeat
    are encoded as often; the key may be of any type and null. Other columns are not read.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _encode_partition(it, tokenizer), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text) of the rows of ``encode``; special tokens are kept, no ids give an empty text."""
    importable(encoded.sparkSession)
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _decode_partition(it, tokenizer), f"doc_id {kind}, ids array<int>, text string")


def encode_decode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, text) of every row as ``decode`` gives them for ``encode``, in one pass by one worker per task."""
    importable(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda it: _both_partition(it, tokenizer), f"doc_id {kind}, ids array<int>, text string")
