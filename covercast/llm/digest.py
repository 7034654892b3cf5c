"""Document fingerprints that stay close when a text changes a little.

Every window of five bytes gives six triplets that contain its first byte; each triplet is hashed into one
of ``BUCKETS`` counters. The fingerprint holds two bits per counter, its place among the quartiles of all
counters, besides the length on a logarithmic scale and the ratios of the quartiles. Two fingerprints
are compared by a difference score with a known maximum.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.llm.spread import with_follower
from covercast.llm.storage import importable

BUCKETS = 256
SHIFT = 32 - BUCKETS.bit_length() + 1
#: The places of the other two bytes of a triplet, as distances from the first.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
#: Bytes before the bucket codes: length, and the two quartile ratios.
HEADER = 3
LENGTH_WEIGHT, RATIO_WEIGHT = 4, 1
#: Difference of two codes: 0, 1, 2, and 6 for opposite ends.
CODE_DIFFERENCE = np.array([0, 1, 2, 6])
#: Difference at which the likeness is 0: that of unrelated codes, which are uniform and independent.
UNRELATED = BUCKETS * (6 * 1 + 4 * 2 + 2 * 6) / 16


def fingerprint(text: str) -> str:
    """Lowercase hex digits; equal texts have equal fingerprints, an empty text that of no triplets."""
    data = np.frombuffer(text.encode(), np.uint8).astype(np.uint32)
    n = len(data)
    counts = np.zeros(BUCKETS, np.int64)
    for salt, (i, j) in enumerate(TRIPLETS, 1):
        if n > j:
            mixed = data[: n - j] | (data[i : n - j + i] << 8) | (data[j:] << 16)
            mixed ^= np.uint32(salt << 24)
            mixed *= np.uint32(0x9E3779B1)
            mixed ^= mixed >> 15
            mixed *= np.uint32(0x85EBCA77)
            counts += np.bincount(mixed >> SHIFT, minlength=BUCKETS)
    ranked = np.sort(counts)
    q1, q2, q3 = (int(ranked[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes[0::4] | (codes[1::4] << 2) | (codes[2::4] << 4) | (codes[3::4] << 6)
    length = min(255, round(8 * math.log2(1 + n)))
    ratios = [min(255, 255 * q // q3) if q3 else 0 for q in (q1, q2)]
    return bytes([length, *ratios]).hex() + packed.tobytes().hex()


def difference(a: str, b: str) -> int:
    """0 for equal fingerprints; at most ``6 * BUCKETS`` and the header's share."""
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint8) for s in (a, b))
    head = np.abs(x[:HEADER].astype(int) - y[:HEADER])
    codes = [np.stack([(v[HEADER:] >> s) & 3 for s in (0, 2, 4, 6)]) for v in (x, y)]
    apart = CODE_DIFFERENCE[np.abs(codes[0].astype(np.int8) - codes[1].astype(np.int8))].sum()
    return int(apart + LENGTH_WEIGHT * (head[0] // 8) + RATIO_WEIGHT * ((head[1] + head[2]) // 32))


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, 0 from the difference of unrelated codes on."""
    return max(0.0, 1.0 - difference(a, b) / UNRELATED)


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, bool]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py() or "", batch.column(2)[i].as_py()


def _digest_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own rows of a part in order, then copies of the row that follows, to rows of ``SCHEMA``."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
        + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    held: list[tuple] = []
    before = None
    for doc_id, text, extra in _rows(batches):
        own = fingerprint(text)
        if before is not None:
            last_id, last, mark = before
            half = len(last) // 2
            edited = last[: len(last) - half] + text[:half]
            edited_mark = fingerprint(edited)
            held.append(
                (last_id, len(last), hashlib.sha256(edited.encode()).hexdigest(), mark, edited_mark)
                + (likeness(mark, edited_mark), likeness(mark, own))
            )
        if extra:
            break
        before = (doc_id, text, own)
        if len(held) >= 2_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness and that to the next document.

    The edited text has its last half (rounded down) replaced by as much of the start of the next document;
    after the last one, the first comes. Null texts count as empty. Order: key ascending, nulls first, rows of
    one key by text; equal rows are each other's next. A single row is its own next; an empty
    table gives no rows. Other columns are not read.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    placed = with_follower(rows, "doc_id", ["text"]).select("doc_id", "text", "extra")
    return placed.mapInArrow(_digest_partition, SCHEMA)
