"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A text is counted into hashed terms: byte triplets without case, runs of character classes (which show capitals,
symbols, tables and digits), and how often words repeat. Term counts on a logarithmic scale, weighted by rarity, are
projected onto the leading singular vectors of a bounded sample of labelled texts. The projected sample and its
labels are broadcast; every document is compared with all of them, in blocks, by cosine, and the nearest vote with
their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.llm.storage import importable
from covercast.llm.wordhash import word_hashes

TRIPLET_TERMS, SHAPE_TERMS, REPEAT_TERMS = 2048, 1024, 8
TERMS = TRIPLET_TERMS + SHAPE_TERMS + REPEAT_TERMS
SAMPLE, LATENT, NEIGHBOURS = 3000, 48, 7
THRESHOLD = 0.3


def _classes() -> np.ndarray:
    """Character class of each byte: letters by case, digits, white space, bytes beyond ASCII; others by themselves."""
    table = np.arange(256, dtype=np.uint32)
    table[ord("a") : ord("z") + 1] = 1
    table[ord("A") : ord("Z") + 1] = 2
    table[ord("0") : ord("9") + 1] = 3
    table[128:] = 1
    table[[9, 10, 11, 12, 13]] = 4
    table[32] = 5
    return table


CLASSES = _classes()
LOWER = np.arange(256, dtype=np.uint32)
LOWER[ord("A") : ord("Z") + 1] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    return x * np.uint32(0x85EBCA77)


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed terms of a text."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.zeros(TERMS, np.float32)
    n = len(data)
    if n >= 3:
        low = LOWER[data]
        keys = _mixed(low[:-2] | (low[1:-1] << 8) | (low[2:] << 16)) >> np.uint32(21)
        counts[:TRIPLET_TERMS] = np.bincount(keys, minlength=TRIPLET_TERMS)
    shape = CLASSES[data]
    # Runs of one class count once; two symbols of a kind in a row stay visible as a doubled one.
    turns = np.flatnonzero(shape[1:] != shape[:-1]) + 1 if n else np.array([], np.int64)
    starts = np.concatenate([[0], turns]) if n else turns
    runs = shape[starts] | ((np.diff(np.append(starts, n)) > 1).astype(np.uint32) << 8)
    if len(runs) >= 3:
        keys = _mixed(runs[:-2] ^ (runs[1:-1] << 9) ^ (runs[2:] << 18)) >> np.uint32(22)
        counts[TRIPLET_TERMS : TRIPLET_TERMS + SHAPE_TERMS] = np.bincount(keys, minlength=SHAPE_TERMS)
    counts[-REPEAT_TERMS:] = _repeats(data)
    return counts


def _repeats(data: np.ndarray) -> list[float]:
    """Words that equal the one 1, 2, 3 or 4 places before, all words, and words seen before anywhere."""
    sums = word_hashes(data, fold=False)
    if not len(sums):
        return [0.0] * REPEAT_TERMS
    equal = [float((sums[k:] == sums[:-k]).sum()) for k in (1, 2, 3, 4)]
    distinct = len(np.unique(sums))
    n = len(sums)
    return [*equal, n / 16, float(n - distinct) / 16, 64 * equal[0] / n, 64 * max(equal[1:]) / n]


def quantized(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale in a byte each."""
    return np.minimum(255, np.rint(16 * np.log2(1 + counts))).astype(np.uint8)


@dataclass
class Voters:
    """Term weights and projection, projected labelled texts of unit length, and their labels."""

    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def project(self, levels: np.ndarray) -> np.ndarray:
        x = levels.astype(np.float32) * self.weight
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        y = x @ self.basis
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)

    def scores(self, levels: np.ndarray, block: int = 256) -> np.ndarray:
        """Share of label 1 among the nearest labelled texts, weighted by similarity; 0.5 without voters."""
        if not len(self.labels):
            return np.full(len(levels), 0.5)
        out = np.empty(len(levels))
        k = min(self.neighbours, len(self.labels))
        for at in range(0, len(levels), block):
            cosine = self.project(levels[at : at + block]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            # Differences between near neighbours count more than the cosine itself shows.
            vote = np.maximum(np.take_along_axis(cosine, near, axis=1).astype(np.float64), 0.0) ** 8 + 1e-9
            out[at : at + block] = (vote * self.labels[near]).sum(axis=1) / vote.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def fit(levels: np.ndarray, labels: np.ndarray, latent: int = LATENT, neighbours: int = NEIGHBOURS) -> Voters:
    """Singular vectors of the labelled sample, by subspace iteration from a fixed start."""
    n = len(levels)
    spread = (levels > 0).sum(axis=0)
    weight = (np.log((1 + n) / (1 + spread)) + 0.1).astype(np.float32)
    x = levels.astype(np.float32) * weight
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    basis = np.random.default_rng(0).standard_normal((TERMS, min(latent, TERMS))).astype(np.float32)
    for _ in range(6 if n else 0):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    model = Voters(weight, basis, np.zeros((0, basis.shape[1]), np.float32), labels.astype(np.float64), neighbours)
    if n:
        model.vectors = model.project(levels)
    return model


def held_out(key: str = "doc_id"):
    """Whether a row is kept from the learner: crc32 of the key as text, modulo 5, is 0."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def _levels_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        levels = [quantized(term_counts(x.as_py() or "")).tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(levels, pa.binary())], ["label", "levels"])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    latent: int = LATENT,
    neighbours: int = NEIGHBOURS,
) -> Voters:
    """Voters from at most ``sample`` labelled rows that are not held out, drawn by a hash of the key.

    Only the term counts of these rows, a byte each, reach the driver. Rows whose key or label is null, and labels
    other than 0 and 1, teach nothing; without any label every score is 0.5.
    """
    importable(docs.sparkSession)
    lots = 1 << 40
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(lots))
    usable = (
        labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
        .dropDuplicates(["doc_id"])
    )
    # The lowest lots are drawn; those far beyond the sample are left out before rows come together.
    share = (sample + 10 * sample**0.5 + 100) / max(1, usable.count())
    drawn = usable.filter(lot < int(min(1.0, share) * lots)).orderBy(lot, "doc_id").limit(sample)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    taught = rows.join(F.broadcast(drawn), "doc_id").select("label", "text")
    found = taught.mapInArrow(_levels_partition, "label int, levels binary").collect()
    # Repeated rows of a key, and the order in which tasks end, do not change the model.
    found = sorted((bytes(r["levels"]), r["label"]) for r in found)
    levels = np.frombuffer(b"".join(x for x, _ in found), np.uint8).reshape(len(found), TERMS)
    return fit(levels, np.array([y for _, y in found], np.float64), latent, neighbours)


def score(docs: DataFrame, model: Voters, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score of its text, 0 to 1, in the place of the row: no shuffle.

    Null texts count as empty; an empty text has no terms and gets the votes of arbitrary, equally unlike neighbours.
    A column of that name is replaced; all others are kept.
    """
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(texts):
        levels = np.empty((len(texts), TERMS), np.uint8)
        for i, x in enumerate(texts):
            levels[i] = quantized(term_counts(x or ""))
        import pandas as pd

        return pd.Series(shared.value.scores(levels))

    return docs.withColumn(column, vote(F.coalesce(F.col(text).cast("string"), F.lit(""))))
