"""Log-likelihood of whole documents under a gated recurrent language model trained on the corpus.

1. Word counts of all training documents, by 64-bit hash of the lower-cased word (a collision would merge two words).
2. Every document becomes ids: its common words have their own, every other word that of a class by its last two bytes.
   The most frequent words' counts are broadcast, a bounded number; the other words' are joined.
3. Each training task learns from the broadcast weights over its documents; the tasks' weights are averaged,
   chunk by chunk, as often as there are rounds.
4. The model scores the ids. A rare word's probability is its class's times its smoothed count's share of the class,
   in which a word never seen counts as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.llm import gru
from covercast.llm.storage import importable, written
from covercast.llm.wordhash import LOWER, SPACE, mixed, word_hashes

#: Words whose counts are broadcast: 24 bytes each.
KNOWN = 131_072
END_HASH = 0
#: Each round learns from every window; the rounds' step sizes.
EVERY, RATES = 1, (0.02, 0.01)
CHUNK = 4096
#: Ids that are dealt over lanes at once.
BATCH_IDS = 2_000_000


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2


def words_of(text: str, rare: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and rare class of every word in order, and those of the end."""
    data = np.frombuffer(text.encode(), np.uint8)
    hashes = word_hashes(data).view(np.int64)
    if not len(hashes):
        return np.array([END_HASH], np.int64), np.zeros(1, np.int64)
    blank = SPACE[data]
    last = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]]))
    low = LOWER[data]
    two = low[last] + np.where((last > 0) & ~blank[last - 1], low[last - 1] << np.uint64(8), np.uint64(0))
    classes = (mixed(two + np.uint64(1)) % np.uint64(rare)).astype(np.int64)
    return np.append(hashes, END_HASH), np.append(classes, 0)


def _count_partition(batches: Iterator[pa.RecordBatch], rare: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, size = [], 0
        for i in range(batch.num_rows):
            hashes, classes = words_of(batch.column(0)[i].as_py() or "", rare)
            held.append(np.stack([hashes, classes]))
            size += len(hashes)
            if size >= BATCH_IDS or i + 1 == batch.num_rows:
                both = np.concatenate(held, axis=1)
                found, first, n = np.unique(both[0], return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(both[1][first].astype(np.int32)), pa.array(n)], ["h", "k", "n"]
                )
                held, size = [], 0


@dataclass
class Vocabulary:
    """The most frequent words by hash: count, id; and what the other words' probabilities need."""

    hashes: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    rare_totals: np.ndarray
    id_counts: np.ndarray
    train_tokens: int
    distinct: int
    shape: gru.Shape


def vocabulary(counts: DataFrame, shape: gru.Shape, known: int = KNOWN) -> Vocabulary:
    """From (h, k, n): at most ``known`` rows, and one sum per rare class and per step of counts, reach the driver.

    Counts are stepped on a logarithmic scale; the words of the highest steps that fit are known.
    """
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    step = F.floor(F.log2(F.col("n").cast("double")) * 64)
    steps = counts.filter(F.col("h") != END_HASH).groupBy(step.alias("step")).count().collect()
    room, lowest = known - 1, float("inf")
    for at, n in sorted(((r["step"], r["count"]) for r in steps), reverse=True):
        room -= n
        if room < 0:
            break
        lowest = at
    top = counts.filter((F.col("h") == END_HASH) | (step >= F.lit(float(lowest)))).collect()
    top.sort(key=lambda r: (r["h"] != END_HASH, -r["n"], r["h"]))
    by_class = np.zeros(shape.rare)
    for r in counts.groupBy("k").agg(F.sum(F.col("n") + 1).alias("n")).collect():
        by_class[r["k"]] = r["n"]
    h, k, n = (np.array([r[c] for r in top], np.int64) for c in ("h", "k", "n"))
    common = min(shape.common, len(h))
    ids = np.where(np.arange(len(h)) < common, np.arange(len(h)), shape.common + k)
    rare_totals = by_class - np.bincount(k[:common], n[:common] + 1.0, minlength=shape.rare) + 1
    id_counts = np.zeros(shape.common + shape.rare)
    id_counts[:common] = n[:common]
    id_counts[shape.common :] = rare_totals
    order = np.argsort(h)
    return Vocabulary(h[order], n[order], ids[order], rare_totals, id_counts, tokens, distinct, shape)


ENCODED = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, rare_score double, "
    "ids binary, others array<struct<h:bigint,tf:bigint>>"
)


def _encode_partition(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    v: Vocabulary = shared.value
    per_token = np.log10(v.train_tokens + v.distinct + 1)
    logs, in_class = np.log10(v.counts + 1.0), np.log10(v.rare_totals)
    common = v.shape.common
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            some = batch.slice(at, 1000)
            sums, ids, lists, starts = [], [], [], [0]
            for i in range(some.num_rows):
                hashes, classes = words_of(some.column(3)[i].as_py() or "", v.shape.rare)
                if len(v.hashes):
                    place = np.minimum(np.searchsorted(v.hashes, hashes), len(v.hashes) - 1)
                    found = v.hashes[place] == hashes
                    mine = np.where(found, v.ids[place], common + classes)
                    log = np.where(found, logs[place], 0.0)
                else:
                    found, mine, log = np.zeros(len(hashes), bool), common + classes, np.zeros(len(hashes))
                rare = mine >= common
                sums.append(
                    (len(hashes), int(found.sum()), log.sum() - per_token * len(hashes))
                    + ((log[rare] - in_class[mine[rare] - common]).sum(),)
                )
                ids.append(mine.astype(np.int16).tobytes())
                lists.append(np.unique(hashes[~found], return_counts=True))
                starts.append(starts[-1] + len(lists[-1][0]))
            n_tokens, n_known, base, rare_score = zip(*sums)
            others = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([x[j] for x in lists]).astype(np.int64)) for j in (0, 1)], ["h", "tf"]
            )
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), some.column(2)]
                + [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64())]
                + [pa.array(base, pa.float64()), pa.array(rare_score, pa.float64()), pa.array(ids, pa.binary())]
                + [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), others)],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rare_score", "ids", "others"],
            )


def _documents(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows with their ids, about ``BATCH_IDS`` ids together."""
    for batch in batches:
        held, size, at = [], 0, 0
        for i in range(batch.num_rows):
            held.append(np.frombuffer(batch.column(column)[i].as_py(), np.int16))
            size += len(held[-1])
            if size >= BATCH_IDS or i + 1 == batch.num_rows:
                yield batch.slice(at, len(held)), held
                held, size, at = [], 0, i + 1


def _train_partition(batches: Iterator[pa.RecordBatch], shared, shape: gru.Shape, rate: float, phase: int, every: int):
    w = {k: v.copy() for k, v in shared.value.items()}
    learnt = sum(gru.train(w, shape, docs, rate, every, phase) for _, docs in _documents(batches, 0))
    if learnt:
        flat = np.concatenate([w[k].ravel() for k in sorted(w)]).astype(np.float32)
        chunks = [flat[i : i + CHUNK].tobytes() for i in range(0, len(flat), CHUNK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(chunks)), pa.int32()), pa.array([learnt] * len(chunks), pa.int64()), pa.array(chunks, pa.binary())],
            ["chunk", "n", "weights"],
        )


def _average_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (chunk, n, weights) to one row per chunk, the mean by n; one chunk is held at a time."""
    last, total, count = None, None, 0

    def row() -> pa.RecordBatch:
        mean = (total / count).astype(np.float32).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([mean], pa.binary())], ["chunk", "weights"])

    for batch in batches:
        for i in range(batch.num_rows):
            chunk, n = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            values = np.frombuffer(batch.column(2)[i].as_py(), np.float32).astype(np.float64) * n
            if chunk != last:
                if last is not None:
                    yield row()
                last, total, count = chunk, values, n
            else:
                total, count = total + values, count + n
    if last is not None:
        yield row()


def fit(encoded: DataFrame, v: Vocabulary, rates=RATES, every: int = EVERY) -> gru.Weights:
    """Weights after one averaged pass per rate over the training documents; their size does not depend on the corpus."""
    spark = encoded.sparkSession
    w = gru.start_weights(v.shape, v.id_counts)
    training = encoded.filter(~F.col("held_out")).select("ids")
    for turn, rate in enumerate(rates):
        shared = spark.sparkContext.broadcast(w)
        phase = turn * every // len(rates)
        replicas = training.mapInArrow(
            lambda it, s=shared, r=rate, p=phase: _train_partition(it, s, v.shape, r, p, every), "chunk int, n bigint, weights binary"
        )
        means = replicas.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(
            _average_partition, "chunk int, weights binary"
        )
        rows = sorted((r["chunk"], bytes(r["weights"])) for r in means.collect())
        if rows:
            flat = np.frombuffer(b"".join(x for _, x in rows), np.float32)
            at = 0
            for k in sorted(w):
                w[k] = flat[at : at + w[k].size].reshape(w[k].shape).copy()
                at += w[k].size
    return w


def _score_partition(batches: Iterator[pa.RecordBatch], shared, shape: gru.Shape) -> Iterator[pa.RecordBatch]:
    for some, docs in _documents(batches, 1):
        scores = gru.score(shared.value, shape, docs) / np.log(10)
        yield pa.RecordBatch.from_arrays([some.column(0), pa.array(scores)], ["row", "recurrent"])


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", shape: gru.Shape | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Null texts count as empty: their one token is the end. A null key is trained on. Rows that repeat count and are scored as
    often; without training documents every word is unseen. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    importable(spark)
    shape = shape or gru.Shape()
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    counted = rows.filter(~F.col("held_out")).select("text").mapInArrow(
        lambda it: _count_partition(it, shape.rare), "h bigint, k int, n bigint"
    )
    counts = written(counted.groupBy("h").agg(F.min("k").alias("k"), F.sum("n").alias("n")), "counts")
    v = vocabulary(counts, shape)
    shared = spark.sparkContext.broadcast(v)
    encoded = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        lambda it: _encode_partition(it, shared), ENCODED
    )
    encoded = written(encoded, "encoded")
    w = spark.sparkContext.broadcast(fit(encoded, v))
    others = encoded.select("row", F.inline("others")).join(counts.select("h", "n"), "h")
    others = others.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("tf").alias("more_known")
    )
    recurrent = encoded.select("row", "ids").mapInArrow(
        lambda it: _score_partition(it, w, shape), "row bigint, recurrent double"
    )
    more = F.coalesce("more", F.lit(0.0))
    facts = encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rare_score")
    return facts.join(recurrent, "row").join(others, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(v.train_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("recurrent") + F.col("rare_score") + more).alias("score"),
    )
