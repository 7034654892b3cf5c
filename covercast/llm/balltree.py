"""Exact top-k search by inner product with a ball tree per shard.

Candidates are dealt into shards of bounded size; each becomes one row that holds its tree. Queries are dealt
into blocks. A block first searches its home shard; the k-th score found there is shared with the searches of all
other shards, which start from it. A search visits nodes by their inner-product upper bound, ``q.c + |q| r``, with
the queries that the bound does not exclude, and the k-th score of each rises as leaves are read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covercast.llm.storage import importable, written

SHARD, BLOCK, LEAF = 8192, 512, 64
LONG = np.iinfo(np.int64)
#: Sums of products below this are exact in doubles.
EXACT = 2.0**53


class BallTree:
    """Rows in leaf order, and per node its rows, children, centre and radius."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, int]] = []
        centres, radii = [], []

        def build(start: int, stop: int) -> int:
            mine = order[start:stop]
            part = rows[mine]
            centre = part.mean(axis=0)
            away = np.sqrt(((part - centre) ** 2).sum(axis=1))
            at = len(self.nodes)
            self.nodes.append((start, stop, -1, -1))
            centres.append(centre)
            radii.append(away.max())
            if stop - start > leaf:
                # Split at the median of the direction from the farthest row to the one farthest from it.
                far = part[away.argmax()]
                other = part[((part - far) ** 2).sum(axis=1).argmax()]
                order[start:stop] = mine[np.argsort(part @ (other - far), kind="stable")]
                middle = (start + stop) // 2
                left = build(start, middle)
                self.nodes[at] = (start, stop, left, build(middle, stop))
            return at

        build(0, len(ids))
        self.ids, self.rows = ids[order], rows[order]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.largest = float(np.abs(rows).max()) if rows.size else 0.0

    def search(
        self, queries: np.ndarray, query_ids: np.ndarray, scores: np.ndarray, ids: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Best scores and their ids after this tree, from those known before (lowest long where none), best first."""
        norms = np.sqrt((queries**2).sum(axis=1))
        bounds = queries @ self.centres.T + norms[:, None] * self.radii
        # Room for rounding, so that no row is excluded by it.
        bounds += 1e-9 * (norms[:, None] * (np.sqrt((self.centres**2).sum(axis=1)) + self.radii)) + 1e-6
        exact = float(np.abs(queries).max(initial=0)) * self.largest * max(1, queries.shape[1]) < EXACT
        waiting = [(-bounds[:, 0].max(), 0)]
        while waiting:
            _, at = heapq.heappop(waiting)
            start, stop, left, right = self.nodes[at]
            # A tie with the k-th score may still win by its smaller id.
            some = np.flatnonzero(bounds[:, at] >= scores[:, -1])
            if not len(some):
                continue
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(waiting, (-bounds[some, child].max(), child))
                continue
            found = self._products(queries[some], self.rows[start:stop], exact)
            leaf_ids = np.broadcast_to(self.ids[start:stop], found.shape)
            found = np.where(leaf_ids == query_ids[some, None], LONG.min, found)
            all_scores = np.concatenate([scores[some], found], axis=1)
            all_ids = np.concatenate([ids[some], leaf_ids], axis=1)
            best = np.lexsort((all_ids, ~all_scores), axis=-1)[:, : scores.shape[1]]
            scores[some] = np.take_along_axis(all_scores, best, axis=1)
            ids[some] = np.take_along_axis(all_ids, best, axis=1)
        return scores, ids

    @staticmethod
    def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (a @ b.T).astype(np.int64)
        whole = [[int(x) for x in row] for row in b]
        sums = [[sum(int(x) * y for x, y in zip(q, row)) for row in whole] for q in a]
        return np.array([[min(max(s, LONG.min + 1), LONG.max) for s in row] for row in sums], np.int64)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """Runs of rows with the same first columns: their key, ids, and vectors. Rows: keys, vec_id, vector."""
    held: list = []
    last = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if last is not None and row[:keys] != last:
                yield last, np.array([i for i, _ in held], np.int64), np.array([v for _, v in held], np.float64)
                held = []
            last = row[:keys]
            held.append((row[keys], row[keys + 1]))
    if held:
        yield last, np.array([i for i, _ in held], np.int64), np.array([v for _, v in held], np.float64)


def _tree_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (dim, shard), ids, rows in _runs(batches, 2):
        tree = pickle.dumps(BallTree(ids, rows.reshape(len(ids), dim)))
        yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()), "tree": pa.array([tree], pa.binary())})


def _block_partition(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for (dim, block), ids, rows in _runs(batches, 2):
        none = np.full((len(ids), k), LONG.min)
        known = pickle.dumps((ids, rows.reshape(len(ids), dim), none, none.copy()))
        yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()), "known": pa.array([known], pa.binary())})


def _home_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, block, known, tree) to (dim, block, known), known holding the best of the home shard."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim, block = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            ids, rows, scores, best = pickle.loads(batch.column(2)[i].as_py())
            tree = pickle.loads(batch.column(3)[i].as_py())
            known = pickle.dumps((ids, rows, *tree.search(rows, ids, scores, best)))
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()), "known": pa.array([known], pa.binary())})


def _search_partition(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(known, tree) to (query_id, vec_id, score): what this shard adds to the best known, or those themselves (tree null)."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, rows, scores, best = pickle.loads(batch.column(0)[i].as_py())
            data = batch.column(1)[i].as_py()
            if data is not None:
                # The home shard's k-th score is the bar; its members are returned by the home row alone.
                bar = np.concatenate([scores[:, -1:]] * k, axis=1)
                marks = np.full_like(best, LONG.max)
                scores, best = pickle.loads(data).search(rows, ids, bar, marks)
                scores = np.where(best == LONG.max, LONG.min, scores)
            kept = scores > LONG.min
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, kept.sum(axis=1))), pa.array(best[kept]), pa.array(scores[kept])],
                ["query_id", "vec_id", "score"],
            )


def integers(vector: Column) -> Column:
    """floor(256 x) of every component; null where the vector is null or has a null or non-finite component."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double")))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every row for which ``is_query`` holds.

    Scores are inner products of ``floor(256 x)``, exact; ties go to the smaller id; a row is no candidate of its own. Rows
    with a null id, and vectors null or with a null or non-finite component, take no part; every other row with another id is a
    candidate, also rows that repeat an id, and the query rows of one id share one list, in which a candidate stands once for each of them;
    vectors of different length are not compared. Products beyond a long stop at its
    limits. Fewer candidates than k give fewer rows, an empty table none.
    """
    spark = vectors.sparkSession
    importable(spark)
    named = vectors.select(F.col(key).cast("bigint").alias("vec_id"), integers(F.col(vector)).alias("v"), is_query.alias("q"))
    rows = named.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    # Of equal rows more than k never show.
    rows = rows.groupBy("vec_id", "v", "q").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n"))
    copies = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")
    rows = written(rows.select("vec_id", "v", "q", F.size("v").alias("dim"), copies), "vectors")
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count(F.when(F.col("q"), 1)).alias("nq"))
    sizes = written(
        sizes.select("dim", F.ceil(F.col("n") / shard).alias("shards"), F.ceil(F.col("nq") / block).alias("blocks")), "sizes"
    )
    dealt = rows.join(F.broadcast(sizes), "dim")

    def packed(part: DataFrame, number: str, name: str) -> DataFrame:
        placed = part.select(
            "dim", F.pmod(F.xxhash64("vec_id", "v"), F.col(number)).cast("int").alias(name), "vec_id", "v"
        )
        return placed.repartition("dim", name).sortWithinPartitions("dim", name, "vec_id")

    trees = packed(dealt, "shards", "shard").mapInArrow(_tree_partition, "dim int, shard int, tree binary")
    trees = written(trees, "trees")
    blocks = packed(dealt.filter("q"), "blocks", "block").mapInArrow(
        lambda it: _block_partition(it, k), "dim int, block int, known binary"
    )
    counts = F.broadcast(sizes.select("dim", "shards"))
    homes = blocks.join(counts, "dim").withColumn("shard", F.pmod("block", F.col("shards")).cast("int"))
    begun = homes.join(trees, ["dim", "shard"]).select("dim", "block", "known", "tree")
    begun = written(begun.mapInArrow(_home_partition, "dim int, block int, known binary"), "begun")
    away = begun.join(counts, "dim").select(
        "dim", "known", F.pmod("block", F.col("shards")).alias("home"), F.explode(F.sequence(F.lit(0), (F.col("shards") - 1).cast("int"))).alias("shard"),
    )
    met = away.filter("home <> shard").join(trees, ["dim", "shard"]).select("known", "tree")
    found = met.unionByName(begun.select("known", F.lit(None).cast("binary").alias("tree"))).mapInArrow(
        lambda it: _search_partition(it, k), "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
