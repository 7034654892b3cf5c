"""Hard negatives by inner product with GNAT-style trees of split points.

Vectors are lifted by one component so that all have the same norm ``M``; an inner product with an anchor is then a distance from it,
``d^2 = |a|^2 + M^2 - 2 a.x``, and a window of scores an annulus around it. A node deals its rows to the nearest of its split points
and stores for each split point the range of its distances to the rows of every sibling. A search measures the distances of
an anchor to the split points; a sibling goes whose range, seen from any split point, does not meet the annulus. Leaves are read exactly.

The same holds one level up: the rows are dealt to the nearest of at most ``CELLS`` split points, a bounded sample, and the ranges
between split points and cells are a table of at most ``CELLS`` squared numbers. A cell is cut into shards of bounded
size, one tree each. Anchors go in blocks: a block is first searched in a shard of its own cell; only to the cells that its
anchors' annuli still meet goes a copy of them, and there it meets the trees.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covercast.llm.balltree import EXACT, LONG, integers
from covercast.llm.storage import importable, written

CELLS, BLOCK, FANOUT, LEAF = 256, 128, 12, 64
#: Rows that are drawn for each split point chosen.
DRAWN = 3
#: Components of the vectors of one tree.
SHARD = 1 << 19
#: Bytes of top split points that the driver chooses and sends out, for all vector lengths together.
POINT_BYTES = 32_000_000
#: Room for rounding in distances, as a share of the norms.
SLACK = 1e-5
NONE = LONG.min


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; those beyond a long stop at its limits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in b]
    sums = [[sum(x * y for x, y in zip(map(int, q), row)) for row in whole] for q in a]
    return np.array([[min(max(s, NONE + 1), LONG.max) for s in row] for row in sums], np.int64).reshape(len(a), len(b))


def lifted(rows: np.ndarray, top: float) -> np.ndarray:
    """The component that brings each row to the squared norm ``top``."""
    return np.sqrt(np.maximum(0.0, top - (rows**2).sum(axis=1)))


def row_distances(points: np.ndarray, rows: np.ndarray, top: float) -> np.ndarray:
    """Distances of lifted points and lifted rows."""
    inner = points @ rows.T + lifted(points, top)[:, None] * lifted(rows, top)
    return np.sqrt(np.maximum(0.0, 2 * top - 2 * inner))


def anchor_distances(anchors: np.ndarray, points: np.ndarray, top: float) -> np.ndarray:
    """Distances of anchors, whose own new component is 0, and lifted points."""
    return np.sqrt(np.maximum(0.0, (anchors**2).sum(axis=1)[:, None] + top - 2 * anchors @ points.T))


def far_apart(rows: np.ndarray, n: int, top: float) -> list[int]:
    """Places of up to ``n`` rows, each the farthest from those before it; rows equal to one of them are left out."""
    chosen, nearest = [0], row_distances(rows[:1], rows, top)[0]
    while len(chosen) < n and nearest.max() > SLACK * np.sqrt(top):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, row_distances(rows[chosen[-1] :][:1], rows, top)[0])
    return chosen


class Asked:
    """Searches of one block: key, id, label and vector of the anchor, the scores admitted, and the best found so far, best first.

    ``same``: whether rows of the anchor's label are looked for, or those of other labels.
    """

    def __init__(self, keys: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int, same: bool):
        self.keys, self.ids, self.labels, self.rows, self.same = keys, ids, labels, rows, same
        self.low, self.high = np.full(len(ids), NONE), np.full(len(ids), LONG.max)
        self.scores, self.found = np.full((len(ids), k), NONE), np.full((len(ids), k), LONG.max)

    def some(self, at: np.ndarray) -> Asked:
        part = Asked(self.keys[at], self.ids[at], self.labels[at], self.rows[at], self.scores.shape[1], self.same)
        part.low, part.high, part.scores, part.found = self.low[at], self.high[at], self.scores[at], self.found[at]
        return part

    def beyond(self) -> Asked:
        """The same searches for what is as good as the worst of those found: these themselves are not kept."""
        part = self.some(np.arange(len(self.ids)))
        part.low = np.maximum(self.low, self.scores[:, -1])
        part.scores, part.found = np.full_like(self.scores, NONE), np.full_like(self.found, LONG.max)
        return part

    def annuli(self, top: float) -> tuple[np.ndarray, np.ndarray]:
        """Inner and outer radius of what may still count."""
        norms = (self.rows**2).sum(axis=1)
        room = SLACK * (np.sqrt(norms) + np.sqrt(top)) + 1e-9
        least = np.maximum(self.low, self.scores[:, -1])
        inner = np.sqrt(np.maximum(0.0, norms + top - 2.0 * self.high)) - room
        outer = np.sqrt(np.maximum(0.0, norms + top - 2.0 * least)) + room
        return np.where(self.high == LONG.max, 0.0, inner), np.where(least == NONE, np.inf, outer)

    def read(self, at: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Take the rows of a leaf into the best of the searches ``at``."""
        found = products(self.rows[at], rows)
        right = (self.labels[at, None] == labels) == self.same
        right &= (self.ids[at, None] != ids) & (found >= np.maximum(self.low[at], self.scores[at, -1])[:, None])
        right &= found <= self.high[at, None]
        some = np.flatnonzero(right.any(axis=1))
        if not len(some):
            return
        at = at[some]
        scores = np.concatenate([self.scores[at], np.where(right[some], found[some], NONE)], axis=1)
        names = np.concatenate([self.found[at], np.where(right[some], ids, LONG.max)], axis=1)
        best = np.lexsort((names, ~scores), axis=-1)[:, : self.scores.shape[1]]
        self.scores[at] = np.take_along_axis(scores, best, axis=1)
        self.found[at] = np.take_along_axis(names, best, axis=1)


def siblings(distances: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance that a row of each sibling can have, from distances to all split points.

    distances: (anchors, points); low, high: (points, siblings).
    """
    least = np.zeros((len(distances), low.shape[1]))
    most = np.full_like(least, np.inf)
    for i in range(len(low)):
        d = distances[:, i, None]
        np.maximum(least, np.maximum(low[i] - d, d - high[i]), out=least)
        np.minimum(most, d + high[i], out=most)
    return least, most


class Gnat:
    """Rows in leaf order; nodes are (split points, ranges low and high, children) or (from, to) of a leaf."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, top: float, fanout: int = FANOUT, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.top = top
        self.nodes: list = [None]
        waiting = [(0, 0, len(ids))]
        while waiting:
            at, start, stop = waiting.pop()
            mine = order[start:stop]
            points = self._points(rows[mine], fanout) if stop - start > leaf else np.zeros(0, np.int64)
            if len(points) < 2:
                self.nodes[at] = (start, stop)
                continue
            points = rows[mine[points]]
            distances = row_distances(points, rows[mine], top)
            owner = distances.argmin(axis=0)
            children, low, high = [], np.empty((len(points), len(points))), np.empty((len(points), len(points)))
            placed = np.argsort(owner, kind="stable")
            order[start:stop] = mine[placed]
            cuts = np.searchsorted(owner[placed], np.arange(len(points) + 1))
            for j, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                part = distances[:, placed[a:b]]
                low[:, j], high[:, j] = part.min(axis=1, initial=np.inf), part.max(axis=1, initial=-np.inf)
                children.append(len(self.nodes) if b > a else -1)
                if b > a:
                    self.nodes.append(None)
                    waiting.append((children[-1], start + a, start + b))
            self.nodes[at] = (points, low, high, children)
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]

    def _points(self, rows: np.ndarray, fanout: int) -> np.ndarray:
        """Places of up to ``fanout`` rows far from each other, chosen among evenly spaced ones; fewer than two if all are equal."""
        some = np.unique(np.linspace(0, len(rows) - 1, DRAWN * fanout).astype(np.int64))
        chosen = far_apart(rows[some], fanout, self.top)
        if len(chosen) > 1:
            return some[chosen]
        away = row_distances(rows[:1], rows, self.top)[0]
        return np.array([0, away.argmax()]) if away.max() > SLACK * np.sqrt(self.top) else np.array([0])

    def search(self, asked: Asked) -> None:
        """Improve what the searches have found by the rows of this tree."""
        every = np.arange(len(asked.ids))
        waiting = [(0.0, 0, 0, every, np.zeros(len(every)))]
        turn = 0
        while waiting:
            _, _, at, some, least = heapq.heappop(waiting)
            inner, outer = asked.annuli(self.top)
            some = some[least <= outer[some]]
            if not len(some):
                continue
            node = self.nodes[at]
            if len(node) == 2:
                part = slice(*node)
                asked.read(some, self.ids[part], self.labels[part], self.rows[part])
                continue
            points, low, high, children = node
            nearest, farthest = siblings(anchor_distances(asked.rows[some], points, self.top), low, high)
            meets = (nearest <= outer[some, None]) & (farthest >= inner[some, None])
            for j, child in enumerate(children):
                alive = np.flatnonzero(meets[:, j])
                if child >= 0 and len(alive):
                    turn += 1
                    beyond = np.maximum(nearest[alive, j] - inner[some[alive]], 0).mean()
                    heapq.heappush(waiting, (beyond, turn, child, some[alive], nearest[alive, j]))


class Cells:
    """The top split points of one vector length, and the ranges of their distances to the rows of each cell."""

    def __init__(self, points: np.ndarray, top: float):
        self.points, self.top = points, top
        self.shards = np.zeros(len(points), np.int64)
        self.low, self.high = np.full((2, len(points), len(points)), np.inf) * np.array([1, -1])[:, None, None]

    def meets(self, asked: Asked) -> np.ndarray:
        """(searches, cells): whether the cell may hold a row in the annulus."""
        inner, outer = asked.annuli(self.top)
        least, most = siblings(anchor_distances(asked.rows, self.points, self.top), self.low, self.high)
        return (least <= outer[:, None]) & (most >= inner[:, None]) & (self.shards > 0)


def _compact(rows: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them."""
    most = np.abs(rows).max(initial=0)
    return rows.astype(np.int16) if most < 1 << 15 else rows.astype(np.int32) if most < 1 << 31 else rows


def _assign(batches: Iterator[pa.RecordBatch], cells: dict[int, Cells]) -> Iterator[pa.RecordBatch]:
    """(dim, vec_id, label, v, anchor) with the nearest cell, and the number of the row in this task."""
    number = 0
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        found = np.zeros(len(dims), np.int32)
        values, offsets = batch.column("v").flatten().to_numpy(zero_copy_only=False), np.cumsum(np.concatenate([[0], dims]))
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            rows = values[offsets[at][:, None] + np.arange(dim)].reshape(len(at), dim)
            for i in range(0, len(at), 4096):
                near = row_distances(cells[dim].points, rows[i : i + 4096], cells[dim].top)
                found[at[i : i + 4096]] = near.argmin(axis=0)
        numbers = pa.array(np.arange(number, number + len(dims)))
        number += len(dims)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), numbers], [*batch.schema.names, "cell", "number"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple[int, ...], list[tuple]]]:
    """Runs of rows with the same first columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for key, group in groupby(rows, key=lambda row: row[:keys]):
        yield key, [row[keys:] for row in group]


def _columns(rows: list[tuple], dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, vectors = (np.array(c, t) for c, t in zip(zip(*rows), (np.int64, np.int64, np.float64)))
    return ids, labels, vectors.reshape(len(ids), dim)


def _plant(batches: Iterator[pa.RecordBatch], cells: dict[int, Cells]) -> Iterator[pa.RecordBatch]:
    """Sorted (dim, cell, shard, vec_id, label, v) to a tree per shard and the distances of the top split points to its rows."""
    for (dim, cell, shard), rows in _groups(batches, 3):
        ids, labels, vectors = _columns(rows, dim)
        top = cells[dim].top
        near = row_distances(cells[dim].points, vectors, top)
        tree = Gnat(ids, labels, vectors, top)
        tree.rows = _compact(tree.rows)
        out = {"dim": dim, "cell": cell, "shard": shard, "tree": pickle.dumps(tree), "low": near.min(axis=1).tolist(), "high": near.max(axis=1).tolist()}
        yield pa.RecordBatch.from_pylist([out], TREES)


TREES = pa.schema(
    [(n, pa.int32()) for n in ("dim", "cell", "shard")]
    + [("tree", pa.binary())]
    + [(n, pa.list_(pa.float64())) for n in ("low", "high")]
)


def _pack(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Sorted (dim, cell, block, vec_id, label, v) of anchors to one row per block; anchors are numbered inside it."""
    for (dim, cell, block), rows in _groups(batches, 3):
        keys = np.stack([np.arange(len(rows)), np.zeros(len(rows), np.int64)], axis=1)
        asked = Asked(keys, *_columns(rows, dim), k, True)
        yield pa.RecordBatch.from_pylist([{"dim": dim, "cell": cell, "block": block, "asked": pickle.dumps(asked)}], BLOCKS)


BLOCKS = pa.schema([(n, pa.int32()) for n in ("dim", "cell", "block")] + [("asked", pa.binary())])


def _cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Asked, object]]:
    """Rows of (dim, cell, block, asked, other) one by one."""
    for batch in batches:
        for i in range(batch.num_rows):
            dim, cell, block, asked, other = (c[i].as_py() for c in batch.columns)
            yield {"dim": dim, "cell": cell, "block": block}, pickle.loads(asked), other


def _begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, cell, block, asked, tree) of the shard at home to (dim, cell, block, asked), searched there."""
    for key, asked, tree in _cells_of(batches):
        _tree(tree).search(asked)
        yield pa.RecordBatch.from_pylist([key | {"asked": pickle.dumps(asked)}], BLOCKS)


def _tree(data: bytes) -> Gnat:
    tree = pickle.loads(data)
    tree.rows = tree.rows.astype(np.float64)
    return tree


def _send(batches: Iterator[pa.RecordBatch], cells: dict[int, Cells]) -> Iterator[pa.RecordBatch]:
    """(dim, cell, block, asked, home shard) to one row per shard that some of the block's searches must still see."""
    schema = pa.schema([*BLOCKS, ("at_cell", pa.int32()), ("at_shard", pa.int32())])
    for key, asked, home in _cells_of(batches):
        here = cells[key["dim"]]
        rest = asked.beyond()
        meets = here.meets(rest)
        for cell in np.flatnonzero(meets.any(axis=0)).tolist():
            data = pickle.dumps(rest.some(np.flatnonzero(meets[:, cell])))
            for shard in range(here.shards[cell]):
                if (cell, shard) != (key["cell"], home):
                    yield pa.RecordBatch.from_pylist([key | {"asked": data, "at_cell": cell, "at_shard": shard}], schema)


FOUND = "dim int, cell int, block int, anchor int, bar bigint, anchor_id bigint, vec_id bigint, score bigint"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, cell, block, asked, tree) to what was found; without a tree, to what the block has already."""
    schema = pa.schema([(n, pa.int32() if t == "int" else pa.int64()) for n, t in map(str.split, FOUND.split(", "))])
    for key, asked, tree in _cells_of(batches):
        if tree is not None:
            _tree(tree).search(asked)
        kept = asked.scores > NONE
        times = kept.sum(axis=1)
        columns = [np.full(times.sum(), key[c]) for c in ("dim", "cell", "block")]
        columns += [np.repeat(x, times) for x in (*asked.keys.T, asked.ids)] + [asked.found[kept], asked.scores[kept]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _aim(batches: Iterator[pa.RecordBatch], k: int, window: Callable[[int], tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """(dim, cell, block, asked, [(anchor, score)]) to the searches for other labels in the window of each score."""
    for key, asked, wanted in _cells_of(batches):
        keys = np.array([(w["anchor"], w["score"]) for w in wanted], np.int64)
        aimed = asked.some(keys[:, 0])
        aimed = Asked(keys, aimed.ids, aimed.labels, aimed.rows, k, False)
        edges = [[min(max(x, NONE + 1), LONG.max) for x in window(w["score"])] for w in wanted]
        aimed.low, aimed.high = np.array(edges, np.int64).T
        yield pa.RecordBatch.from_pylist([key | {"asked": pickle.dumps(aimed)}], BLOCKS)


def between(low: int, high: int) -> Callable[[int], tuple[int, int]]:
    """The whole numbers from ``low`` to ``high`` hundredths of a score: least and largest."""
    return lambda score: (-(-low * score // 100), high * score // 100)


def _sent(begun: DataFrame, shards: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """(dim, cell, block, asked, at_cell, at_shard) for the shards away from home that a block's searches must still see."""
    home = F.pmod("block", F.col("shards")).cast("int").alias("home")
    homes = begun.join(F.broadcast(shards), ["dim", "cell"]).select("dim", "cell", "block", "asked", home)
    return homes.mapInArrow(
        partial(_send, cells=cells), "dim int, cell int, block int, asked binary, at_cell int, at_shard int"
    )


def _searched(blocks: DataFrame, trees: DataFrame, shards: DataFrame, cells: dict[int, Cells], k: int) -> DataFrame:
    """The best ``k`` of every search of the blocks, as ``FOUND`` with a rank."""
    names = ["dim", "cell", "block", "asked"]
    homes = blocks.join(F.broadcast(shards), ["dim", "cell"]).withColumn("shard", F.pmod("block", F.col("shards")).cast("int"))
    begun = homes.join(trees, ["dim", "cell", "shard"]).select(*names, "tree")
    begun = written(begun.mapInArrow(_begin, "dim int, cell int, block int, asked binary"), "begun")
    sent = _sent(begun, shards, cells)
    there = trees.select("dim", F.col("cell").alias("at_cell"), F.col("shard").alias("at_shard"), "tree")
    met = sent.join(there, ["dim", "at_cell", "at_shard"]).select(*names, "tree")
    found = met.unionByName(begun.withColumn("tree", F.lit(None).cast("binary"))).mapInArrow(_finish, FOUND)
    best = Window.partitionBy("dim", "cell", "block", "anchor", "bar").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 10,
    window: Callable[[int], tuple[int, int]] = between(30, 90),
    cells: int = CELLS,
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and each of its positives.

    Scores are inner products of ``floor(256 x)``, exact; higher ones come first, ties by the smaller id. Positives are the anchor's
    best rows of the same label, negatives the best rows of another label with a score in the window of the positive's. Rows with a
    null id, label or vector, or with a null or non-finite component, take no part; labels are whole numbers; vectors of different length
    are not compared. Every other row with another id than the anchor's is a candidate, also rows that repeat an id. Anchors that are
    equal in id, label and vector are one; anchors of one id that differ are searched each for itself. An anchor without
    positives, or a positive without negatives, has no rows; an empty table has none. Products beyond a long stop at its limits.

    The driver holds at most ``cells`` split points and ``cells`` squared ranges per vector length.
    """
    spark = vectors.sparkSession
    importable(spark)
    chosen = label if isinstance(label, Column) else F.col(label)
    rows = vectors.select(
        F.col(key).cast("bigint").alias("vec_id"),
        chosen.cast("bigint").alias("label"),
        integers(F.col(vector)).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    rows = rows.select(F.size("v").alias("dim"), "vec_id", "label", "v", "anchor")
    norm = F.aggregate("v", F.lit(0.0), lambda n, x: n + x * x)
    stats = rows.groupBy("dim").agg(F.count("*").alias("n"), F.max(norm).alias("top")).collect()
    room = {r.dim: max(1, shard // max(1, r.dim)) for r in stats}
    points = {r.dim: min(cells, -(-4 * r.n // room[r.dim])) for r in stats}
    too_many = sum(8 * DRAWN * dim * n for dim, n in points.items()) / POINT_BYTES
    points = {dim: max(1, int(n / max(1.0, too_many))) for dim, n in points.items()}
    found = _split_points(rows, points, {r.dim: r.top for r in stats})
    index = {r.dim: Cells(found[r.dim], r.top) for r in stats}

    placed = rows.mapInArrow(
        partial(_assign, cells=index),
        "dim int, vec_id bigint, label bigint, v array<double>, anchor boolean, cell int, number bigint",
    )
    placed = written(placed, "placed")
    counts = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("anchors"))
    cuts = [(r.dim, r.cell, -(-r.n // room[r.dim]), max(1, -(-r.anchors // block))) for r in counts.collect()]
    shards = spark.createDataFrame(cuts, "dim int, cell int, shards long, blocks long")
    dealt = placed.join(F.broadcast(shards), ["dim", "cell"])
    sorted_by = ["dim", "cell", "shard"]
    trees = dealt.withColumn("shard", F.pmod(F.xxhash64("vec_id", "number"), F.col("shards")).cast("int"))
    trees = trees.select(*sorted_by, "vec_id", "label", "v").repartition(*sorted_by).sortWithinPartitions(*sorted_by, "vec_id")
    trees = written(
        trees.mapInArrow(
            partial(_plant, cells=index),
            "dim int, cell int, shard int, tree binary, low array<double>, high array<double>",
        ),
        "trees",
    )
    ranges = trees.select("dim", "cell", F.posexplode(F.arrays_zip("low", "high")))
    ranges = ranges.groupBy("dim", "cell", "pos").agg(F.min("col.low").alias("low"), F.max("col.high").alias("high"))
    for dim, cell, n, _ in cuts:
        index[dim].shards[cell] = n
    for r in ranges.collect():
        index[r.dim].low[r.pos, r.cell], index[r.dim].high[r.pos, r.cell] = r.low, r.high

    sorted_by = ["dim", "cell", "block"]
    anchors = dealt.filter("anchor").dropDuplicates(["dim", "vec_id", "label", "v"])
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "v"), F.col("blocks")).cast("int"))
    anchors = anchors.select(*sorted_by, "vec_id", "label", "v").repartition(*sorted_by).sortWithinPartitions(*sorted_by, "vec_id")
    packed = "dim int, cell int, block int, asked binary"
    blocks = written(anchors.mapInArrow(partial(_pack, k=positives), packed), "blocks")
    shards = shards.select("dim", "cell", "shards")
    good = written(_searched(blocks, trees, shards, index, positives).drop("rank", "bar"), "positives")
    wanted = good.groupBy(*sorted_by).agg(F.collect_set(F.struct("anchor", "score")).alias("wanted"))
    aimed = blocks.join(wanted, sorted_by).select(*sorted_by, "asked", "wanted")
    aimed = aimed.mapInArrow(partial(_aim, k=negatives, window=window), packed)
    bad = _searched(aimed, trees, shards, index, negatives).select(
        *sorted_by, "anchor", F.col("bar").alias("score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return good.join(bad, [*sorted_by, "anchor", "score"]).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )


def _split_points(rows: DataFrame, wanted: dict[int, int], tops: dict[int, float]) -> dict[int, np.ndarray]:
    """Per vector length as many rows, or fewer where they are few or equal: far from each other among ``DRAWN`` times as many.

    Drawn are the first rows by a hash in each of so many parts.
    """
    if not wanted:
        return {}
    number = F.create_map(*[F.lit(x) for dim, n in wanted.items() for x in (dim, DRAWN * n)])
    part = F.pmod(F.xxhash64("vec_id", "v"), number[F.col("dim")])
    drawn = rows.groupBy("dim", part.alias("part")).agg(F.min_by("v", F.xxhash64(F.lit(7), "vec_id", "v")).alias("v"))
    taken: dict[int, list] = {dim: [] for dim in wanted}
    for r in drawn.orderBy("dim", "part").collect():
        taken[r.dim].append(r.v)
    arrays = {dim: np.array(v, np.float64).reshape(len(v), dim) for dim, v in taken.items()}
    return {dim: v[far_apart(v, wanted[dim], tops[dim])] for dim, v in arrays.items()}
