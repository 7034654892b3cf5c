"""Near duplicates by ProbMinHash.

A text is its shingles of five words, weighted by how often they occur. Every shingle runs a Poisson process whose
rate is its weight; each arrival falls into one of the registers, and a register keeps the shingle of the earliest
one. A process ends once it is later than all registers, so most shingles of a long text are drawn once. Two texts
agree in a register with the probability Jaccard similarity of their weighted shingles, which is the plain Jaccard
similarity where no shingle repeats.

Copies of one text are one node. Registers are banded; inside the group of a band, in blocks of bounded size, all pairs are
estimated from a byte of each register, but only the edges of a maximum spanning forest are given out, fewer than there are
members. These are compared exactly and give the first classes. Nodes that estimated edges join are a family; where
a family is not one class yet, the texts of its different classes are compared exactly, block by block, inside tasks. So no
pairs inside a class are listed, and no link between classes is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.llm.storage import importable, written
from covercast.llm.wordhash import mixed, shingles

BANDS, ROWS = 36, 7
SIMILARITY = 0.8
#: Estimates from here on are looked at: more than five standard errors below ``SIMILARITY``.
HOPEFUL = 0.66
#: Members of a block of a band's group, and texts of a block of a family.
GROUP_BLOCK, TEXT_BLOCK = 1024, 128
ELEMENTS = 200_000


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS) -> np.ndarray:
    """Shingle of the earliest arrival in each register, one row per set of (shingles, weights); 0 where none."""
    sizes = np.fromiter((len(e) for e, _ in sets), np.int64, len(sets))
    doc = np.repeat(np.arange(len(sets)), sizes)
    element = np.concatenate([e for e, _ in sets]) if sets else np.zeros(0, np.uint64)
    rate = np.concatenate([w for _, w in sets]).astype(np.float64) if sets else np.zeros(0)
    earliest = np.full(len(sets) * registers, np.inf)
    holder = np.zeros(len(sets) * registers, np.uint64)
    time = np.zeros(len(element))
    arrival = 0
    while len(element):
        arrival += 1
        draw = mixed(element + np.uint64(arrival * 0x9E3779B97F4A7C15 % (1 << 64)))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
        slot = doc * registers + (mixed(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, slot, time)
        first = earliest[slot] == time
        holder[slot[first]] = element[first]
        latest = earliest.reshape(-1, registers).max(axis=1)
        alive = time < latest[doc]
        doc, element, rate, time = doc[alive], element[alive], rate[alive], time[alive]
    return holder.reshape(-1, registers)


def band_keys(registers: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key per band, which also names the band."""
    rows = registers.reshape(len(registers), bands, -1)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(rows.shape[2]):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, i])
    return keys.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets.

    The sum over common elements d of 1 / sum over all e of max(a_e / a_d, b_e / b_d).
    """
    union = np.union1d(a[0], b[0])
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, a[0])], y[np.searchsorted(union, b[0])] = a[1], b[1]
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    kinds, times = np.unique(np.stack([x[both], y[both]], axis=1), axis=0, return_counts=True)
    return float(sum(n / np.maximum(x / p, y / q).sum() for (p, q), n in zip(kinds, times)))


def _sign_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, c1, c2, bands, sketch); c1, c2: 126 bits that stand for the shingles, null without any."""
    for batch in batches:
        at, held, elements = 0, [], 0
        for i in range(batch.num_rows):
            held.append(shingles(batch.column(1)[i].as_py() or ""))
            elements += len(held[-1][0])
            if elements < ELEMENTS and i + 1 < batch.num_rows:
                continue
            registers = signatures(held)
            keys = band_keys(registers)
            sketches = mixed(registers).astype(np.uint8)
            nothing = np.array([not len(e) for e, _ in held])
            marks = []
            for salt in (1, 2):
                parts = [
                    int(np.add.reduce(mixed(mixed(e + np.uint64(salt)) * (2 * w.astype(np.uint64) + np.uint64(1))))) & (1 << 63) - 1
                    for e, w in held
                ]
                marks.append(pa.array(np.array(parts, np.int64), mask=nothing))
            offsets = pa.array(np.arange(len(held) + 1, dtype=np.int32) * keys.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, len(held)),
                    *marks,
                    pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                    pa.array([x.tobytes() for x in sketches], pa.binary()),
                ],
                ["doc_id", "c1", "c2", "bands", "sketch"],
            )
            at, held, elements = i + 1, [], 0


class Union:
    """Classes of numbered things, merged one by one."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def merge(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def forest(sketches: np.ndarray, least: float = HOPEFUL) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest over the pairs whose estimated similarity is at least ``least``."""
    found = []
    for at in range(0, len(sketches), 32):
        equal = (sketches[at : at + 32, None, :] == sketches[None, at:, :]).mean(axis=2)
        # Different registers agree in a byte by chance once in 256.
        estimate = (equal - 1 / 256) / (1 - 1 / 256)
        x, y = np.nonzero(estimate >= least)
        later = y > x
        found.append(np.stack([estimate[x[later], y[later]], x[later] + at, y[later] + at]))
    edges = np.concatenate(found, axis=1)
    union, kept = Union(len(sketches)), []
    for _, x, y in edges[:, np.argsort(-edges[0], kind="stable")].T.tolist():
        if union.merge(int(x), int(y)):
            kept.append((int(x), int(y)))
            if len(kept) == len(sketches) - 1:
                break
    return kept


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows with the same first columns, from sorted batches."""
    run: list[tuple] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in batch.columns)
            if run and run[0][:keys] != row[:keys]:
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _forest_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (band, block, node, sketch) to the forest edges (a, b), a < b, of each block of a group."""
    for run in _runs(batches, 2):
        nodes = sorted({(node, sketch) for *_, node, sketch in run})
        if len(nodes) > 1:
            sketches = np.stack([np.frombuffer(x, np.uint8) for _, x in nodes])
            if pairs := [(nodes[x][0], nodes[y][0]) for x, y in forest(sketches)]:
                yield _edges(pairs)


def _verify_partition(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(a, b, a_text, b_text) to (a, b, similar); rows of one ``a`` mostly come together."""
    last: tuple[str, tuple] | None = None
    for batch in batches:
        judged = []
        for i in range(batch.num_rows):
            text = batch.column(2)[i].as_py() or ""
            if last is None or last[0] != text:
                last = (text, shingles(text))
            judged.append(similarity(last[1], shingles(batch.column(3)[i].as_py() or "")) >= least)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(judged)], ["a", "b", "similar"])


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(a, b, similar): whether the texts of each pair are at least so similar; a hot ``a`` is an ordinary skewed join."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(lambda it: _verify_partition(it, least), "a bigint, b bigint, similar boolean")


def links_between(
    sets: list[tuple[np.ndarray, np.ndarray]], labels: list[int], rows: range, columns: range, least: float
) -> list[tuple[int, int]]:
    """Links of at least ``least`` between sets of different labels, one of ``rows`` and one of ``columns``.

    A link whose labels others have joined already is not looked for.
    """
    where, place = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True)
    ends = np.cumsum([len(e) for e, _ in sets])
    weight = [float(w.sum()) for _, w in sets]
    numbers = {label: i for i, label in enumerate(dict.fromkeys(labels))}
    union, found = Union(len(numbers)), []
    plain = np.array([w.max(initial=1) == 1 for _, w in sets])

    def matrix(some: range) -> tuple[np.ndarray, np.ndarray]:
        dense = np.zeros((len(some), len(where)), np.float32)
        for i, k in enumerate(some):
            dense[i, place[ends[k] - len(sets[k][0]) : ends[k]]] = sets[k][1]
        return dense, (dense > 0).astype(np.float32)

    second, second_has = matrix(columns)
    own = np.array([weight[k] for k in columns])
    for at in range(rows.start, rows.stop, 16):
        some = range(at, min(at + 16, rows.stop))
        first, first_has = matrix(some)
        mine = np.array([weight[k] for k in some])[:, None]
        # Each side's share of weight on common shingles is no less than the similarity.
        share_a, share_b = first @ second_has.T, first_has @ second.T
        hopeful = (share_a >= least * mine * (1 - 1e-6)) & (share_b >= least * own * (1 - 1e-6))
        exact = np.where(plain[list(some)][:, None] & plain[list(columns)], share_a / (mine + own - share_a), 1.0)
        for i, j in zip(*np.nonzero(hopeful & (exact >= least - 1e-6))):
            x, y = some[i], columns[j]
            a, b = numbers[labels[x]], numbers[labels[y]]
            if union.find(a) != union.find(b) and similarity(sets[x], sets[y]) >= least:
                union.merge(a, b)
                found.append((x, y))
    return found


def _family_partition(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Sorted (family, p, q, block, node, label, text) to links (a, b) between texts of block p and of block q."""
    for run in _runs(batches, 3):
        _, p, q, *_ = run[0]
        run.sort(key=lambda r: (r[3] != p, r[4]))
        sets, labels = [shingles(r[6] or "") for r in run], [r[5] for r in run]
        cut = sum(r[3] == p for r in run)
        rows, columns = (range(cut), range(cut)) if p == q else (range(cut), range(cut, len(run)))
        if pairs := links_between(sets, labels, rows, columns, least) if len(columns) else []:
            yield _edges([(run[x][4], run[y][4]) for x, y in pairs])


def family_links(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links between the different labels of each family, from (family, node, label) of families with several labels.

    A label of many nodes has blocks of its own, which are not compared with each other; small ones share blocks.
    """
    sizes = members.groupBy("family", "label").agg(F.count("*").alias("n"))
    large = F.col("n") > TEXT_BLOCK
    pools = sizes.groupBy("family").agg(F.ceil(F.sum(F.when(~large, F.col("n"))) / TEXT_BLOCK).alias("pools"))
    spread = sizes.join(pools, "family").select(
        "family", "label", F.when(large, F.ceil(F.col("n") / TEXT_BLOCK)).alias("own"), "pools"
    )
    number = F.when(
        F.col("own").isNotNull(), F.concat(F.lit("l"), F.col("label"), F.lit("/"), F.pmod(F.xxhash64("node"), F.col("own")))
    ).otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("label"), F.col("pools"))))
    placed = written(
        members.join(spread, ["family", "label"]).select(
            "family", "node", "label", number.alias("block"), F.when(F.col("own").isNotNull(), F.col("label")).alias("only")
        ),
        "placed",
    )
    blocks = placed.groupBy("family", "block").agg(F.min("only").alias("only"))
    p = blocks.select("family", F.col("block").alias("p"), F.col("only").alias("p_only"))
    q = blocks.select("family", F.col("block").alias("q"), F.col("only").alias("q_only"))
    met = p.join(q, "family").filter((F.col("p") <= F.col("q")) & ~F.coalesce(F.col("p_only") == F.col("q_only"), F.lit(False)))
    met = written(met.select("family", "p", "q"), "met")
    ends = met.select("family", "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    rows = placed.drop("only").join(texts, "node").join(ends, ["family", "block"])
    rows = rows.select("family", "p", "q", "block", "node", "label", "text")
    rows = rows.repartition("family", "p", "q").sortWithinPartitions("family", "p", "q")
    return rows.mapInArrow(lambda it: _family_partition(it, least), "a bigint, b bigint")


def components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, label) after merging the labels of every edge (a, b): each takes the smallest one.

    Works on the graph of labels, which shrinks: every label hooks on to its smallest neighbour, chains are followed
    by doubling, and edges are relabelled until none joins two labels.
    """
    ends = {"a": "b", "b": "a"}
    between = edges
    for side in ends:
        named = labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
        between = between.join(named, side)
    between = written(
        between.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")).filter("a <> b").distinct(), "links"
    )
    while not between.isEmpty():
        both = between.unionByName(between.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("old")).agg(F.min("b").alias("low"))
        hooks = written(hooks.select("old", F.least("old", "low").alias("new")), "hooks")
        while True:
            further = hooks.select(F.col("old").alias("new"), F.col("new").alias("newer"))
            hooks_next = written(
                hooks.join(further, "new").select("old", F.col("newer").alias("to"), (F.col("newer") != F.col("new")).alias("moved")),
                "hooks",
            )
            moved = not hooks_next.filter("moved").isEmpty()
            hooks = hooks_next.select("old", F.col("to").alias("new"))
            if not moved:
                break
        labels = written(
            labels.join(hooks, labels["label"] == hooks["old"], "left").select(
                "node", F.coalesce("new", "label").alias("label")
            ),
            "labels",
        )
        for side in ends:
            named = hooks.select(F.col("old").alias(side), F.col("new").alias(f"{side}_new"))
            between = between.join(named, side)
        between = written(
            between.select(F.col("a_new").alias("a"), F.col("b_new").alias("b")).filter("a <> b").distinct(), "links"
        )
    return labels


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of every row: class_id is the smallest key of the texts that links of ``least`` join.

    Texts with the same shingles are copies. Null, empty and wordless texts are alone in their class; rows with a
    null key keep a null class; rows that repeat a key share its class and are all returned. An empty table gives no rows. Other
    columns are not read.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = written(
        rows.mapInArrow(
            _sign_partition, "doc_id bigint, c1 bigint, c2 bigint, bands array<bigint>, sketch binary"
        ),
        "signed",
    )
    named = signed.filter(F.col("doc_id").isNotNull() & F.col("c1").isNotNull())
    copies = written(named.groupBy("c1", "c2").agg(F.min("doc_id").alias("node")), "copies")
    nodes = named.join(copies, ["c1", "c2"]).filter("doc_id = node").select("node", "bands", "sketch")
    banded = nodes.select("node", F.explode(F.array_distinct("bands")).alias("band"))
    groups = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    groups = written(groups.select("band", F.ceil(F.col("n") / GROUP_BLOCK).cast("int").alias("blocks")), "groups")
    shared = written(banded.join(groups, "band"), "shared")
    involved = written(shared.select("node").distinct(), "involved")
    texts = rows.join(involved, rows["doc_id"] == involved["node"], "left_semi").dropDuplicates(["doc_id"])
    texts = written(texts.withColumnRenamed("doc_id", "node"), "texts")
    # A group of several blocks is looked at by pairs of blocks.
    own = F.pmod(F.xxhash64("node", "band"), F.col("blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    block = F.explode(F.transform(other, lambda j: F.struct(F.least(own, j).alias("p"), F.greatest(own, j).alias("q"))))
    members = shared.select("node", "band", block.alias("block")).join(nodes.select("node", "sketch"), "node")
    members = members.select("band", "block", "node", "sketch").repartition("band", "block")
    edges = members.sortWithinPartitions("band", "block").mapInArrow(_forest_partition, "a bigint, b bigint")
    edges = written(edges.distinct(), "edges")
    links = written(verified(edges, texts, least), "links")
    alone = involved.select("node", F.col("node").alias("label"))
    labels = components(alone, links.filter("similar").select("a", "b"))
    # Families: whatever the estimates join, on the graph of the first classes.
    families = components(labels, edges).select("node", F.col("label").alias("family"))
    both = labels.join(families, "node")
    open_families = both.groupBy("family").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_families = open_families.filter("low <> high").select("family")
    unsettled = written(both.join(open_families, "family"), "unsettled")
    labels = components(labels, written(family_links(unsettled, texts, least), "more"))
    final = written(
        copies.join(labels, "node", "left").select("c1", "c2", F.coalesce("label", "node").alias("label")), "final"
    )
    placed = signed.select("doc_id", "c1", "c2").join(final, ["c1", "c2"], "left")
    return placed.select(
        "doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("class_id")
    )
