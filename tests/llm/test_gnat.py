"""Hard negatives against all pairs: many cells and shards, ties, repeated and odd rows, large numbers; what the ranges exclude; the SQL."""

import math
import sys
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from covercast.llm import gnat
from covercast.llm.queries import OP11_SQL, QUERIES

SCHEMA = "vec_id bigint, label int, embedding array<float>, v string, cell int, anchor int, rank string"


def direct(rows, every):
    valid = [
        (i, lab, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, lab, v in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, lab, v in sorted({(i, lab, tuple(v)) for i, lab, v in valid if i % every == 0}):
        scored = [(-sum(a * b for a, b in zip(v, w)), c, other == lab) for c, other, w in valid if c != i and len(w) == len(v)]
        for p, good, _ in sorted(x for x in scored if x[2])[:5]:
            window = sorted((s, c) for s, c, same in scored if not same and 30 * -p <= 100 * -s <= 90 * -p)
            out += [(i, good, r, c, -p, -s) for r, (s, c) in enumerate(window[:10], 1)]
    return sorted(out)


def found(spark, rows, every, **sizes):
    vectors = spark.createDataFrame([(i, lab, v, "x", 1, 0, "y") for i, lab, v in rows], SCHEMA)
    return sorted(tuple(r) for r in gnat.hard_negatives(vectors, F.col("vec_id") % every == 0, **sizes).collect())


def clustered(n, seed=3):
    rng = np.random.default_rng(seed)
    points = (rng.integers(-1, 5, (n, 1)) + rng.standard_normal((n, 6)) * 0.3).astype(np.float32)
    return [(i, int(rng.integers(0, 3)), p.tolist()) for i, p in enumerate(points)]


def test_equals_all_pairs_over_cells_and_shards(spark):
    rows = clustered(500)
    rows += [(500 + i, i % 3, rows[0][2]) for i in range(90)]
    expected = direct(rows, 10)
    assert len(expected) > 1000
    assert found(spark, rows, 10, shard=6 * 60, block=7) == expected


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [1.0, 2.0]), (0, 2, [1.0, 2.5]), (0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 2, [0.5, 1.0]), (3, 1, None), (4, 1, [1.0, None])]
    rows += [(5, 1, [nan, 1.0]), (6, 2, [inf, 1.0]), (7, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (8, 2, [-0.5, -1.0]), (8, 2, [0.5, 0.9])]
    rows += [(10, 1, []), (11, 1, []), (12, 2, []), (20, 1, [3.0]), (21, 1, [1.0]), (22, 2, [0.5]), (9, 1, [0.9, 1.9]), (9, 1, [0.9, 1.9])]
    rows += [(30, 3, [0.0, 0.0]), (31, 3, [-1.0, 0.0]), (40, 1, [-1.0, -1.0])]
    expected = direct(rows, 10)
    assert {r[0] for r in expected} >= {0, 10, 20, 30}
    assert found(spark, rows, 10) == expected
    assert found(spark, rows, 10, shard=2, block=1) == expected


def test_large_components_stay_exact(spark):
    rows = [(i, i % 2, [float(2**20 + 3 * i), float(-(2**19)), (-1) ** i / (i + 1) * 2.0**19]) for i in range(40)]
    expected = direct(rows, 5)
    assert max(r[4] for r in expected) > 2**53
    assert found(spark, rows, 5) == expected


def test_empty_tables(spark):
    assert found(spark, [], 1) == []
    assert found(spark, [(0, 1, [1.0]), (1, 2, [1.0])], 1) == []


def tree_of(n, leaf=16):
    rows = clustered(n, 8)
    ids, labels = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    vectors = np.floor(256 * np.array([r[2] for r in rows]))
    return gnat.Gnat(ids, labels, vectors, float((vectors**2).sum(axis=1).max()), leaf=leaf)


def test_ranges_hold_and_rows_are_kept():
    tree = tree_of(700)
    assert sorted(tree.ids.tolist()) == list(range(700))

    def rows_below(at):
        node = tree.nodes[at]
        if len(node) == 2:
            return tree.rows[slice(*node)]
        return np.concatenate([rows_below(c) for c in node[3] if c >= 0])

    for node in tree.nodes:
        if len(node) == 4:
            points, low, high, children = node
            for j, child in enumerate(children):
                distances = gnat.row_distances(points, rows_below(child), tree.top)
                assert (distances.min(axis=1) >= low[:, j] - 1e-3).all() and (distances.max(axis=1) <= high[:, j] + 1e-3).all()


def test_search_leaves_most_rows_of_far_clusters_unread(monkeypatch):
    tree, read = tree_of(3000), []
    keys = np.stack([np.arange(3), np.zeros(3, np.int64)], axis=1)
    asked = gnat.Asked(keys, tree.ids[:3], tree.labels[:3], tree.rows[:3], 10, False)
    best = (tree.rows[:3] @ tree.rows.T).max(axis=1)
    asked.low, asked.high = (0.85 * best).astype(np.int64), (0.9 * best).astype(np.int64)
    take = gnat.Asked.read
    monkeypatch.setattr(gnat.Asked, "read", lambda self, at, *leaf: (read.append(len(at) * len(leaf[0])), take(self, at, *leaf))[1])
    tree.search(asked)
    assert sum(read) < 0.5 * 3 * 3000
    for i in range(3):
        scores = (tree.rows @ tree.rows[i]).astype(np.int64)
        right = (tree.labels != tree.labels[i]) & (tree.ids != tree.ids[i]) & (asked.low[i] <= scores) & (scores <= asked.high[i])
        order = np.lexsort((tree.ids[right], -scores[right]))[:10]
        assert asked.found[i][: len(order)].tolist() == tree.ids[right][order].tolist()


def test_blocks_go_to_few_shards(spark, monkeypatch):
    """On clusters the cells' ranges keep blocks from most trees."""
    rng = np.random.default_rng(1)
    centres = np.eye(16) * 2
    rows = [(i, int(rng.integers(0, 3)), (centres[i // 100] + rng.standard_normal(16) * 0.05).tolist()) for i in range(1600)]
    counts, sent = [], gnat._sent

    def counted(begun, shards, cells):
        out = sent(begun, shards, cells)
        counts.append((out.count(), begun.count() * shards.agg(F.sum("shards")).first()[0]))
        return out

    monkeypatch.setattr(gnat, "_sent", counted)
    assert found(spark, rows, 10, cells=24, shard=16 * 50, block=4) == direct(rows, 10)
    (best, product), (windows, _) = counts
    assert best < 0.15 * product and windows < 0.75 * product, counts


def test_query_equals_sql(spark):
    sys.path.insert(0, "tests")
    from compare import connect, difference, type_differences

    sf_dir = "/root/testdata/sf0.001"
    df, relation = QUERIES["op11_hard_negatives"](spark, sf_dir), connect(sf_dir).sql(OP11_SQL)
    got = df.toPandas()
    assert difference(got, relation.df()) is None and len(got)
    assert type_differences(df, relation) == []
    assert gnat.between(30, 90)(-7) == (math.ceil(Fraction(-21, 10)), math.floor(Fraction(-63, 10)))
