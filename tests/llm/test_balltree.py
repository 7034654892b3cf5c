"""Top-k search against all pairs: ties, own rows, odd vectors, several shards and blocks, large numbers."""

import math
import sys

import numpy as np
from pyspark.sql import functions as F

from covercast.llm import balltree
from covercast.llm.queries import OP6_SQL, QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, v string, shard int"


def direct(rows, every, k=5):
    """As the SQL of the query: every row with another id, the query rows of one id together."""
    valid = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    scored = {}
    for q, v in valid:
        if q % every == 0:
            scored.setdefault(q, []).extend(
                (-sum(a * b for a, b in zip(v, w)), c) for c, w in valid if c != q and len(w) == len(v)
            )
    return sorted((q, r, c, -s) for q, found in scored.items() for r, (s, c) in enumerate(sorted(found)[:k], 1))


def found(spark, rows, every, **sizes):
    vectors = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in balltree.top_k(vectors, F.col("vec_id") % every == 0, **sizes).collect())


def test_equals_all_pairs_over_shards_and_blocks(spark):
    rng = np.random.default_rng(3)
    points = (rng.integers(0, 6, (600, 1)) + rng.standard_normal((600, 6)) * 0.2).astype(np.float32)
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(600 + i, points[0].tolist()) for i in range(30)]
    assert found(spark, rows, 7, shard=100, block=20) == direct(rows, 7)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (0, [0.5, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0])]
    rows += [(6, [inf, 1.0]), (7, [-0.001, 0.0]), (8, []), (10, []), (9, [3.0]), (None, [1.0, 2.0]), (20, [4.0])]
    rows += [(11, [1.0, 2.0]), (11, [1.0, 2.0])]
    assert found(spark, rows, 10) == direct(rows, 10)


def test_rows_that_repeat_an_id(spark):
    """Other vectors of an id, equal rows by the thousand, and query rows of one id, over small shards."""
    rng = np.random.default_rng(9)
    rows = [(int(rng.integers(0, 40)), rng.integers(-2, 3, 3).astype(float).tolist()) for _ in range(300)]
    rows += [(41, [9.0, 9.0, 9.0])] * 3000 + [(0, [1.0, 1.0, 1.0])] * 7
    assert found(spark, rows, 10, shard=40, block=3) == direct(rows, 10)


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + 3 * i), float(-(2**19)), 1.0 / (i + 1)]) for i in range(20)]
    expected = direct(rows, 5)
    assert max(s for *_, s in expected) > 2**53
    assert found(spark, rows, 5) == expected


def test_few_candidates_and_empty_tables(spark):
    assert found(spark, [(0, [1.0])], 1) == []
    assert found(spark, [(0, [1.0]), (1, [2.0])], 1) == [(0, 1, 1, 256 * 512), (1, 1, 0, 256 * 512)]
    assert found(spark, [], 1) == []


def test_bounds_hold_for_every_node():
    rng = np.random.default_rng(0)
    rows, queries = rng.standard_normal((500, 5)).round(2) * 256, rng.standard_normal((9, 5)) * 256
    tree = balltree.BallTree(np.arange(500), rows, leaf=10)
    norms = np.linalg.norm(queries, axis=1)
    for (start, stop, *_), centre, radius in zip(tree.nodes, tree.centres, tree.radii):
        best = (queries @ tree.rows[start:stop].T).max(axis=1)
        assert (best <= queries @ centre + norms * radius + 1e-6).all()


def test_query_equals_sql(spark):
    sys.path.insert(0, "tests")
    from compare import connect, difference, type_differences

    sf_dir = "/root/testdata/sf0.001"
    df, relation = QUERIES["op6_balltree"](spark, sf_dir), connect(sf_dir).sql(OP6_SQL)
    assert difference(df.toPandas(), relation.df()) is None
    assert type_differences(df, relation) == []
