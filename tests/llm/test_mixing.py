"""Mixing: targets by direct water filling, the sample near its target, ties, nulls, and the SQL counterpart."""

import hashlib
import re
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from covercast.llm import mixing
from covercast.llm.queries import OP7_SQL, QUERIES

SCHEMA = "doc_id bigint, text string, source string, target double, p string"


def frame(spark, rows):
    return spark.createDataFrame([(a, b, c, 1.0, "x") for a, b, c in rows], SCHEMA)


def direct_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = sum(weight[s] for s in sizes if s not in full)
        level = (total - sum(3 * sizes[s] for s in full)) / left if left else 0
        over = {s for s in sizes if s not in full and weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * level for s in sizes}
        full |= over


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, mixed):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += n_words(text)
    targets = direct_targets(sizes)
    taken = defaultdict(int)
    assert len(mixed) == len(rows)
    for r in mixed:
        assert r.taken % max(r["size"], 1) == 0 and 0 <= r.taken <= 3 * r["size"]
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source], rel=1e-12)
        taken[r.source] += r.taken
    return targets, taken


def test_targets_and_samples(spark):
    rows = [(i, "w " * (1 + i * i % 37), f"s{i % 7 if i % 3 else 0}") for i in range(1500)]
    rows += [(5000 + i, "x y z", None) for i in range(3)] + [(6000, "one", "tiny"), (6001, None, "s1"), (6002, " \n", "empty")]
    mixed = mixing.mix(frame(spark, rows)).collect()
    targets, taken = check(rows, mixed)
    for source in targets:
        assert abs(taken[source] - targets[source]) <= max(3, 0.01 * targets[source])
    again = mixing.mix(frame(spark, rows[::-1]).repartition(5)).collect()
    assert {(r.doc_id, r.taken) for r in mixed} == {(r.doc_id, r.taken) for r in again}


def test_order_is_by_lot_within_a_source(spark):
    rows = [(i, "a b", "one") for i in range(400)] + [(1000 + i, "a b", "two") for i in range(100)]
    mixed = {r.doc_id: r.copies for r in mixing.mix(frame(spark, rows)).collect()}
    lots = {i: hashlib.md5(f"0:{i}".encode()).hexdigest() for i, _, _ in rows}
    for some in (range(400), range(1000, 1100)):
        in_order = [mixed[i] for i in sorted(some, key=lots.get)]
        ups = [a for a, b in zip(in_order, in_order[1:]) if a < b]
        # The start of the order, and at most one more that closes the gap.
        assert max(in_order) - min(in_order) <= 1 and len(ups) <= 1


def test_repeated_rows_null_keys_and_empty_tables(spark):
    rows = [(1, "a b c", "s")] * 4 + [(None, "d e", "s")] * 2 + [(2, "f", "t")] * 3
    mixed = mixing.mix(frame(spark, rows)).collect()
    check(rows, mixed)
    assert len({r.copies for r in mixed if r.doc_id == 1}) == 1
    assert mixing.mix(frame(spark, [])).count() == 0
    only_empty = mixing.mix(frame(spark, [(1, "", "s"), (2, None, None)])).collect()
    assert [(r.target, r.taken) for r in only_empty] == [(0.0, 0), (0.0, 0)]


def test_mixed_documents_are_the_rows_as_often_as_taken(spark):
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 3 == 0]) for i in range(60)]
    docs = frame(spark, rows)
    times = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: n for i, n in times.items() if n})


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select(F.when(F.col("id") != 5, F.lpad("id", 4, "0")).alias("source")).repartition(7)
    rows = mixing.numbered(df, "source").collect()
    names = sorted([r.source for r in rows if r.source is not None]) + [None]
    assert [r.source for r in sorted(rows, key=lambda r: r.place)] == names


def test_query_equals_sql(spark):
    sys.path.insert(0, "tests")
    from compare import connect, difference, type_differences

    sf_dir = "/root/testdata/sf0.001"
    df, relation = QUERIES["op7_mixing"](spark, sf_dir), connect(sf_dir).sql(OP7_SQL)
    assert difference(df.toPandas(), relation.df()) is None
    assert type_differences(df, relation) == []
