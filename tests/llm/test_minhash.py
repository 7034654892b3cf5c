"""ProbMinHash: unbiased registers, classes against all pairs, hot groups, odd rows."""

import itertools
import random

import numpy as np

from covercast.llm import minhash
from covercast.llm.queries import QUERIES
from covercast.llm.wordhash import shingles, word_hashes

SCHEMA = "doc_id bigint, text string, band string, label int"


def direct_similarity(a, b):
    x, y = dict(zip(a[0].tolist(), a[1].tolist())), dict(zip(b[0].tolist(), b[1].tolist()))
    total = 0.0
    for d in x.keys() & y.keys():
        total += 1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys())
    return total


def all_pairs(rows):
    sets = {i: shingles(t or "") for i, t in rows if i is not None}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if len(sets[a][0]) and len(sets[b][0]) and minhash.similarity(sets[a], sets[b]) >= minhash.SIMILARITY:
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def found(spark, rows):
    docs = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], SCHEMA)
    return minhash.classes(docs)


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def changed(base, share, seed):
    rng = random.Random(seed)
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in base)


def test_similarity_and_registers():
    rng = np.random.default_rng(1)
    off = []
    for i in range(60):
        base = words(120, i) + words(8, i) * 6
        a, b = shingles(" ".join(base)), shingles(changed(base, 0.03, i))
        true = minhash.similarity(a, b)
        assert abs(true - direct_similarity(a, b)) < 1e-9
        signs = minhash.signatures([a, b])
        off.append(((signs[0] == signs[1]).mean() - true) / np.sqrt(max(true * (1 - true), 1e-4) / signs.shape[1]))
    assert abs(np.mean(off)) < 0.6 and 0.6 < np.std(off) < 1.5
    assert rng is not None


def test_weights_are_scale_free_and_words_hash_by_content():
    a = shingles("a b c d e f g")
    assert abs(minhash.similarity(a, (a[0], a[1] * 3)) - 1) < 1e-12
    one, two = (word_hashes(np.frombuffer(t, np.uint8)) for t in (b"The  cat\nthe", b"x " * 3 + b"y" * 600))
    assert one[0] == one[2] != one[1] and two[0] == two[1] == two[2] != two[3]
    assert len(shingles("")[0]) == len(shingles(" \n")[0]) == 0 and len(shingles("a b")[0]) == 1


def test_classes_equal_those_of_all_pairs(spark):
    rows, n = [], 0
    for group in range(12):
        base = words(60 + 10 * group, 100 + group)
        for copy in range(6):
            rows.append((n, changed(base, 0.02 * (copy % 4), n)))
            n += 1
    rows += [(n + i, t) for i, t in enumerate(["", None, " \n", "a b c", "A  b\nc", "x y", words(3000, 1) and " ".join(words(3000, 1))])]
    rows += [(2000, rows[0][1]), (2000, rows[0][1])]
    got = found(spark, [*rows, (None, rows[0][1])]).collect()
    assert len(got) == len(rows) + 1
    expected = all_pairs(rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == expected
    assert [r.class_id for r in got if r.doc_id is None] == [None]


def test_a_group_larger_than_its_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "GROUP_BLOCK", 8)
    monkeypatch.setattr(minhash, "TEXT_BLOCK", 5)
    base = words(80, 7)
    # Two families of near copies that are close to, but mostly not, each other's copies.
    other = changed(base, 0.06, 1).split()
    rows = [(i, changed(base if i % 2 else other, 0.008, i)) for i in range(60)]
    got = {r.doc_id: r.class_id for r in found(spark, rows).collect()}
    assert got == all_pairs(rows)


def test_links_between_blocks_are_exact():
    sets = [shingles(changed(words(50, i // 4), 0.03 * (i % 4), i)) for i in range(16)]
    sets.append((sets[0][0], sets[0][1] * 2))
    labels = list(range(len(sets)))
    links = minhash.links_between(sets, labels, range(len(sets)), range(len(sets)), 0.8)
    union = minhash.Union(len(sets))
    for a, b in links:
        union.merge(a, b)
    brute = minhash.Union(len(sets))
    for a, b in itertools.combinations(range(len(sets)), 2):
        if minhash.similarity(sets[a], sets[b]) >= 0.8:
            brute.merge(a, b)
    assert [union.find(i) for i in labels] == [brute.find(i) for i in labels]


def test_components_follow_long_chains(spark):
    n = 300
    nodes = spark.range(n).selectExpr("id AS node", "id AS label")
    edges = spark.range(n - 1).filter("id % 100 <> 99").selectExpr("id AS a", "id + 1 AS b")
    got = minhash.components(nodes, edges).collect()
    assert len(got) == n and all(r.label == r.node // 100 * 100 for r in got)


def test_empty_table(spark):
    assert found(spark, []).count() == 0


def test_query_equals_all_pairs(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op3_minhash"](spark, sf_dir).collect()}
    assert got == all_pairs(rows)
