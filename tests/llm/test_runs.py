"""Runs of words: against brute force over all stretches and periods, long texts of one word, odd rows, the query."""

import hashlib
import random
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from covercast.llm import runs
from covercast.llm.queries import QUERIES


def direct(words, least=12):
    """Every stretch with every period: maximal ones with their smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = None
        for i, equal in enumerate(same):
            if equal and start is None:
                start = i
            elif not equal and start is not None:
                length = i - start + q
                if length >= max(least, 2 * q):
                    found.setdefault((start, length), q)
                start = None
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def of(words, least=12):
    return runs.runs(runs.numbered([str(w).encode() for w in words]), least) if len(words) >= least else []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(2, 12))
def test_random_words_of_few_kinds(words, least):
    assert of(words, least) == direct(words, least)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 9), min_size=1, max_size=9), st.integers(1, 5)), max_size=8))
def test_repeated_stretches(parts):
    words = [w for part, times in parts for w in part * times]
    assert of(words) == direct(words)


def test_random_documents_with_few_words_and_far_copies():
    rng = random.Random(4)
    for _ in range(60):
        base = [rng.randrange(30) for _ in range(rng.randint(5, 200))]
        words = base + base[: rng.randint(0, 60)] * rng.randint(1, 4) + [rng.randrange(3) for _ in range(40)] + base
        assert of(words) == direct(words)


def test_many_places_in_one_list(monkeypatch):
    monkeypatch.setattr(runs, "PIECE", 2)
    rng = random.Random(5)
    for _ in range(40):
        words = [rng.randrange(2) for _ in range(rng.randint(12, 300))]
        assert of(words) == direct(words)


def test_long_texts_of_one_word_and_of_one_sentence():
    began = time.process_time()
    assert runs.runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    assert runs.runs(np.arange(300_000) % 7) == [(0, 300_000, 7)]
    assert runs.runs(np.arange(300_000) % 149_000) == [(0, 300_000, 149_000)]
    assert time.process_time() - began < 60


SCHEMA = "doc_id bigint, text string, runs string, collapsed int"


def test_rows(spark):
    line = "a b c " * 5
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, line), (4, line), (4, line), (5, "x " * 11), (6, "x " * 12), (7, "é z " * 6 + "\x0b" + "é z\r" * 6)]
    docs = spark.createDataFrame([(k, t, "", 1) for k, t in rows], SCHEMA)
    found = {(r.doc_id, r.n_words, tuple(tuple(x) for x in r["runs"]), r.collapsed) for r in runs.detect(docs).collect()}
    assert found == {
        (1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (None, 15, ((0, 15, 3),), "a b c"), (4, 15, ((0, 15, 3),), "a b c"),
        (5, 11, (), "x " * 10 + "x"), (6, 12, ((0, 12, 1),), "x"), (7, 12, ((0, 12, 1),), "é z"),
    }
    assert runs.detect(docs).count() == len(rows)
    assert runs.detect(docs.limit(0)).collect() == []


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 0
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = direct(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *four, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "if(size(split(text, ' ')) < 1500, text, left(text, 8000)) AS text")
    rng = random.Random(6)
    made = [(10**6 + i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 150)))) for i in range(150)] + [(None, "a " * 20), (77, None), (77, "")]
    docs.unionByName(spark.createDataFrame(made, "doc_id bigint, text string")).write.parquet(str(tmp_path / "documents.parquet"))
    rows = spark.read.parquet(str(tmp_path / "documents.parquet")).collect()
    out = QUERIES["op13_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in out.dtypes} == {"bigint", "string"}
    got = out.collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(expected_row(r.doc_id, r.text)) for r in rows)
    assert sum(r.n_runs > 0 for r in got) > 15
