"""Language model: gradients, normalisation, carried state, counts against direct ones, and gain on held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from covercast.llm import gru, lm
from covercast.llm.queries import QUERIES

SMALL = gru.Shape(common=8, width=4, rare=2, hidden=3, lanes=2, steps=4)


def weights(shape=SMALL):
    return {k: v.astype(np.float64) for k, v in gru.start_weights(shape, np.arange(10) + 1.0).items()}


def test_gradient_by_differences():
    w, rng = weights(), np.random.default_rng(1)
    ids, before, state = rng.integers(0, 10, (4, 2)), rng.integers(0, 10, (4, 2)), rng.standard_normal((2, 3))
    ids[2:, 1] = -1
    _, g, _ = gru.gradient(w, SMALL, before, ids, state)
    for k in w:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in w[k].shape)
            kept, losses = w[k][at], []
            for step in (1e-3, -1e-3):
                w[k][at] = kept + step
                losses.append(gru.gradient(w, SMALL, before, ids, state)[0])
            w[k][at] = kept
            assert g[k][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-4)


def test_probabilities_sum_to_one():
    w, states = weights(), np.random.default_rng(0).standard_normal((5, 3))
    every = np.exp([gru.log_probabilities(w, SMALL, states, np.full(5, i)) for i in range(10)])
    assert np.allclose(every.sum(axis=0), 1, atol=1e-6)


def test_whole_documents_do_not_depend_on_windows_or_lanes():
    w, rng = weights(), np.random.default_rng(2)
    docs = [np.append(rng.integers(1, 10, n), gru.END).astype(np.int16) for n in (0, 1, 3, 4, 9, 30, 2, 17)]
    alone = [gru.score(w, SMALL, [d])[0] for d in docs]
    for lanes, steps in ((1, 5), (3, 4), (8, 100)):
        shape = gru.Shape(common=8, width=4, rare=2, hidden=3, lanes=lanes, steps=steps)
        assert np.allclose(gru.score(w, shape, docs), alone, atol=1e-4)


def test_learning_helps():
    docs = [np.array([1, 2, 3, 4] * 12 + [0], np.int16)] * 8
    w = gru.start_weights(SMALL, np.ones(10))
    first = gru.score(w, SMALL, docs).sum()
    for _ in range(40):
        gru.train(w, SMALL, docs, 0.05, 1, 0)
    assert gru.score(w, SMALL, docs).sum() > 0.4 * first > first


def test_every_window_of_the_training_documents_is_learnt_from():
    docs = [np.append(np.arange(n) % 7 + 1, 0).astype(np.int16) for n in (3, 40, 200, 1, 77)]
    for rate, phase in zip(lm.RATES, (turn * lm.EVERY // len(lm.RATES) for turn in range(len(lm.RATES)))):
        assert gru.train(gru.start_weights(SMALL, np.ones(10)), SMALL, docs, rate, lm.EVERY, phase) == sum(map(len, docs))


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def compare_counts(rows, texts):
    counts = Counter()
    for i, t in texts:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    expected = Counter()
    for i, t in texts:
        w = tokens(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        expected[i, held, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)] += 1
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_odd_rows(spark):
    texts = [(0, None), (1, ""), (2, " \n"), (3, "A a\x1cb   c"), (4, "x" * 3000), (None, "no key"), (3, "again a"), (5, "rare " * 500)]
    texts += [(i, f"word{i} the the end") for i in range(10, 40)]
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in texts], "doc_id bigint, text string, row int, ids string")
    compare_counts(lm.score(docs).collect(), texts)
    assert lm.score(docs.limit(0)).count() == 0


def test_words_beyond_the_broadcast_are_counted(spark, monkeypatch):
    monkeypatch.setattr(lm.vocabulary, "__defaults__", (20,))
    texts = [(i, " ".join(f"w{(i * k) % 97}" for k in range(30))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    compare_counts(lm.score(docs).collect(), texts)


def test_held_out_documents_score_above_the_base(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op5_recurrent_lm"](spark, sf_dir).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    compare_counts(rows, texts)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
