"""Quality voting: held-out accuracy, exact votes, odd rows, nothing learnt from held-out labels."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from covercast.llm import quality
from covercast.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_labels_are_found(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op8_quality"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert 0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    judged = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = ([s for s, y in judged if y == k] for k in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.98
    assert np.mean(np.array(good) >= 0.3) > 0.99 and np.mean(np.array(bad) < 0.3) > 0.9


def test_votes_equal_those_of_all_cosines():
    rng = np.random.default_rng(0)
    levels = rng.integers(0, 40, (80, quality.TERMS)).astype(np.uint8)
    model = quality.fit(levels[:60], rng.integers(0, 2, 60).astype(float), latent=8, neighbours=5)
    scores = model.scores(levels, block=7)
    for x, s in zip(model.project(levels), scores):
        near = sorted(((float(x @ v), y) for v, y in zip(model.vectors, model.labels)), reverse=True)[:5]
        weights = [max(c, 0) ** 8 + 1e-9 for c, _ in near]
        assert s == pytest.approx(sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights), rel=1e-4, abs=1e-6)


def test_odd_rows(spark):
    texts = [None, "", " ", "a", "é" * 5, "word " * 20000, "x" * 100000]
    docs = spark.createDataFrame([(i, t, 0.5, 3) for i, t in enumerate(texts)] + [(None, "k", 0.1, 1), (1, "", 0.5, 3)], "doc_id bigint, text string, score double, label int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)] + [(None, 1), (3, None), (4, 7), (1, 1)], "doc_id bigint, quality int")
    scored = quality.score(docs, quality.learn(docs, labels))
    assert scored.columns == docs.columns and scored.count() == 9
    assert scored.filter("score between 0 and 1").count() == 9
    nothing = quality.learn(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.score(docs.limit(0), nothing).count() == 0


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 9)) for i in range(60)], "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.learn(docs, labels), quality.learn(docs, turned)
    assert (a.vectors == b.vectors).all() and (a.labels == b.labels).all() and len(a.labels) < 60


def test_query_equals_votes_document_by_document(spark, tmp_path):
    given = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels")}
    extra = [(None, "no key"), (None, None), (10**7, None)]
    docs = given["documents"].select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    given["labels"].write.parquet(f"{tmp_path}/labels.parquet")
    model = quality.learn(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))

    def vote(text):
        (x,) = model.project(quality.quantized(quality.term_counts(text or ""))[None, :])
        near = sorted(((float(x @ v), y) for v, y in zip(model.vectors, model.labels)), reverse=True)[: model.neighbours]
        weights = [max(c, 0) ** 8 + 1e-9 for c, _ in near]
        return sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights)

    rows = QUERIES["op8_quality"](spark, str(tmp_path)).collect()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert r.held_out is (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None and (texts[r.doc_id] or "").strip():
            assert r.score == pytest.approx(vote(texts[r.doc_id]), rel=1e-3, abs=1e-4)
