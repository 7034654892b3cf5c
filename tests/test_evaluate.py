"""Evaluation tables against NumPy on random scores."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from covercast.operators import evaluate


def scored(spark, labels, scores, extra=None):
    rows = [(int(y), float(p)) for y, p in zip(labels, scores)]
    df = spark.createDataFrame(rows, "is_hot int, hot_probability double")
    return evaluate.with_class(df)


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module", params=["spread", "crowded", "tied", "ends"])
def sample(request):
    rng = np.random.default_rng(3)
    y = (rng.random(1500) < 0.35).astype(int)
    if request.param == "spread":
        p = np.clip(rng.random(1500) * 0.7 + 0.3 * y, 0, 1)
    elif request.param == "crowded":  # all scores inside a few cells
        p = 0.5 + rng.random(1500) * 3e-7 + y * 1e-7
    elif request.param == "tied":
        p = rng.integers(0, 6, 1500) / 5
    else:
        p = rng.choice([0.0, 1.0], 1500)
    return y, p


def test_auc(spark, sample):
    y, p = sample
    got = evaluate.roc_auc(scored(spark, y, p)).first().auc_score
    assert got == pytest.approx(brute_auc(y, p), abs=1e-12)


def test_auc_agrees_with_mllib(spark, sample):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    y, p = sample
    df = scored(spark, y, p).withColumn("is_hot", F.col("is_hot").cast("double"))
    judge = BinaryClassificationEvaluator(rawPredictionCol="hot_probability", labelCol="is_hot", numBins=0)
    assert evaluate.roc_auc(df).first().auc_score == pytest.approx(judge.evaluate(df), abs=1e-9)


def test_roc_and_pr_points(spark, sample):
    y, p = sample
    df = scored(spark, y, p)
    roc = {r.threshold: (r.fpr, r.tpr) for r in evaluate.roc_points(df).collect()}
    pr = {r.threshold: (r.precision, r.recall) for r in evaluate.pr_points(df).collect()}
    assert set(roc) == set(pr) == {None, *map(float, p)}
    assert roc[None] == (0.0, 0.0) and pr[None] == (1.0, 0.0)
    for t in np.unique(p):
        above = p >= t
        tp, fp = (above & (y == 1)).sum(), (above & (y == 0)).sum()
        assert roc[t] == pytest.approx((fp / (y == 0).sum(), tp / (y == 1).sum()))
        assert pr[t] == pytest.approx((tp / (tp + fp), tp / (y == 1).sum()))


def test_single_class_has_no_auc(spark):
    df = scored(spark, [1, 1], [0.2, 0.9])
    assert evaluate.roc_auc(df).first().auc_score is None
    row = evaluate.classification_metrics(df).first()
    assert (row.accuracy, row.precision_hot, row.recall_hot) == (0.5, 1.0, 0.5)


def test_counts_and_metrics(spark, sample):
    y, p = sample
    row = evaluate.classification_metrics(scored(spark, y, p)).first()
    guess = p > 0.5
    tp, fp = (guess & (y == 1)).sum(), (guess & (y == 0)).sum()
    tn, fn = (~guess & (y == 0)).sum(), (~guess & (y == 1)).sum()
    assert (row.true_positives, row.false_positives, row.true_negatives, row.false_negatives) == (tp, fp, tn, fn)
    assert tp + fp + tn + fn == len(y)
    assert row.accuracy == pytest.approx((tp + tn) / len(y))
    precision = tp / (tp + fp) if tp + fp else 0
    recall = tp / (tp + fn)
    assert row.f1_score == pytest.approx(2 * precision * recall / (precision + recall) if precision + recall else 0)


def test_no_predicted_positive_gives_zeros(spark):
    row = evaluate.classification_metrics(scored(spark, [0, 1], [0.1, 0.2])).first()
    assert (row.precision_hot, row.recall_hot, row.f1_score) == (0.0, 0.0, 0.0)


def test_class_report_means(spark):
    df = scored(spark, [1, 1, 0, 0, 0], [0.9, 0.1, 0.8, 0.2, 0.3])
    rows = {r.class_label: r for r in evaluate.class_report(df).collect()}
    assert (rows["1"].precision, rows["1"].recall, rows["1"].support) == (0.5, 0.5, 2)
    assert rows["0"].precision == pytest.approx(2 / 3)
    assert rows["accuracy"].f1_score == pytest.approx(0.6)
    assert rows["macro avg"].precision == pytest.approx((0.5 + 2 / 3) / 2)
    assert rows["weighted avg"].recall == pytest.approx((2 * 0.5 + 3 * 2 / 3) / 5)


def test_histogram_equals_numpy(spark, sample):
    y, p = sample
    got = evaluate.score_histogram(scored(spark, y, p), bins=30).orderBy("bin").collect()
    counts, edges = np.histogram(p, bins=30)
    assert sum(r.rows for r in got) == len(p) and len(got) == 30
    # a score on an edge may fall to either side by the last bit
    assert np.abs(np.cumsum([r.rows for r in got]) - np.cumsum(counts)).max() <= np.isin(p, edges).sum()
    assert [r.bin_start for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_equal_scores(spark):
    rows = evaluate.score_histogram(scored(spark, [0, 1], [0.4, 0.4]), bins=4).orderBy("bin").collect()
    assert [r.rows for r in rows] == [0, 0, 2, 0]
    assert rows[0].bin_start == pytest.approx(-0.1)


def test_calibration(spark):
    df = scored(spark, [1, 0, 1, 1, 0], [0.05, 0.1, 0.11, 1.0, 0.0])
    rows = evaluate.calibration_curve(df).orderBy("bin").collect()
    assert [(r.rows, r.fraction_of_positives) for r in rows[:2]] == [(2, 0.5), (1, 1.0)]
    assert (rows[9].rows, rows[9].fraction_of_positives, rows[5].fraction_of_positives) == (1, 1.0, 0.0)
    assert rows[0].bin_center == 0.05 and sum(r.rows for r in rows) == 4


def test_accuracy_by_horizon_keeps_empty_bins_and_drops_day_zero(spark):
    df = spark.createDataFrame(
        [(0, 1, 1), (1, 1, 1), (7, 0, 1), (8, 0, 0)], "day_prior int, is_hot int, predicted_hot int"
    )
    rows = {r.horizon: r for r in evaluate.accuracy_by_horizon(df).collect()}
    assert (rows["(0, 7]"].accuracy, rows["(0, 7]"].shifts) == (0.5, 2)
    assert (rows["(7, 30]"].accuracy, rows["(90, 365]"].accuracy, rows["(90, 365]"].shifts) == (1.0, None, 0)


def test_published_backtest_figures(spark):
    """The committed back-test: 58 hits, one false alarm, 141 quiet shifts."""
    labels = [1] * 58 + [0] * 142
    scores = [0.97] * 58 + [0.8557] + [0.01] * 141
    row = evaluate.classification_metrics(scored(spark, labels, scores)).first()
    assert (row.true_positives, row.false_positives, row.true_negatives, row.false_negatives) == (58, 1, 141, 0)
    assert round(row.accuracy, 4) == 0.995 and round(row.precision_hot, 4) == 0.9831
    assert round(row.f1_score, 4) == 0.9915 and row.auc_score == 1.0


def test_metrics_of_every_group_from_one_scan(spark):
    rng = random.Random(7)
    rows = [(g, rng.random() < 0.4, round(rng.random(), 2)) for g in ("a", "b", None) for _ in range(80)]
    rows += [("one class", True, 0.9), ("one class", True, 0.2), ("null score", True, None)]
    scored = spark.createDataFrame([(g, 1, int(y), x) for g, y, x in rows], "g string, h int, is_hot int, hot_probability double")
    judged = evaluate.with_class(scored)
    result = evaluate.metrics_by(judged, "g", "h")
    found = {r.g: r for r in result.collect()}
    assert set(found) == {"a", "b", None, "one class"}
    for g, r in found.items():
        part = judged.filter(F.col("g").eqNullSafe(F.lit(g)))
        expected = evaluate.classification_metrics(part).first().asDict()
        got = {c: r[c] for c in expected}
        assert {c: v for c, v in got.items() if c != "auc_score"} == {c: v for c, v in expected.items() if c != "auc_score"}
        assert got["auc_score"] == expected["auc_score"] or abs(got["auc_score"] - expected["auc_score"]) < 1e-12
    assert found["one class"].auc_score is None
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1, plan
