"""Training, scoring, saving and back-testing of the classifier."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from covercast.operators import evaluate, rows
from covercast.plans import backtest, model
from covercast.sources import benchmark
from covercast.plans import training

SMALL = model.BoostParams(trees=12, step=0.3)
AS_OF = dt.date(2025, 1, 1)


@pytest.fixture(scope="module")
def table(spark):
    """Rows like the sample frame: hot when covers exceed 80 % of the capacity."""
    pick = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    return (
        spark.range(3000)
        .select(
            F.date_sub(F.lit("2024-12-31").cast("date"), pick(1, 730)).alias("shift_date"),
            F.lit(1).cast("bigint").alias("venue_key_id"),
            F.element_at(F.array(*map(F.lit, ("dinner", "lunch", "brunch"))), pick(2, 3) + 1).alias("persistent_id"),
            pick(3, 30).alias("day_prior"),
            (pick(4, 150) + 50).alias("util_capacity"),
            pick(5, 150).alias("covers_as_of_date"),
        )
        .withColumns(
            {
                "day_of_week": F.dayofweek("shift_date"),
                "month": F.month("shift_date"),
                "year": F.year("shift_date"),
                "is_hot": (F.col("covers_as_of_date") / F.col("util_capacity") > 0.8).cast("int"),
            }
        )
    )


@pytest.fixture(scope="module")
def fitted(table):
    return model.train_and_evaluate(table, params=SMALL)


def test_quality_on_validation_and_training_rows(fitted):
    _, validation, train = (fitted[0], fitted[1].first(), fitted[2].first())
    assert validation.auc_score > 0.95 and validation.accuracy > 0.9
    assert train.auc_score >= validation.auc_score - 0.05
    total = sum(validation[c] + train[c] for c in ("true_positives", "false_positives", "true_negatives", "false_negatives"))
    assert total == 3000


def test_names_are_the_text_features(fitted):
    texts, numbers = model.model_features(fitted[0])
    assert texts == ["day_of_week", "month"]
    assert numbers == ["day_prior", "util_capacity", "covers_as_of_date", "year"]


def test_importances_point_at_the_two_deciding_features(spark, fitted):
    top = model.top_features(fitted[0], 2).collect()
    assert {r.feature for r in top} == {"util_capacity", "covers_as_of_date"}


def test_saved_model_scores_alike(spark, fitted, table, tmp_path):
    model.save_model(fitted[0], f"{tmp_path}/model")
    again = model.load_model(f"{tmp_path}/model")
    future = table.drop("is_hot", "year").limit(50)
    a = model.predict_future(fitted[0], future).select("hot_probability").collect()
    b = model.predict_future(again, future).select("hot_probability").collect()
    assert sorted(a) == sorted(b) and len(a) == 50
    assert all(0 <= r.hot_probability <= 1 for r in a)


def test_backtest_report(fitted, table):
    judged = backtest.backtest(fitted[0], table, AS_OF)
    tables = {name: df.collect() for name, df in backtest.report(judged).items()}
    assert len(tables["results"]) == table.filter("shift_date >= '2024-10-03'").count()
    assert tables["metrics"][0].accuracy > 0.9
    assert {r.day_of_week for r in tables["by_weekday"]} <= set(range(1, 8))
    assert len(tables["by_horizon"]) == 4 and len(tables["calibration"]) == 10
    assert judged.columns[: len(table.columns) - 2] and evaluate.CORRECT in judged.columns


def test_weighted_fit_and_fixed_features(spark, table):
    renamed = table.withColumnRenamed("covers_as_of_date", "cumulative_covers_as_of_snapshot").withColumn("is_holiday", F.lit(0))
    fit, validation, _ = model.train_and_evaluate(
        renamed, model.HOLIDAY_FEATURES, ("util_capacity", "cumulative_covers_as_of_snapshot"), SMALL, weighted=True
    )
    assert model.model_features(fit) == ([], list(model.HOLIDAY_FEATURES))
    assert validation.first().recall_hot > 0.9


def test_slot_table_feeds_the_model(spark):
    src = benchmark.sources(spark, "/root/testdata/sf0.001")
    slot_rows = training.training_slot(src, benchmark.AS_OF, benchmark.NOW)
    marked, features = model.prepare_training(
        slot_rows.persist(), model.SLOT_FEATURES, ("slot_capacity", "covers_as_of_date"),
        keys=("venue_key_id", "persistent_id", "shift_date", "int_id", "slot_index"),
    )
    marked = marked.persist()
    fit = model.fit_model(marked, features, model.BoostParams(trees=3, step=0.3), validation_col="is_validation")
    judged = model.score(fit, marked)
    assert evaluate.classification_metrics(judged).first().accuracy > 0.8
    assert rows.class_balance(judged).first().positives > 0
