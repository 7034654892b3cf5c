"""The jobs over stored tables."""

import pytest

from covercast import jobs
from covercast.operators.evaluate import CORRECT
from covercast.plans import model
from covercast.sources import benchmark, sinks


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    for name, df in benchmark.sources(spark, "/root/testdata/sf0.001").items():
        sinks.write_table(df, f"{folder}/{name}")
    return folder


def run(warehouse, out, *more):
    jobs.main(
        ["--sources", warehouse, "--out", out, "--as-of", "2001-01-01", "--now", "2001-01-01T12:00:00",
         "--venues", "0", "--trees", "3", *more]
    )


def test_train_backtest_predict(spark, warehouse, tmp_path):
    out = str(tmp_path)
    run(warehouse, out)
    read = lambda name: spark.read.option("header", True).csv(f"{out}/{name}")
    assert float(read("validation_metrics").first().accuracy) > 0.5
    results = read("backtest/results")
    assert results.columns == [
        "shift_date", "venue_key_id", "persistent_id", "is_hot", "predicted_hot", "hot_probability", CORRECT,
    ]
    assert {r.venue_key_id for r in results.select("venue_key_id").distinct().collect()} == {"0"}
    assert min(r.shift_date for r in results.collect()) >= "2000-10-03"
    scores = read("scores")
    assert "hot_shift_probability" in scores.columns
    assert scores.count() == int(read("summary").first().total_shifts) > 0
    assert read("top_hot").count() == min(10, scores.count())
    assert read("top_features").count() == 10
    again = model.load_model(f"{out}/model")
    assert "day_of_week" in model.model_features(again)[0]


@pytest.mark.parametrize(
    "table, probability, features",
    [("slot", "hot_slot_probability", model.SLOT_FEATURES), ("holiday", "hot_shift_probability", model.HOLIDAY_FEATURES)],
)
def test_other_tables(spark, warehouse, tmp_path, table, probability, features):
    out = str(tmp_path)
    run(warehouse, out, "--table", table)
    scores = spark.read.option("header", True).csv(f"{out}/scores")
    assert probability in scores.columns and scores.count() > 0
    assert model.model_features(model.load_model(f"{out}/model")) == ([], list(features))
    assert not (tmp_path / "backtest").exists()
