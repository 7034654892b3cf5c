"""The three jobs end to end: train, back-test, predict.

    spark-submit covercast/jobs.py --sources DIR --out DIR --as-of 2024-06-01 [--table rich]
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
from collections.abc import Callable
from dataclasses import dataclass

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from covercast.operators import evaluate
from covercast.plans import backtest, model, upcoming, training
from covercast.sources import sinks
from covercast.sources.load import is_empty, load_sources, require_columns



@dataclass(frozen=True)
class Variant:
    """A training table with its upcoming table and model settings.

    ``features`` None takes every number and text that is not an identifier,
    with weekdays and months by name.
    """

    training: Callable[[dict[str, DataFrame], dt.date, dt.datetime], DataFrame]
    upcoming: Callable[[dict[str, DataFrame], dt.date, dt.datetime], DataFrame]
    covers: str = "covers_as_of_date"
    capacity: str = "util_capacity"
    features: tuple[str, ...] | None = None
    weighted: bool = False
    day_col: str = "shift_date"
    probability: str = "hot_shift_probability"

    @property
    def numeric(self) -> tuple[str, str]:
        return (self.capacity, self.covers)


VARIANTS = {
    "rich": Variant(
        lambda s, as_of, now: training.training_shift_rich(s, as_of),
        upcoming.upcoming_shift_rich,
    ),
    "running": Variant(
        lambda s, as_of, now: training.training_shift_running(s, as_of),
        upcoming.upcoming_shift,
    ),
    "holiday": Variant(
        lambda s, as_of, now: training.training_shift_asof(s, as_of),
        lambda s, as_of, now: upcoming.upcoming_shift_holiday(s, as_of),
        covers="cumulative_covers_as_of_snapshot",
        features=model.HOLIDAY_FEATURES,
        weighted=True,
        day_col="reservation_date",
    ),
    "slot": Variant(
        training.training_slot,
        upcoming.upcoming_slot,
        capacity="slot_capacity",
        features=model.SLOT_FEATURES,
        weighted=True,
        probability="hot_slot_probability",
    ),
}


def build_table(
    sources: dict[str, DataFrame], as_of: dt.date, now: dt.datetime, out: str, variant: Variant
) -> DataFrame:
    """Write the training table by day and return it as stored.

    Splitting, boosting and back-testing pass over it many times; they read the
    written files instead of computing it again, also after a lost executor.
    """
    table = require_columns(
        variant.training(sources, as_of, now), [variant.day_col, *variant.numeric, "is_hot"]
    )
    sinks.write_table(table, f"{out}/training_table", partition_by=[variant.day_col])
    stored = table.sparkSession.read.parquet(f"{out}/training_table")
    if is_empty(stored):
        raise ValueError("the training table has no rows")
    return stored


def train_job(
    table: DataFrame, out: str, variant: Variant, params: model.BoostParams = model.BoostParams()
) -> PipelineModel:
    """Fit on a stored training table; save model, metrics and top features."""
    fitted, validation, train = model.train_and_evaluate(
        table, variant.features, variant.numeric, params, variant.weighted
    )
    model.save_model(fitted, f"{out}/model")
    sinks.write_table(validation, f"{out}/validation_metrics", "csv")
    sinks.write_table(train, f"{out}/training_metrics", "csv")
    sinks.write_table(model.top_features(fitted), f"{out}/top_features", "csv")
    return fitted


def backtest_job(
    table: DataFrame, as_of: dt.date, out: str, fitted: PipelineModel, days: int = 90
) -> None:
    """Score the last ``days`` days of a stored table and write every report."""
    # Scored once, read back by the nine reports.
    judged = backtest.backtest(fitted, table, as_of, days)
    kept = [*evaluate.BACKTEST_COLUMNS, "day_of_week", "day_prior"]
    sinks.write_table(judged.select(*kept), f"{out}/backtest/scored")
    stored = table.sparkSession.read.parquet(f"{out}/backtest/scored")
    for name, df in backtest.report(stored).items():
        sinks.write_table(df, f"{out}/backtest/{name}", "csv")


def predict_job(
    sources: dict[str, DataFrame],
    as_of: dt.date,
    now: dt.datetime,
    out: str,
    variant: Variant,
    fitted: PipelineModel,
) -> DataFrame:
    """Score the coming sittings; write scores, summary and the likeliest ten."""
    table = variant.upcoming(sources, as_of, now)
    sinks.write_table(model.predict_future(fitted, table), f"{out}/scored_future")
    scored = table.sparkSession.read.parquet(f"{out}/scored_future")
    keys = [c for c in (variant.day_col, "venue_key_id", "persistent_id", "shift_persistent_id", "slot_index") if c in scored.columns]
    named = scored.withColumnRenamed(evaluate.SCORE, variant.probability)
    sinks.write_scores(sinks.ordered(named, keys), f"{out}/scores")
    summary = evaluate.score_summary(scored, variant.day_col)
    sinks.write_table(summary, f"{out}/summary", "csv")
    sinks.write_table(evaluate.top_hot_shifts(scored, keys=keys), f"{out}/top_hot", "csv")
    sinks.write_table(evaluate.score_histogram(scored), f"{out}/score_histogram", "csv")
    return scored


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--sources", required=True, help="folder with the six tables")
    parser.add_argument("--out", required=True, help="shared output folder")
    parser.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    parser.add_argument("--now", type=dt.datetime.fromisoformat, help="default: start of the as-of day")
    parser.add_argument("--venues", type=int, nargs="*", help="default: all")
    parser.add_argument("--trees", type=int, default=model.BoostParams().trees)
    parser.add_argument("--table", choices=sorted(VARIANTS), default="rich")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("covercast").getOrCreate()
    sources = load_sources(spark, options.sources, options.venues)
    now = options.now or dt.datetime.combine(options.as_of, dt.time())
    variant = VARIANTS[options.table]
    table = build_table(sources, options.as_of, now, options.out, variant)
    fitted = train_job(table, options.out, variant, model.BoostParams(trees=options.trees))
    if variant.day_col == "shift_date" and "slot_index" not in table.columns:
        backtest_job(table, options.as_of, options.out, fitted)
    predict_job(sources, options.as_of, now, options.out, variant, fitted)


if __name__ == "__main__":
    main()
