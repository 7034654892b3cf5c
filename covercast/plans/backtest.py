"""Back-test of a fitted model on recent history."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from covercast.operators import calendar, evaluate, labels, rows
from covercast.plans.model import model_features, score


def backtest(
    model: PipelineModel, table: DataFrame, as_of: dt.date, days: int = 90, day_col: str = "shift_date"
) -> DataFrame:
    """Score the last ``days`` days of a training table and mark right answers.

    ``day_of_week`` keeps its number for the accuracy tables.
    """
    recent = labels.backtest_window(table, as_of, days, day_col)
    clean = rows.drop_null_rows(
        rows.coerce_numeric(recent, ["util_capacity", "covers_as_of_date"]),
        ["util_capacity", "covers_as_of_date", "is_hot"],
    )
    texts, _ = model_features(model)
    if {"day_of_week", "month"} & set(texts):
        numbered = clean.withColumnsRenamed({"day_of_week": "dow_number", "month": "month_number"})
        named = calendar.calendar_names(
            numbered.withColumns({"day_of_week": numbered.dow_number, "month": numbered.month_number})
        )
        judged = score(model, named).drop("day_of_week", "month").withColumnsRenamed(
            {"dow_number": "day_of_week", "month_number": "month"}
        )
    else:
        judged = score(model, clean)
    return judged.withColumn(evaluate.CORRECT, judged[evaluate.LABEL] == judged[evaluate.PREDICTED])


def report(judged: DataFrame) -> dict[str, DataFrame]:
    """All tables of a back-test, lazily."""
    return {
        "results": evaluate.backtest_output(judged),
        "metrics": evaluate.classification_metrics(judged),
        "classes": evaluate.class_report(judged),
        "by_weekday": evaluate.accuracy_by_weekday(judged),
        "by_horizon": evaluate.accuracy_by_horizon(judged),
        "roc": evaluate.roc_points(judged),
        "precision_recall": evaluate.pr_points(judged),
        "histogram": evaluate.score_histogram(judged, by=evaluate.LABEL),
        "calibration": evaluate.calibration_curve(judged),
    }
