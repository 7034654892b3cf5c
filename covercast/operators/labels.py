"""Outcomes and "hot" labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.functions.basic import day, safe_ratio
from covercast.keys import INSTANCE
from covercast.operators.quantile import exact_quantile


def history_window(df: DataFrame, as_of: dt.date, years: int | None = None, day_col: str = "shift_date") -> DataFrame:
    """Rows before ``as_of``, optionally no older than some years."""
    kept = df.filter(F.col(day_col) < day(as_of))
    if years is not None:
        kept = kept.filter(F.col(day_col) >= F.add_months(day(as_of), -12 * years))
    return kept


def backtest_window(df: DataFrame, as_of: dt.date, days: int = 90, day_col: str = "shift_date") -> DataFrame:
    """The last ``days`` days before ``as_of``."""
    return df.filter(
        F.col(day_col).between(F.date_sub(day(as_of), days), F.date_sub(day(as_of), 1))
    )


def hot_by_ratio(threshold: float, covers: str = "final_actual_covers", capacity: str = "util_capacity"):
    """1 when covers exceed the given share of a positive capacity, else 0."""
    share = safe_ratio(F.coalesce(F.col(covers), F.lit(0)), F.col(capacity))
    return F.when(F.col(capacity) > 0, (share > threshold).cast("int")).otherwise(0)


def label_by_ratio(capacity: DataFrame, actual: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Join outcomes onto sittings and flag the hot ones."""
    return capacity.join(actual, INSTANCE, "left").withColumn("is_hot", hot_by_ratio(threshold))


def merged_sittings(capacity: DataFrame) -> DataFrame:
    """Merge capacity rows that differ only in their definition, counting them."""
    return capacity.groupBy(*INSTANCE, "util_capacity").agg(F.count(F.lit(1)).alias("copies"))


def count_copies(outcomes: DataFrame) -> DataFrame:
    """Count the guests once per merged row, and add the weekday.

    The null tests are the ones Spark would derive for one use of the result in
    a self join; stating them keeps both uses alike, so they share a shuffle.
    """
    counted = outcomes.withColumns(
        {
            "final_actual_covers": F.col("final_actual_covers") * F.col("copies"),
            "day_of_week": F.dayofweek("shift_date"),
        }
    ).drop("copies")
    return counted.filter(F.col("venue_key_id").isNotNull() & F.col("day_of_week").isNotNull())


def final_outcomes(capacity: DataFrame, actual: DataFrame) -> DataFrame:
    """Outcome per sitting and capacity; null when nothing was booked.

    Capacity rows that agree in everything but their definition are merged,
    and each counts the guests once.
    """
    covers = actual.select(*INSTANCE, "final_actual_covers")
    return count_copies(merged_sittings(capacity).join(covers, INSTANCE, "left"))


def weekday_threshold(
    outcomes: DataFrame, q: float = 0.8, accuracy: int = 10000, exact: bool = False
) -> DataFrame:
    """Utilisation at quantile ``q`` per venue and weekday (unbooked sittings are ignored).

    ``percentile_approx`` keeps a bounded, mergeable summary, so a venue with
    most of the data needs no large group; groups well below ``accuracy`` rows
    give the exact order statistic. With ``exact`` groups of any size do.
    """
    ratio = safe_ratio(F.col("final_actual_covers"), F.col("util_capacity"))
    open_sittings = outcomes.filter(F.col("util_capacity") > 0)
    if exact:
        used = open_sittings.select("venue_key_id", "day_of_week", ratio.alias("ratio"))
        return exact_quantile(used, ["venue_key_id", "day_of_week"], "ratio", q, "hot_threshold")
    return (
        open_sittings
        .groupBy("venue_key_id", "day_of_week")
        .agg(F.percentile_approx(ratio, q, accuracy).alias("hot_threshold"))
    )


def label_by_threshold(outcomes: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Flag sittings at or above the threshold of their venue and weekday."""
    ratio = safe_ratio(F.col("final_actual_covers"), F.col("util_capacity"))
    hot = (F.col("util_capacity") > 0) & (ratio >= F.col("hot_threshold"))
    return outcomes.join(thresholds, ["venue_key_id", "day_of_week"], "left").withColumn(
        "is_hot", F.when(hot, 1).otherwise(0)
    )


def label_by_quantile(outcomes: DataFrame, q: float = 0.8, exact: bool = False) -> DataFrame:
    """Flag sittings at or above their weekday's quantile of utilisation."""
    return label_by_threshold(outcomes, weekday_threshold(outcomes, q, exact=exact))
