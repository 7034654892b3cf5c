"""Dates on which shifts run, holidays, and calendar features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from covercast.functions import dates
from covercast.functions.basic import day, is_true


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from ``start`` to ``end``, with its Monday-first weekday."""
    return (
        spark.range(1)
        .select(F.explode(F.sequence(day(start), day(end))).alias("date"))
        .withColumn("day_of_week", dates.iso_weekday(F.col("date")))
    )


def fill_days(daily: DataFrame, measure: str) -> DataFrame:
    """Every day between the first and the last ``date`` of a per-day table,
    with ``measure`` 0 on the days it lacks.

    Each row lists the days up to the next one. The table has one row per
    calendar day, so ordering it as a whole is cheap.
    """
    following = F.lead("date").over(Window.partitionBy().orderBy("date"))
    until = F.coalesce(F.date_sub(following, 1), F.col("date"))
    return (
        daily.filter(F.col("date").isNotNull())
        .withColumn("until", until)
        .withColumn("day", F.explode(F.sequence("date", "until")))
        .select(
            F.col("day").alias("date"),
            dates.iso_weekday(F.col("day")).alias("day_of_week"),
            F.when(F.col("day") == F.col("date"), F.coalesce(measure, F.lit(0))).otherwise(0).alias(measure),
        )
    )


def days_prior(spark: SparkSession, last: int) -> DataFrame:
    return spark.range(last + 1).select(F.col("id").cast("int").alias("day_prior"))


def holidays_of(spine: DataFrame) -> DataFrame:
    """The holidays among the days of a spine (one pass, all rules at once)."""
    named = spine.withColumn("holiday_name", dates.holiday_name(F.col("date")))
    return named.filter(F.col("holiday_name").isNotNull()).withColumnRenamed("date", "check_date")


def holidays(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return holidays_of(date_spine(spark, start, end)).drop("day_of_week")


def holiday_flag(df: DataFrame, day_col: str) -> DataFrame:
    """Add ``is_holiday`` (0/1). The rules are evaluated in place, without a join."""
    return df.withColumn("is_holiday", dates.holiday_name(F.col(day_col)).isNotNull().cast("int"))


def calendar_flags(df: DataFrame, day_col: str, horizon_col: str | None = None) -> DataFrame:
    """Season and weekend flags, plus lead-time flags when ``horizon_col`` is given."""
    flags = dates.season_flags(F.col(day_col))
    if horizon_col:
        flags |= dates.horizon_flags(F.col(horizon_col))
    return df.withColumns(flags)


def calendar_names(df: DataFrame) -> DataFrame:
    """Replace the numbers in ``day_of_week`` (Sunday = 1) and ``month`` by names."""
    return df.withColumns(
        {
            "day_of_week": dates.label_of(F.col("day_of_week"), dates.DAY_NAMES),
            "month": dates.label_of(F.col("month"), dates.MONTH_NAMES),
        }
    )


def excluded_dates(templates: DataFrame) -> DataFrame:
    """One row per date on which a template does not run."""
    return templates.select(
        "int_id", F.col("venue_key_id").alias("venue_id"), F.explode("excluded_dates").alias("excluded_date")
    ).filter(F.col("excluded_date").isNotNull())


def live_templates(templates: DataFrame) -> DataFrame:
    return templates.filter(F.col("archived").isNull() & F.col("deleted").isNull())


def shift_calendar(templates: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Days on which each live template runs within ``start``..``end``.

    Validity, weekly mask and excluded dates all sit on the template row, so
    the days are generated from that row: no join and no shuffle.
    """
    first = F.greatest("effective_start_date", day(start))
    final = F.least(F.coalesce("effective_end_date", day(end)), day(end))
    excluded = F.coalesce("excluded_dates", F.array().cast("array<date>"))

    def runs(d):
        return dates.open_on(F.col("day_of_week"), d) & ~is_true(F.array_contains(excluded, d))

    return (
        live_templates(templates)
        .filter(first <= final)
        .select(
            "venue_key_id",
            "int_id",
            F.col("category").alias("shift_category"),
            F.explode(F.filter(F.sequence(first, final), runs)).alias("date"),
        )
        .withColumn("day_of_week", dates.iso_weekday(F.col("date")))
    )


def override_calendar(overrides: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Dates set by live overrides within ``start``..``end``."""
    return overrides.filter(
        F.col("deleted").isNull() & F.col("date").between(day(start), day(end))
    ).select(
        "venue_key_id",
        "int_id",
        F.col("category").alias("shift_category"),
        "date",
        dates.iso_weekday(F.col("date")).alias("day_of_week"),
    )


def shift_calendar_all(default: DataFrame, override: DataFrame) -> DataFrame:
    """Both calendars together; a date may carry a template and an override."""
    return default.unionByName(override)
