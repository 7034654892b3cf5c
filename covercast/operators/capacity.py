"""Seating capacity of every shift on every day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.functions import dates
from covercast.functions.basic import capped, day
from covercast.functions.seating import pacing_capacity, table_capacity
from covercast.operators.calendar import override_calendar, shift_calendar, shift_calendar_all

SHIFT_COLUMNS = ["venue_key_id", "int_id", "persistent_id", "name"]

# Extra shift settings some datasets carry along (they also split the grouping).
TIME_COLUMNS = [
    "interval_minutes", "deleted", "effective_start_date", "effective_end_date", "start_time",
    "end_time", "duration_minutes_by_party_size_str", "duration_dict_ranges_str",
]
SLOT_COLUMNS = [
    "interval_minutes", "custom_pacing_str", "covers_per_seating_interval",
    "shift_start_time_min", "shift_end_time_min",
]

# What the seating expressions read.
SEATING_COLUMNS = [
    "duration_dict_ranges_str", "table_size", "shift_start_time_min", "shift_end_time_min",
    "custom_pacing_str", "covers_per_seating_interval", "interval_minutes",
]

# Those that the pacing reads.
PACING_COLUMNS = [
    "custom_pacing_str", "covers_per_seating_interval", "shift_start_time_min", "shift_end_time_min", "interval_minutes",
]


def denorm_all(default: DataFrame, override: DataFrame) -> DataFrame:
    """Table rows of templates and overrides together."""
    return default.unionByName(override)


def table_capacities(denorm: DataFrame) -> DataFrame:
    """Add ``table_capacity``: guests each table can seat over its shift."""
    return denorm.withColumn(
        "table_capacity",
        table_capacity(
            F.col("duration_dict_ranges_str"),
            F.col("table_size"),
            F.col("shift_start_time_min"),
            F.col("shift_end_time_min"),
        ),
    )


def pacing_capacities(denorm: DataFrame) -> DataFrame:
    """Add ``max_shift_capacity``: most guests the pacing rules admit."""
    return denorm.withColumn(
        "max_shift_capacity",
        pacing_capacity(
            F.col("custom_pacing_str"),
            F.col("covers_per_seating_interval"),
            F.col("shift_start_time_min"),
            F.col("shift_end_time_min"),
            F.col("interval_minutes"),
        ),
    )


def shift_setting_capacity(denorm: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Capacity per shift definition, before any dates are attached.

    The seating expressions depend on neither the date nor the single table,
    so equal tables of a shift are counted first and each kind is evaluated
    once, however many tables, days or copies there are. Pacing does not depend
    on the kind of table either: it is evaluated once per settings of a shift.
    """
    keys = SHIFT_COLUMNS + [c for c in extra if c not in SHIFT_COLUMNS]
    inputs = [c for c in SEATING_COLUMNS if c not in keys]
    paced = [c for c in PACING_COLUMNS if c not in keys]
    kinds = denorm.groupBy(*keys, *inputs).agg(F.count(F.lit(1)).alias("tables"))
    seated = table_capacities(kinds).groupBy(*keys, *paced).agg(
        F.sum(F.col("table_capacity") * F.col("tables")).alias("seats")
    )
    return (
        pacing_capacities(seated)
        .groupBy(*keys, "max_shift_capacity")
        .agg(F.sum("seats").alias("tables_capacity"))
    )


def all_setting_capacity(sources: dict[str, DataFrame], extra: Iterable[str] = ()) -> DataFrame:
    """``shift_setting_capacity`` of templates and overrides; the same for past and coming days."""
    return shift_setting_capacity(denorm_all(sources["shift_default_denorm"], sources["shift_override_denorm"]), extra)


def dated_capacity(calendar: DataFrame, settings: DataFrame) -> DataFrame:
    """Attach shift capacities to calendar days.

    Equal calendar rows count their tables once per copy. Counting combines
    before the shuffle, so a shift entered over and over is no hot key; after
    it a shift has one row per day and category.
    """
    copies = calendar.groupBy("venue_key_id", "int_id", "shift_category", "date").agg(
        F.count(F.lit(1)).alias("copies")
    )
    return (
        copies.join(settings, ["venue_key_id", "int_id"], "left")
        .withColumn("calculated_capacity", F.col("tables_capacity") * F.col("copies"))
        .withColumn(
            "util_capacity", capped(F.col("max_shift_capacity"), F.col("calculated_capacity"))
        )
        .drop("copies", "tables_capacity")
    )


def shift_capacity_per_day(
    sources: dict[str, DataFrame],
    start: dt.date,
    end: dt.date,
    extra: Iterable[str] = (),
    override_wins: bool = False,
    settings: DataFrame | None = None,
) -> DataFrame:
    """One row per shift definition and day it runs, with its usable capacity.

    Templates and overrides on one date are both kept; ``override_wins`` drops
    the template rows of a (venue, shift, date) that has an override.
    ``settings``: ``all_setting_capacity`` of the sources, where it is at hand.
    """
    default_days = shift_calendar(sources["shift_default"], start, end)
    override_days = override_calendar(sources["shift_override"], start, end)
    calendar = shift_calendar_all(
        default_days.withColumn("is_override", F.lit(False)),
        override_days.withColumn("is_override", F.lit(True)),
    )
    if settings is None:
        settings = all_setting_capacity(sources, extra)
    if not override_wins:
        return dated_capacity(calendar, settings)
    winners = dated_capacity(calendar.filter("is_override"), settings)
    others = dated_capacity(calendar.filter("not is_override"), settings)
    return winners.unionByName(
        others.join(winners, ["venue_key_id", "persistent_id", "date"], "left_anti")
    )


def shift_times(capacity: DataFrame) -> DataFrame:
    """Normalise shift clock times (given on 1900-01-01) and add the week.

    A shift that ends before it starts ends on the following day.
    """
    shift_by = F.expr("timestamp_ntz'1970-01-01 00:00:00' - timestamp_ntz'1900-01-01 00:00:00'")
    start = F.col("start_time") + shift_by
    end = F.col("end_time") + shift_by
    return (
        capacity.withColumn("normalized_start_time", start)
        .withColumn("end_time", end)
        .withColumn(
            "normalized_end_time",
            F.when(
                F.col("end_time") < F.col("normalized_start_time"),
                F.col("end_time") + F.expr("interval 1 day"),
            ).otherwise(F.col("end_time")),
        )
        .withColumns(
            {
                "normalized_end_time_dom": F.day("normalized_end_time"),
                "normalized_end_time_minutes": F.hour("normalized_end_time") * 60
                + F.minute("normalized_end_time"),
                "normalized_start_time_minutes": F.hour("normalized_start_time") * 60
                + F.minute("normalized_start_time"),
                "date_partition": dates.week_start(F.col("date")),
            }
        )
        .drop("start_time")
    )


def with_capacity(df: DataFrame) -> DataFrame:
    """Keep rows with a known, positive capacity."""
    return df.filter(F.col("util_capacity") > 0)


def between_days(df: DataFrame, day_col: str, start: dt.date, end: dt.date) -> DataFrame:
    return df.filter(F.col(day_col).between(day(start), day(end)))


def future_window(df: DataFrame, as_of: dt.date, days: int = 365, day_col: str = "date") -> DataFrame:
    """Rows from ``as_of`` to ``days`` days later, both included."""
    return between_days(df, day_col, as_of, as_of + dt.timedelta(days=days))
