"""Calendar expressions. Every function maps date columns to columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covercast.functions.basic import is_true

# Labels by number, Sunday = 1 and January = 1.
DAY_NAMES = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

# Meteorological seasons by month and the weekend by Sunday-first weekday.
SEASON_MONTHS = {
    "is_winter": (12, 1, 2),
    "is_spring": (3, 4, 5),
    "is_summer": (6, 7, 8),
    "is_fall": (9, 10, 11),
}
WEEKEND_DAYS = (1, 7)

# Fixed values: (name, month, weekday with Sunday = 1 or None, first day, last day).
HOLIDAY_RULES = [
    ("New Year's Day", 1, None, 1, 1),
    ("Valentine's Day", 2, None, 14, 14),
    ("Mother's Day", 5, 1, 8, 14),
    ("Memorial Day", 5, 2, 25, 31),
    ("Independence Day", 7, None, 4, 4),
    ("Labor Day", 9, 2, 1, 7),
    ("Thanksgiving", 11, 5, 22, 28),
    ("Christmas Eve", 12, None, 24, 24),
    ("Christmas Day", 12, None, 25, 25),
    ("New Year's Eve", 12, None, 31, 31),
]


def iso_weekday(date_col: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(date_col) + 1


def week_start(date_col: Column) -> Column:
    """The Sunday on or before the date."""
    return F.date_sub(date_col, F.dayofweek(date_col) - 1)


def open_on(mask: Column, date_col: Column) -> Column:
    """Does a Monday-first weekly mask include the date? Missing entries are closed."""
    return is_true(F.get(mask, F.weekday(date_col)))


def holiday_name(date_col: Column) -> Column:
    """Holiday on that date, null on ordinary days. The rules never overlap."""
    picked = F.lit(None).cast("string")
    for name, month, weekday, first, last in HOLIDAY_RULES:
        rule = (F.month(date_col) == month) & F.day(date_col).between(first, last)
        if weekday is not None:
            rule = rule & (F.dayofweek(date_col) == weekday)
        picked = F.when(rule, F.lit(name)).otherwise(picked)
    return picked


def season_flags(date_col: Column) -> dict[str, Column]:
    flags = {
        name: F.month(date_col).isin(*months).cast("int") for name, months in SEASON_MONTHS.items()
    }
    flags["is_weekend"] = F.dayofweek(date_col).isin(*WEEKEND_DAYS).cast("int")
    return flags


def horizon_flags(day_prior: Column) -> dict[str, Column]:
    return {
        "is_within_week": (day_prior <= 7).cast("int"),
        "is_within_month": (day_prior <= 30).cast("int"),
        "is_within_quarter": (day_prior <= 90).cast("int"),
    }


def date_parts(date_col: Column) -> dict[str, Column]:
    return {
        "day_of_week": F.dayofweek(date_col),
        "month": F.month(date_col),
        "year": F.year(date_col),
    }


def label_of(number: Column, labels: list[str]) -> Column:
    """1-based lookup in a fixed label list; null out of range."""
    return F.get(F.array(*[F.lit(x) for x in labels]), number - 1)
