"""Small column helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Bind ``value`` once and reuse it inside ``body``.

    Higher-order functions get no common-subexpression elimination, so a parse
    repeated inside a lambda would run once per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_true(condition: Column) -> Column:
    """Two-valued truth: null counts as false."""
    return F.coalesce(condition, F.lit(False))


def leading_int(text: Column) -> Column:
    """Integer at the start of a string, null when there is none."""
    return F.regexp_extract(text, r"^\s*([+-]?\d+)", 1).try_cast("int")


def safe_ratio(part: Column, whole: Column) -> Column:
    """Double division; null when either side is null or the divisor is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """Division that gives 0 unless the divisor is positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def capped(limit: Column, value: Column) -> Column:
    """The smaller of two, except that a null ``limit`` means "no limit" and a
    null ``value`` stays null (``least`` would return ``limit`` there)."""
    return F.when(limit < value, limit).otherwise(value)


def day(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def moment(value: dt.datetime | dt.date | str) -> Column:
    """A timestamp literal without a time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def at_minute(date_col: Column, minutes: Column) -> Column:
    """Wall-clock time ``minutes`` after midnight of ``date_col``."""
    return date_col.cast("timestamp_ntz") + F.expr("interval '1' minute") * minutes
