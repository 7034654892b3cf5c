"""Points in half-open intervals of any length and overlap, by an index of dyadic cells."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = 86_400_000_000


def ticks(df: DataFrame, column: str) -> Column:
    """A date in days, a time in microseconds, a whole number as it is."""
    kind, x = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        return F.datediff(x, F.lit("1970-01-01").cast("date")).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(x) * 3600 + F.minute(x) * 60 + F.date_part(F.lit("SECOND"), x)
        days = F.datediff(F.to_date(x), F.lit("1970-01-01").cast("date")).cast("bigint")
        return days * DAY + (seconds * 1_000_000).cast("bigint")
    return F.unix_micros(x) if isinstance(kind, T.TimestampType) else x.cast("bigint")


def _cell(tick: Column, level: Column) -> Column:
    return F.call_function("shiftright", tick, level)


def interval_join(
    intervals: DataFrame, points: DataFrame, keys: Iterable[str], start: str, end: str, point: str
) -> DataFrame:
    """Pairs of an interval and a point of the same keys with ``start <= point < end``: all columns of both, the keys once.

    An interval's level is the least power of two that is not below its length; of the cells of that width it touches one or
    two. A point lies in one cell of each level that occurs, at most 63. Pairs meet by key, level and cell, so a busy key
    is dealt by time, and a pair that meets is at most a cell apart; the exact test follows. Intervals that are empty or
    have a null bound, null points and null keys match nothing.
    """
    keys = list(keys)
    first, after, at = F.col("_first"), F.col("_after"), F.col("_at")
    spans = intervals.withColumns({"_first": ticks(intervals, start), "_after": ticks(intervals, end)}).filter(first < after)
    # Bits of the length less one: 2^level is the least power of two not below the length.
    bits = F.length(F.bin(after - first - 1))
    spans = spans.withColumn("_level", F.when(after - first == 1, 0).otherwise(bits))
    levels = spans.agg(F.collect_set("_level")).scalar()
    cells = F.sequence(_cell(first, F.col("_level")), _cell(after - 1, F.col("_level")))
    cut = spans.withColumn("_cell", F.explode(cells))
    seen = points.withColumn("_at", ticks(points, point)).filter(at.isNotNull()).withColumn("_level", F.explode(levels))
    met = cut.join(seen.withColumn("_cell", _cell(at, F.col("_level"))), [*keys, "_level", "_cell"])
    others = [c for c in points.columns if c not in keys]
    return met.filter((first <= at) & (at < after)).select(*intervals.columns, *others)
