"""Folders of stored reservations by month, and the predicates on them that follow from a window of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Column of a window, and the folder column that holds its month as yyyy-MM.
MONTH_OF = {"marked_time": "service_month", "date": "date_month"}


def with_months(df: DataFrame) -> DataFrame:
    """``df`` with its folder columns; a null day has a null month."""
    return df.withColumns({month: F.date_format(F.col(column), "yyyy-MM") for column, month in MONTH_OF.items()})


def in_months(df: DataFrame, column: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Rows whose folder can hold a day from ``start`` to ``end`` (both included); all rows of a table without folders.

    It only spares reading folders: the window itself is still to be filtered.
    """
    month = MONTH_OF[column]
    if month not in df.columns:
        return df
    if start is not None:
        df = df.filter(F.col(month) >= f"{start:%Y-%m}")
    if end is not None:
        df = df.filter(F.col(month) <= f"{end:%Y-%m}")
    return df
