"""Writing results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covercast.sources import layout


def ordered(df: DataFrame, columns: Iterable[str], descending: Iterable[str] = ()) -> DataFrame:
    """Global sort for an output; columns named in ``descending`` go downwards."""
    down = set(descending)
    return df.orderBy(*[F.desc(c) if c in down else F.asc(c) for c in columns])


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write a result as Parquet or CSV (with a header), optionally partitioned.

    Rows are first gathered by partition value so that each task writes few
    files; Spark splits a value that is too large for one task.
    """
    columns = list(partition_by)
    if columns:
        df = df.hint("rebalance", *columns)
    writer = df.write.mode(mode).partitionBy(*columns)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_scores(
    df: DataFrame, path: str, fmt: str = "csv", partition_by: Iterable[str] = ()
) -> None:
    write_table(df, path, fmt, partition_by)


def write_reservations(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Reservations laid out by the months of service time and date, so that windows of either skip whole folders."""
    write_table(layout.with_months(df), path, partition_by=list(layout.MONTH_OF.values()), mode=mode)


def write_ordered(df: DataFrame, path: str, columns: Iterable[str], partition_by: str, fmt: str = "csv") -> None:
    """An output in order, one folder per value of ``partition_by``, sorted by ``columns`` inside it.

    Rows are dealt to tasks by ranges of both, so a task writes few folders and a large one has many tasks; files are numbered in
    order. Folders that ``df`` has rows for are replaced and others stay: a job that is run again, for all days or for some, leaves
    no row twice. A null value has a folder of its own; in CSV empty text is quoted, null is not.
    """
    order = [partition_by, *columns]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = placed.write.mode("overwrite").partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.option("header", True).format(fmt).save(path)
