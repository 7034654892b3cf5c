"""Reading and checking input tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covercast.sources.layout import MONTH_OF
from covercast.sources.schemas import OPTIONAL, TABLES, schema_of


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or fail naming the columns it lacks. Runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def is_empty(df: DataFrame | None) -> bool:
    return df is None or df.isEmpty()


def conform(df: DataFrame, table: str) -> DataFrame:
    """Bring a table to its declared columns and types.

    A column that already has the declared type stays a bare reference, so
    filters on it still reach the Parquet reader. The folder columns of stored
    reservations stay, behind the others.
    """
    wanted = schema_of(table)
    require_columns(df, [f.name for f in wanted if f.name not in OPTIONAL])
    have = {f.name: f.dataType for f in df.schema}
    columns = []
    for field in wanted:
        if field.name not in have:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif have[field.name].simpleString() == field.dataType.simpleString():
            columns.append(F.col(f"`{field.name}`"))
        else:
            columns.append(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name))
    folders = [c for c in MONTH_OF.values() if table == "reservation" and c in have]
    return df.select(*columns, *folders)


def load_sources(
    spark: SparkSession,
    directory: str,
    venues: Iterable[int] | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """The six source tables under ``directory``, optionally for some venues only."""
    tables = {
        name: conform(spark.read.format(fmt).load(f"{directory}/{name}"), name) for name in TABLES
    }
    return for_venues(tables, venues)


def for_venues(tables: dict[str, DataFrame], venues: Iterable[int] | None) -> dict[str, DataFrame]:
    """Restrict every table to the given venues (``None`` keeps all)."""
    if venues is None:
        return tables
    wanted = list(venues)
    keys = {"venue": "__key__.id"}
    return {
        name: df.filter(F.col(keys.get(name, "venue_key_id")).isin(wanted))
        for name, df in tables.items()
    }
