"""Descriptive names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def venue_lookup(df: DataFrame, venues: DataFrame) -> DataFrame:
    """Add ``venue_name`` by the nested venue key."""
    names = venues.select(
        F.col("__key__.id").alias("venue_key_id"), F.col("name").alias("venue_name")
    )
    return df.join(names, "venue_key_id", "left")


def shift_names(templates: DataFrame) -> DataFrame:
    """One name per shift: that of its newest template."""
    return templates.groupBy("venue_key_id", "persistent_id").agg(
        F.max_by("name", "int_id").alias("shift_name")
    )


def shift_name_lookup(df: DataFrame, templates: DataFrame) -> DataFrame:
    """Add ``shift_name`` without multiplying rows over template versions."""
    return df.join(shift_names(templates), ["venue_key_id", "persistent_id"], "left")
