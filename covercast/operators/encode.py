"""Categories as numbers, by dictionaries that never pass through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covercast.operators.totals import in_parts


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, number) of the distinct values of a column that are not null, numbered from 0 in ascending order.

    Values are sorted in parts; a value's number is its place in the part and the size of the parts before, of which
    there is one row each.
    """
    values = df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct()
    placed = in_parts(values, ["value"], "dictionary")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    # One row per part.
    return placed.join(F.broadcast(ahead), "_part").select("value", (F.col("_ahead") + F.col("_place")).alias("number"))


def encoded(df: DataFrame, dictionaries: dict[str, DataFrame], suffix: str = "_index") -> DataFrame:
    """``df`` with the number of each value; values that the dictionary lacks, and null, get the number after the last.

    A dictionary is broadcast where its files are below ``spark.sql.autoBroadcastJoinThreshold``, else joined by shuffle.
    """
    for column, numbers in dictionaries.items():
        size = numbers.agg(F.count(F.lit(1))).scalar()
        named = numbers.select(F.col("value").alias("_value"), F.col("number").alias("_number"))
        joined = df.join(named, F.col(column) == F.col("_value"), "left")
        df = joined.withColumn(f"{column}{suffix}", F.coalesce("_number", size)).drop("_value", "_number")
    return df


def decoded(df: DataFrame, dictionaries: dict[str, DataFrame], suffix: str = "_index") -> DataFrame:
    """``df`` with the value of each number of ``encoded``; null for the number after the last."""
    for column, numbers in dictionaries.items():
        named = numbers.select(F.col("value").alias(column), F.col("number").alias("_number"))
        df = df.drop(column).join(named, F.col(f"{column}{suffix}") == F.col("_number"), "left").drop("_number")
    return df
