"""Intermediate tables in the shared folder of the session, and what Python workers need."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from covercast.shared import importable, shared_folder

__all__ = ["fresh_path", "importable", "partitions", "written"]


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table of the shared folder: computed once, and every executor can read it again."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
