"""Intermediate tables in the shared folder of the session, and what Python workers need."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows from which a table in fewer parts than cores is dealt out.
DEALT = 10_000

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def importable(spark: SparkSession) -> None:
    """Let Python workers that start from now on import this package from where the driver has it."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors can read.

    Where that is unset, one beside the warehouse tables if driver and executors are one process; else it has to be set.
    """
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not folder and master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work").rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table of the shared folder: computed once, and every executor can read it again."""
    path = f"{shared_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_over_cores(df: DataFrame, tag: str) -> DataFrame:
    """``stored``, for short rows that make many: where its files are fewer than the cores, they are dealt out when read."""
    found = stored(df, tag)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if found.rdd.getNumPartitions() < cores and found.count() >= DEALT:
        return found.repartition(cores)
    return found
