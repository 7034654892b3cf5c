"""Rows in key order over partitions of known bounds, without a task that sees all of them.

The bounds are quantiles of the key, so partitions are even; a partition's number grows with the key.
Offsets and neighbours across partitions then need one small row per partition only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covercast.llm.storage import partitions


def bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most ``parts - 1`` rising values that cut the rows of ``df`` into even shares by an integer key."""
    if parts < 2:
        return []
    steps = [i / parts for i in range(1, parts)]
    cuts = df.select(F.col(key).cast("double").alias("k")).approxQuantile("k", steps, 0.2 / parts)
    return sorted({int(x) for x in cuts})


def part_of(key: Column, cuts: list[int]) -> Column:
    """Number of cuts at or below the key (null: 0), by a search over two levels of about a root of them each."""
    if not cuts:
        return F.lit(0)
    width = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + width] for i in range(0, len(cuts), width)]

    def at_or_below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= key))

    heads = F.array(*[F.lit(b[0]).cast("bigint") for b in blocks])
    tables = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in b]) for b in blocks])
    block = at_or_below(heads)
    inside = F.when(block == 0, 0).otherwise(
        (block - 1) * width + at_or_below(F.try_element_at(tables, F.greatest(block, F.lit(1))))
    )
    return F.coalesce(F.when(key.isNotNull(), inside), F.lit(0)).cast("int")


def in_order(df: DataFrame, key: str, ties: list[str], parts: int | None = None) -> DataFrame:
    """``df`` with a column ``part``; partition ``i`` holds the rows of part ``i``, sorted by key (nulls first), then ties."""
    n = parts or partitions(df.sparkSession)
    cuts = bounds(df, key, n)
    placed = df.withColumn("part", part_of(F.col(key), cuts))
    return placed.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(
        F.col(key).asc_nulls_first(), *ties
    )


def with_follower(df: DataFrame, key: str, ties: list[str], parts: int | None = None) -> DataFrame:
    """As ``in_order``; each partition ends with a copy (``extra``) of the row after its last one.

    After the last row of all comes the first. One key and part number per partition reach the driver
    and are broadcast.
    """
    n = parts or partitions(df.sparkSession)
    cuts = bounds(df, key, n)
    placed = df.withColumn("part", part_of(F.col(key), cuts))
    firsts = (
        placed.groupBy("part")
        .agg(F.min(key).alias("first"), F.max(F.col(key).isNull()).alias("has_null"))
        .orderBy("part")
        .collect()
    )
    rows = [
        (r["part"], firsts[at - 1]["part"], None if r["has_null"] else r["first"]) for at, r in enumerate(firsts)
    ]
    heads = df.sparkSession.createDataFrame(rows, "part int, before int, first bigint")
    own = [F.lit(False).alias("extra"), F.col("part").alias("at")]
    copy = [F.lit(True).alias("extra"), F.col("before").alias("at")]
    target = F.explode(
        F.when(
            F.col("first").eqNullSafe(F.col(key)), F.array(F.struct(*own), F.struct(*copy))
        ).otherwise(F.array(F.struct(*own)))
    ).alias("target")
    return (
        placed.join(F.broadcast(heads), "part")
        .select(*df.columns, target)
        .select(*df.columns, F.col("target.at").alias("part"), F.col("target.extra").alias("extra"))
        .repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("extra", F.col(key).asc_nulls_first(), *ties)
    )
