"""Exact quantiles of groups of any size, by refinement of order-preserving cells."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells per doubling of the value, and cells that a chosen cell is cut into.
PER_OCTAVE, CELLS = 16, 4096
#: Refinements after which a cell holds at most 4096 distinct doubles: 2^52 of them per octave.
ROUNDS = 3
# Beyond every cell of a finite double: exponents go from -1074 to 1024.
_ZERO, _TOP = 1200 * PER_OCTAVE, 4000 * PER_OCTAVE


def octave_cell(x: Column) -> Column:
    """A number of the value that never falls as the value rises; not a number comes last."""
    size = (F.floor(F.log2(F.abs(x)) * PER_OCTAVE) + _ZERO).cast("bigint")
    infinite = F.abs(x) == float("inf")
    size = F.when(infinite, _TOP).otherwise(size)
    return F.when(F.isnan(x), 2 * _TOP).when(x == 0, 0).when(x > 0, size).otherwise(-size)


def _inner_cell(x: Column, low: Column, high: Column) -> Column:
    """The same inside a cell whose values lie between ``low`` and ``high``."""
    # Halves, so that the difference of any two doubles is finite.
    share = (x / 2 - low / 2) / (high / 2 - low / 2)
    return F.when(high > low, F.least(F.floor(share * CELLS).cast("bigint"), F.lit(CELLS - 1))).otherwise(0)


def exact_quantile(df: DataFrame, keys: Iterable[str], value: str, q: float, name: str) -> DataFrame:
    """The ``ceil(q n)``-th smallest of the ``n`` values that are not null, at least the first, per group of ``keys``.

    Null keys form groups; a group without values has null. Not a number counts as the largest value. No group is ever sorted or
    collected: values are counted per cell of a scale of at most ``2 * 2100 * PER_OCTAVE`` cells a group, the cell that holds the rank is cut into
    ``CELLS`` by its own least and largest value, ``ROUNDS`` times, and then holds at most 4096 distinct doubles, of which
    the counts decide. Each round joins one row per group; equal values are counted together before they are shuffled.
    """
    keys = list(keys)
    given = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    group = [f"_k{i}" for i in range(len(keys))]
    x = F.col("_x")
    values = df.select(*given, F.col(value).cast("double").alias("_x")).filter(x.isNotNull())
    levels = values.groupBy(*group, "_x").agg(F.count(F.lit(1)).alias("_n"))
    placed = levels.withColumn("_cell", octave_cell(x))
    per_group = Window.partitionBy(*group)
    before, upto = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, Window.currentRow)

    def crossing(rows: DataFrame, inner: Column, wanted: Column) -> DataFrame:
        """Per group the inner cell in which the running count reaches the wanted number, its bounds, and what is left of the number."""
        kept = [*group, "_cell", *[c for c in ("_left",) if c in rows.columns]]
        cells = rows.groupBy(*kept, inner.alias("_inner")).agg(F.sum("_n").alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
        ahead = F.coalesce(F.sum("_n").over(per_group.orderBy("_inner").rowsBetween(*before)), F.lit(0))
        found = cells.withColumns({"_wanted": wanted, "_ahead": ahead}).filter(
            (F.col("_ahead") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_ahead") + F.col("_n"))
        )
        return found.select(*group, "_cell", "_low", "_high", (F.col("_wanted") - F.col("_ahead")).alias("_left"))

    def inside(chosen: DataFrame) -> DataFrame:
        """The values of every group that lie between the bounds of its chosen cell."""
        names = [*group, "_cell"]
        at = chosen.withColumnsRenamed({c: f"{c}_at" for c in names})
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{c}_at")) for c in names))
        return placed.join(at, same & x.between(F.col("_low"), F.col("_high"))).drop(*[f"{c}_at" for c in names])

    chosen = crossing(placed, F.col("_cell"), F.greatest(F.ceil(F.sum("_n").over(per_group) * F.lit(q)), F.lit(1)))
    for _ in range(ROUNDS):
        chosen = crossing(inside(chosen), _inner_cell(x, F.col("_low"), F.col("_high")), F.col("_left"))
    # The values of the last cell in order: at most as many as it has distinct doubles.
    counted = inside(chosen).withColumn("_upto", F.sum("_n").over(per_group.orderBy("_x").rowsBetween(*upto)))
    reached = (F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left"))
    named = [F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)]
    empty = df.groupBy(*given).agg(F.count(value).alias("_n")).filter("_n = 0").select(*named, F.lit(None).cast("double").alias(name))
    return counted.filter(reached).select(*named, x.alias(name)).unionByName(empty)
