"""Rows in global order over parts of even size, and running totals for keys of any size."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covercast.shared import stored

#: Bits of the place of a row inside its part.
PLACE_BITS = 33


def in_parts(df: DataFrame, order: Iterable[str], tag: str) -> DataFrame:
    """``df`` with ``_part`` and ``_place``: rows in ascending order (nulls first), first by part, then by place in it, from 0.

    Parts are ranges of the order between sampled bounds, so a key with most of the rows has many; rows equal in the order share
    one. The rows are stored, so that every use sees the same places.
    """
    order = list(order)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(placed.withColumn("_place", F.monotonically_increasing_id()), tag)
    return kept.withColumns(
        {
            "_part": F.shiftright("_place", PLACE_BITS),
            "_place": F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)),
        }
    )


def running_total(
    df: DataFrame,
    keys: Iterable[str],
    order: Iterable[str],
    values: dict[str, Column | str],
    frame: str = "rows",
) -> DataFrame:
    """``asof.running_sum`` for keys of any size: running totals per key, null counting as 0.

    Two levels: totals inside a part of a key, and of the parts of the key before it, of which there is one row each. So no task
    reads a key whole. ``frame="range"`` gives rows that are equal in ``order`` the same total; with "rows" their order among
    themselves is open. Null keys and order values are values like others, the latter first.
    """
    keys, order = list(keys), list(order)
    columns = {n: F.coalesce(F.col(v) if isinstance(v, str) else v, F.lit(0)) for n, v in values.items()}
    # One column that is never null, so that the windows and the join deal rows alike.
    grouped = df.withColumns({"_group": F.struct(*keys), **{f"_{n}": v for n, v in columns.items()}})
    placed = in_parts(grouped, ["_group", *order], "parts")
    inside = Window.partitionBy("_group", "_part")
    upto = (Window.unboundedPreceding, Window.currentRow)
    if frame == "rows":
        inside = inside.orderBy("_place").rowsBetween(*upto)
    elif len(order) == 1:
        inside = inside.orderBy(*order).rangeBetween(*upto)
    else:
        inside = inside.orderBy(F.struct(*order)).rangeBetween(*upto)
    local = placed.withColumns({n: F.sum(f"_{n}").over(inside) for n in columns})
    parts = placed.groupBy("_group", "_part").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in columns])
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.select(
        "_group", "_part", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}_before") for n in columns]
    )
    added = {n: F.col(n) + F.col(f"_{n}_before") for n in columns}
    return local.join(ahead, ["_group", "_part"]).withColumns(added).select(*df.columns, *columns)
