"""What a fitted model loses when one feature is shuffled among the rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covercast.operators import evaluate, rows
from covercast.operators.totals import in_parts
from covercast.plans import model as models


def in_random_order(df: DataFrame, keys: Iterable[str], seed: int) -> DataFrame:
    """``df`` with ``_position``, from 0 without gaps, in the order of a hash of the keys."""
    keys = list(keys)
    hashed = df.withColumn("_lot", rows.row_hash(keys, seed))
    placed = in_parts(hashed, ["_lot", *keys], "positions")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    # One row per part.
    numbered = placed.join(F.broadcast(ahead), "_part").withColumn("_position", F.col("_ahead") + F.col("_place"))
    return numbered.drop("_lot", "_part", "_place", "_ahead")


def shuffled(df: DataFrame, features: list[str], keys: Iterable[str], seed: int = 42) -> DataFrame:
    """Every row once as it is and once per feature with that feature's value from another row; ``variant`` names the feature or is null.

    The rows stand in random order on a ring; a feature's values move along it by a number of places of their own. One
    keyed shuffle brings every value to its new row, as text.
    """
    numbered = in_random_order(df, keys, seed)
    n = numbered.agg(F.count(F.lit(1))).scalar()
    # Places between a third and two thirds of the ring, another number for each feature.
    moves = [F.floor(n * (0.35 + 0.3 * (i + 0.5) / len(features))) + 1 for i in range(len(features))]
    sent = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("at"), ((F.col("_position") + move) % n).alias("_position"), F.col(c).cast("string").alias("value"))
                for i, (c, move) in enumerate(zip(features, moves))
            ]
        )
    )
    arrived = numbered.select(sent.alias("s")).select("s.*").groupBy("_position")
    values = arrived.agg(*[F.max(F.when(F.col("at") == i, F.col("value"))).alias(f"_new{i}") for i in range(len(features))])
    kinds = {f.name: f.dataType for f in df.schema}
    variants = F.explode(F.array(F.lit(None).cast("int"), *[F.lit(i) for i in range(len(features))]))
    each = numbered.join(values, "_position").withColumn("_variant", variants)
    moved = {
        c: F.when(F.col("_variant") == i, F.col(f"_new{i}").cast(kinds[c])).otherwise(F.col(c)) for i, c in enumerate(features)
    }
    name = F.get(F.array(*[F.lit(c) for c in features]), F.col("_variant")).alias("variant")
    return each.withColumns(moved).select(*df.columns, name)


def shuffled_importances(
    model: PipelineModel, df: DataFrame, features: Iterable[str], keys: Iterable[str], seed: int = 42
) -> DataFrame:
    """(feature, importance): the AUC over the labelled rows of ``df`` less that with the feature shuffled.

    All variants are scored in one pass, and their AUCs come from prefix sums over cells of the scores. keys: columns that tell rows
    apart; they make the shuffle the same in every run. Null with a single class; a table without rows gives none.
    """
    judged = models.score(model, shuffled(df, list(features), keys, seed))
    found = evaluate.metrics_by(judged, "variant").select("variant", "auc_score")
    # One row per feature, computed here: the base would be a second pass over all variants.
    auc = df.sparkSession.createDataFrame(found.collect(), found.schema)
    base = auc.filter("variant IS NULL").select("auc_score").scalar()
    lost = auc.filter("variant IS NOT NULL").select(F.col("variant").alias("feature"), (base - F.col("auc_score")).alias("importance"))
    return lost
