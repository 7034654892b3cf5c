"""Evaluation tables over scored rows.

Scored rows carry ``is_hot`` (0/1), ``hot_probability`` in 0..1 and, after
``with_class``, ``predicted_hot`` (0/1).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covercast.functions.basic import safe_ratio

LABEL, SCORE, PREDICTED = "is_hot", "hot_probability", "predicted_hot"
# Fixed value: header of the saved back-test.
CORRECT = "correct_prediction"

# Columns of a saved back-test.
BACKTEST_COLUMNS = [
    "shift_date", "venue_key_id", "persistent_id", LABEL, PREDICTED, SCORE, CORRECT,
]


def with_class(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add the predicted class and whether it is right."""
    predicted = (F.col(SCORE) > threshold).cast("int")
    return scored.withColumn(PREDICTED, predicted).withColumn(
        CORRECT, F.col(LABEL) == F.col(PREDICTED)
    )


def backtest_output(scored: DataFrame) -> DataFrame:
    return scored.select(*BACKTEST_COLUMNS)


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0).cast("bigint"))


def confusion_counts(scored: DataFrame) -> DataFrame:
    actual, predicted = F.col(LABEL) == 1, F.col(PREDICTED) == 1
    return scored.agg(
        _count(actual & predicted).alias("true_positives"),
        _count(~actual & predicted).alias("false_positives"),
        _count(~actual & ~predicted).alias("true_negatives"),
        _count(actual & ~predicted).alias("false_negatives"),
    )


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(safe_ratio(part, whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _or_zero(2 * precision * recall, precision + recall)


def classification_metrics(scored: DataFrame) -> DataFrame:
    """One row: accuracy, AUC, precision, recall, F1 (0 when undefined), counts."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    counts = confusion_counts(scored)
    return counts.select(
        safe_ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        roc_auc(scored).scalar().alias("auc_score"),
        _or_zero(tp, tp + fp).alias("precision_hot"),
        _or_zero(tp, tp + fn).alias("recall_hot"),
        _f1(_or_zero(tp, tp + fp), _or_zero(tp, tp + fn)).alias("f1_score"),
        *counts.columns,
    )


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and means."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")

    def entry(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class_label"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1_score"),
            support.alias("support"),
        )

    cold = (_or_zero(tn, tn + fn), _or_zero(tn, tn + fp))
    hot = (_or_zero(tp, tp + fp), _or_zero(tp, tp + fn))
    cold, hot = (*cold, _f1(*cold)), (*hot, _f1(*hot))
    colds, hots = tn + fp, tp + fn
    total = colds + hots
    missing = F.lit(None).cast("double")
    rows = [
        entry("0", *cold, colds),
        entry("1", *hot, hots),
        entry("accuracy", missing, missing, _or_zero(tp + tn, total), total),
        entry("macro avg", *[(c + h) / 2 for c, h in zip(cold, hot)], total),
        entry("weighted avg", *[_or_zero(c * colds + h * hots, total) for c, h in zip(cold, hot)], total),
    ]
    return confusion_counts(scored).select(F.inline(F.array(*rows)))


def accuracy_by(scored: DataFrame, *keys: str) -> DataFrame:
    return scored.groupBy(*keys).agg(*_accuracy())


def _accuracy() -> list[Column]:
    return [
        F.round(F.avg((F.col(LABEL) == F.col(PREDICTED)).cast("int")), 4).alias("accuracy"),
        F.count(LABEL).alias("shifts"),
        F.sum(LABEL).alias("hot_shifts"),
        F.sum(PREDICTED).alias("predicted_hot_shifts"),
    ]


def accuracy_by_weekday(scored: DataFrame) -> DataFrame:
    return accuracy_by(scored, "day_of_week")


def accuracy_by_horizon(scored: DataFrame, edges: Iterable[int] = (0, 7, 30, 90, 365)) -> DataFrame:
    """Accuracy per lead-time bin, open below and closed above; day 0 is in none."""
    edges = list(edges)
    bins = [(f"({lo}, {hi}]", lo, hi) for lo, hi in zip(edges, edges[1:])]
    d = F.col("day_prior")
    picked = F.coalesce(*[F.when((d > lo) & (d <= hi), F.lit(name)) for name, lo, hi in bins])
    found = (
        scored.withColumn("horizon", picked)
        .filter(F.col("horizon").isNotNull())
        .groupBy("horizon")
        .agg(*_accuracy())
    )
    spine = scored.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name, _, _ in bins])).alias("horizon")
    )
    # At most one row per bin on either side.
    return spine.join(F.broadcast(found), "horizon", "left").na.fill(
        0, ["shifts", "hot_shifts", "predicted_hot_shifts"]
    )


def score_summary(scored: DataFrame, day_col: str = "shift_date") -> DataFrame:
    total, hot = F.count(F.lit(1)), F.sum(PREDICTED)
    return scored.agg(
        total.alias("total_shifts"),
        hot.alias("predicted_hot_shifts"),
        (100 * safe_ratio(hot, total)).alias("predicted_hot_percent"),
        F.avg(SCORE).alias("avg_hot_probability"),
        F.min(day_col).alias("first_date"),
        F.max(day_col).alias("last_date"),
    )


def top_hot_shifts(scored: DataFrame, n: int = 10, keys: Iterable[str] = ("shift_date", "venue_key_id", "persistent_id")) -> DataFrame:
    """The ``n`` likeliest hot rows; ties by key."""
    return scored.orderBy(F.desc(SCORE), *keys).limit(n)


# --- ranking curves -----------------------------------------------------------

_CELL_BITS, _BLOCK_BITS = 24, 12


def _score_levels(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with its place in the range.

    With ``by`` they are counted per group, one column ``group`` of all its values (so null ones are like others), along with
    the rows of either class that are predicted hot. The null tests match those Spark derives where the levels are joined,
    so that all uses share one scan and shuffle.
    """
    label = F.col(LABEL).cast("bigint")
    inside = F.least(F.greatest(F.col(SCORE), F.lit(0.0)), F.lit(1.0))
    sums = {"pos": label, "neg": 1 - label}
    if by:
        scored = scored.withColumn("group", F.struct(*by))
        hot = F.coalesce(F.col(PREDICTED).cast("bigint"), F.lit(0))
        sums |= {"hits": label * hot, "alarms": (1 - label) * hot}
    levels = scored.groupBy(*_group(by), SCORE).agg(*[F.sum(x).alias(name) for name, x in sums.items()])
    placed = levels.withColumn("cell", F.floor(inside * (1 << _CELL_BITS))).withColumn(
        "block", F.shiftright("cell", _BLOCK_BITS)
    )
    return placed.filter(F.col("cell").isNotNull() & F.col("block").isNotNull())


def _group(by: tuple[str, ...]) -> list[str]:
    return ["group"] if by else []


def _cumulative(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per distinct score, and group if any: ``tp``/``fp`` counted from the top, and the totals.

    Prefix sums in three levels, so no task sorts all scores: blocks of the
    score range (at most 4097 rows a group), cells of a block (at most 4096 rows), and
    the distinct scores inside one cell of width 2^-24.
    """
    levels, group = _score_levels(scored, by), _group(by)
    counted = ["pos", "neg", *(["hits", "alarms"] if by else [])]
    sums = [F.sum(c).alias(c) for c in counted]
    cells = levels.groupBy(*group, "block", "cell").agg(*sums)
    above = (Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*group)
    by_block = everything.orderBy(F.desc("block")).rowsBetween(*above)
    by_cell = Window.partitionBy(*group, "block").orderBy(F.desc("cell")).rowsBetween(*above)
    by_score = (
        Window.partitionBy(*group, "cell").orderBy(F.desc(SCORE))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def base(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    totals = [f"all_{c}" for c in counted] + [f"cell_{c}" for c in counted[2:]]
    blocks = cells.groupBy(*group, "block").agg(*sums).select(
        *group,
        "block",
        base("pos", by_block).alias("pos_before_block"),
        base("neg", by_block).alias("neg_before_block"),
        *[F.sum(c).over(everything).alias(f"all_{c}") for c in counted],
    )
    # One row per block; per block and group there may be any number.
    bases = cells.join(blocks if by else F.broadcast(blocks), [*group, "block"]).select(
        *group,
        "cell",
        (F.col("pos_before_block") + base("pos", by_cell)).alias("pos_before"),
        (F.col("neg_before_block") + base("neg", by_cell)).alias("neg_before"),
        *[f"all_{c}" for c in counted],
        *[cells[c].alias(f"cell_{c}") for c in counted[2:]],
    )
    return levels.drop("block").join(bases, [*group, "cell"]).select(
        *group,
        SCORE,
        *counted,
        *totals,
        (F.col("pos_before") + F.sum("pos").over(by_score)).alias("tp"),
        (F.col("neg_before") + F.sum("neg").over(by_score)).alias("fp"),
    )


def _area() -> Column:
    """Pairs won, counted from the negatives and from the positives, in shares of all pairs."""
    by_negative = F.col("neg") * (2.0 * F.col("tp") - F.col("pos"))
    by_positive = F.col("pos") * (2.0 * (F.col("all_neg") - F.col("fp")) + F.col("neg"))
    won = (F.sum(by_negative) + F.sum(by_positive)) / 2
    return F.try_divide(won, 2.0 * F.max("all_pos") * F.max("all_neg"))


def metrics_by(scored: DataFrame, *by: str) -> DataFrame:
    """``classification_metrics`` of every group of ``by``, null values included, from one scan of the rows.

    Rows without a score or a label count nowhere, and a group of such rows has no metrics. The counts are read from
    the scores, the cells and the totals, of which none is larger than the total, so that all levels share one scan.
    """

    def total(column: str) -> Column:
        return F.greatest(F.sum(column), F.max(f"all_{column}"), *([F.max(f"cell_{column}")] if column in ("hits", "alarms") else []))

    known = scored.filter(F.col(SCORE).isNotNull() & F.col(LABEL).isNotNull())
    rows = _cumulative(known, by).groupBy("group").agg(
        _area().alias("auc_score"),
        total("hits").alias("true_positives"),
        total("alarms").alias("false_positives"),
        (total("neg") - total("alarms")).alias("true_negatives"),
        (total("pos") - total("hits")).alias("false_negatives"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    return rows.select(
        "group.*",
        safe_ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        "auc_score",
        _or_zero(tp, tp + fp).alias("precision_hot"),
        _or_zero(tp, tp + fn).alias("recall_hot"),
        _f1(_or_zero(tp, tp + fp), _or_zero(tp, tp + fn)).alias("f1_score"),
        *rows.columns[2:],
    )


def roc_auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve; ties count half. Null with a single class.

    Pairs won are counted from the negatives and from the positives and
    averaged: both sums are equal, and reading both keeps every column alive so
    that all levels of the prefix sums share one scan.
    """
    return _cumulative(scored).agg(_area().alias("auc_score"))


def _with_end_point(points: DataFrame, end: dict[str, float | None]) -> DataFrame:
    row = points.sparkSession.range(1).select(
        *[F.lit(end[f.name]).cast(f.dataType).alias(f.name) for f in points.schema]
    )
    return points.unionByName(row)


def roc_points(scored: DataFrame) -> DataFrame:
    """False and true positive rate at every score, plus the origin."""
    points = _cumulative(scored).select(
        F.col(SCORE).alias("threshold"),
        safe_ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        safe_ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    return _with_end_point(points, {"threshold": None, "fpr": 0.0, "tpr": 0.0})


def pr_points(scored: DataFrame) -> DataFrame:
    """Precision and recall at every score, plus the end point (1, 0)."""
    points = _cumulative(scored).select(
        F.col(SCORE).alias("threshold"),
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("all_pos")).alias("recall"),
    )
    return _with_end_point(points, {"threshold": None, "precision": 1.0, "recall": 0.0})


# --- distributions ------------------------------------------------------------


def score_histogram(scored: DataFrame, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width counts between the lowest and highest score, per class of
    ``by`` when given. The last bin is closed; empty bins are listed."""
    # Without classes every row has key 0, by an expression that stays a join key.
    group = F.col(by) if by else F.pmod(F.hash(SCORE), F.lit(1))
    rows = scored.select(group.alias("g"), F.col(SCORE).alias("x")).filter(
        F.col("g").isNotNull() & F.col("x").isNotNull()
    )
    flat = F.col("lo") == F.col("hi")
    ranges = rows.groupBy("g").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).select(
        "g",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.least(F.floor((F.col("x") - F.col("lo")) / width).cast("int"), F.lit(bins - 1))
    counts = (
        # One range per class, or a single one.
        rows.join(F.broadcast(ranges), "g").groupBy("g", at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    spine = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    result = spine.join(counts, ["g", "bin"], "left").select(
        F.col("g").alias(by or "g"),
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )
    return result if by else result.drop("g")


def calibration_curve(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Share of hot rows per score bin, open below and closed above, 0 when empty."""
    index = F.ceil(F.col(SCORE) * bins).cast("int") - 1
    found = (
        scored.filter((F.col(SCORE) > 0) & (F.col(SCORE) <= 1))
        .groupBy(index.alias("bin"))
        .agg(F.avg(LABEL).alias("share"), F.count(F.lit(1)).alias("n"))
    )
    spine = scored.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # At most one row per bin on either side.
    return spine.join(F.broadcast(found), "bin", "left").select(
        "bin",
        ((2 * F.col("bin") + 1) / (2.0 * bins)).alias("bin_center"),
        F.coalesce("share", F.lit(0.0)).alias("fraction_of_positives"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )
