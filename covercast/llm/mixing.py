"""Mixing sources to target weights by Pareto order sampling.

Every source has a target number of words: its share by weight, at most a set multiple of what it has, the
excess reshared. A document is taken ``floor(target / source size)`` times for certain; the fraction that remains is
the inclusion probability of one more copy. Documents are ranked by ``odds(u) / odds(p)``, ``u`` a uniform number
from a hash of the key, and the sample of fixed size is the start of that order whose words fit. One more document of
the source, the one that fits the gap best, closes it.

The place where a source's sample ends is found from sums over cells of the ranking number, two levels
of ``CELLS`` each, and the rows of one cell of the second level; so no task sorts a source. Decisions then depend on
the document and one small row of its source: the texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covercast.llm.storage import written

WORD = r"[^\x20\x09-\x0D]+"
CELLS = 4096
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3


def words(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(key: Column, seed: int) -> Column:
    """The document's lot: 32 hex digits from its key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))


def uniform(lot: Column) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of the lot."""
    return (F.conv(F.substring(lot, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def numbered(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``place``, the 0-based place of each row in ascending order of a column, null last.

    A global sort; each partition's offset comes from one row per partition.
    """
    placed = df.orderBy(F.col(column).asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    kept = written(placed, "numbered").withColumn("slice", F.shiftright("at", 33))
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("slice").agg(F.count("*").alias("n"))
    starts = starts.select("slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        kept.join(F.broadcast(starts), "slice")
        .withColumn("place", F.col("start") + inside)
        .drop("at", "slice", "start")
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size) rows: one row per source, null being one.

    Sources by code point, null last, weigh ``weights`` in turn and share the words of all. A target above
    ``most`` times the source's size stops there; the excess is reshared by weight until none is above.
    Each round reads two sums.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = written(numbered(sums, "source").withColumn("weight", weight.cast("bigint")).drop("place"), "sources")
    cap = F.col("source_size") * most
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        all_words, capped, weight_left = sources.select(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        # Sources that are full at one level are so at the next: levels only rise.
        new = (all_words - capped) / weight_left if weight_left else level
        if new == level or new is None:
            break
        level = new
    target = F.when(full, cap.cast("double")).otherwise(F.col("weight") * F.lit(level if level is not None else 0.0))
    return sources.select("source", "source_size", target.cast("double").alias("target"))


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """How each source is sampled, from its documents' (source, lot, size): one row per source.

    copies: certain copies of each document; p: probability of one more; last_q, last_lot: end of the sample in
    ranking order (null: empty sample); extra_lot: the document that closes the gap (null: none).
    """
    goal = written(
        targets(sizes, weights, most)
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("copies", F.floor("rate"))
        .withColumn("p", F.col("rate") - F.col("copies"))
        .withColumn("words_left", F.col("target") - F.col("copies") * F.col("source_size")),
        "targets",
    )
    ranked = joined(sizes, goal).filter("p > 0").withColumn("q", rank_number(F.col("lot"), F.col("p")))
    part = F.col("q") / (1 + F.col("q"))
    first = F.floor(part * CELLS)
    second = F.floor(part * CELLS * CELLS) - first * CELLS
    ranked = ranked.select("source", "lot", "size", "q", "words_left", first.alias("c1"), second.alias("c2"))

    def crossing(rows: DataFrame, cell: str) -> DataFrame:
        """Per source the first cell at whose end the words are too many, and the words before it."""
        sums = rows.groupBy("source", "base", "words_left", cell).agg(F.sum("size").alias("in_cell"))
        to_here = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, 0)
        running = sums.withColumn("until", F.col("base") + F.sum("in_cell").over(to_here))
        over = running.filter(F.col("until") > F.col("words_left"))
        return over.groupBy("source").agg(
            F.min(F.struct(cell, F.expr("until - in_cell").alias("base"))).alias("x")
        ).select("source", F.col(f"x.{cell}").alias(f"cut_{cell}"), F.col("x.base").alias("base"))

    one = written(crossing(ranked.withColumn("base", F.lit(0).cast("bigint")), "c1"), "cells")
    in_one = joined(ranked, one).filter(F.col("c1") == F.col("cut_c1"))
    two = written(joined(one.drop("base"), crossing(in_one, "c2")), "cells")
    in_two = joined(ranked, two).filter((F.col("c1") == F.col("cut_c1")) & (F.col("c2") == F.col("cut_c2")))
    peers = F.struct("q", "lot")
    order = Window.partitionBy("source").orderBy(peers).rangeBetween(Window.unboundedPreceding, 0)
    # The first document, in ranking order, that does not fit any more.
    stops = (
        in_two.withColumn("until", F.col("base") + F.sum("size").over(order))
        .filter(F.col("until") > F.col("words_left"))
        .groupBy("source")
        .agg(F.min(peers).alias("stop"))
    )
    stops = written(stops, "stops")
    judged = joined(ranked, stops, how="left").withColumn("fits", F.col("stop").isNull() | (peers < F.col("stop")))
    gaps = judged.groupBy("source", "words_left").agg(
        (F.col("words_left") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))), F.lit(0))).alias("gap")
    )
    gaps = written(gaps.drop("words_left"), "gaps")
    off = F.abs(F.col("size") - F.col("gap"))
    closing = (
        joined(judged.filter(~F.col("fits")), gaps)
        .filter(off < F.col("gap"))
        .groupBy("source")
        .agg(F.min(F.struct(off.alias("off"), F.col("q"), F.col("lot"))).alias("closing"))
        .select("source", F.col("closing.lot").alias("extra_lot"))
    )
    return joined(joined(goal, stops, how="left"), closing, how="left").drop("rate", "words_left")


def rank_number(lot: Column, p: Column) -> Column:
    u = uniform(lot)
    return (u / (1 - u)) / (p / (1 - p))


def joined(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, null being a source; the columns of ``right`` follow those of ``left``."""
    renamed = right.withColumnRenamed("source", "right_source")
    return left.join(renamed, F.col("source").eqNullSafe(F.col("right_source")), how).drop("right_source")


def copies(lot: Column) -> Column:
    """How often a document with this lot is taken, beside the columns of its source's row of ``plan``."""
    q = rank_number(lot, F.col("p"))
    sampled = F.col("stop").isNull() | (F.struct(q.alias("q"), lot.alias("lot")) < F.col("stop"))
    closing = F.coalesce(lot == F.col("extra_lot"), F.lit(False))
    return (F.col("copies") + F.when((F.col("p") > 0) & (sampled | closing), 1).otherwise(0)).cast("bigint")


def document_sizes(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        words(F.col(text)).alias("size"),
        draw(F.col(key), seed).alias("lot"),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row.

    Null texts and those without words have size 0; a null source is a source of its own, the last; rows with
    one key and source are taken or left together, rows with a null key as if they had one key. Reruns agree. An empty
    table gives no rows. Other columns are not read.
    """
    sizes = written(document_sizes(docs, key, text, source, seed), "sizes")
    planned = written(plan(sizes, weights, most), "plan")
    return joined(sizes, planned).select(
        "doc_id", "source", "size", "source_size", "target",
        copies(F.col("lot")).alias("copies"),
        (copies(F.col("lot")) * F.col("size")).alias("taken"),
    )


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, all columns kept; decisions are made in place."""
    sizes = written(document_sizes(docs, key, text, source, seed), "sizes")
    planned = written(plan(sizes, weights, most), "plan")
    packed = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(source).cast("string").alias("source"),
        draw(F.col(key), seed).alias("lot"),
    )
    times = F.array_repeat(F.lit(0), copies(F.col("lot")).cast("int"))
    return joined(packed, planned).select("doc", F.explode(times).alias("copy")).select("doc.*")
