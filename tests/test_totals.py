"""Running totals for keys of any size, numbered categories, and points in intervals, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from covercast.operators import asof, bookings, encode, intervals, totals


def skewed(spark, n=20_000):
    """One key with nine tenths of the rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 10 < 9, "big").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(3000)).alias("at"),
        F.when(F.col("id") % 13 > 0, F.col("id") % 5).alias("x"),
        "id",
    )


@pytest.fixture(autouse=True)
def small_parts(spark):
    """Parts as on large inputs, where the adaptive planner does not merge them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("frame", ["rows", "range"])
def test_running_totals_equal_the_plain_window(spark, frame):
    df = skewed(spark)
    order = ["at", "id"] if frame == "rows" else ["at"]
    values = {"total": "x", "twice": F.col("x") * 2}
    got = totals.running_total(df, ["k"], order, values, frame)
    want = asof.running_sum(df, ["k"], order, values, frame)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and got.count() == 20_000


def test_no_part_of_a_key_is_the_whole_key(spark):
    placed = totals.in_parts(skewed(spark), ["k", "at", "id"], "t")
    parts = placed.groupBy("_part").agg(F.count("*").alias("n"), F.max("_place").alias("m")).collect()
    assert len(parts) > 4 and max(r.n for r in parts) < 0.5 * 20_000
    assert all(r.m == r.n - 1 for r in parts)


def test_null_keys_order_values_and_an_empty_table(spark):
    rows = [(None, None, 1), (None, 2, 2), ("a", 1, None), ("a", None, 5), ("a", 1, 7)]
    df = spark.createDataFrame(rows, "k string, at int, x int")
    got = totals.running_total(df, ["k"], ["at"], {"t": "x"}, "range").collect()
    assert {(r.k, r["at"], r.x, r.t) for r in got} == {(None, None, 1, 1), (None, 2, 2, 3), ("a", None, 5, 5), ("a", 1, None, 12), ("a", 1, 7, 12)}
    two = totals.running_total(df, ["k"], ["at", "x"], {"t": "x"}, "range").collect()
    assert ("a", 1, None, 5) in {(r.k, r["at"], r.x, r.t) for r in two}
    assert totals.running_total(df.limit(0), ["k"], ["at"], {"t": "x"}).collect() == []


def test_dictionary_and_codes(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abéZ ") for _ in range(rng.randint(0, 4))) for _ in range(3000)] + [None] * 5
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, i int")
    numbers = encode.dictionary(df.filter("i % 3 > 0 or w is null"), "w")
    known = sorted({w for i, w in enumerate(words) if w is not None and i % 3 > 0}, key=str.encode)
    assert {(r.value, r.number) for r in numbers.collect()} == {(w, n) for n, w in enumerate(known)}
    expected = {i: known.index(w) if w in known else len(known) for i, w in enumerate(words)}
    coded = encode.encoded(df, {"w": numbers})
    assert {r.i: r.w_index for r in coded.collect()} == expected
    back = encode.decoded(coded, {"w": numbers}).collect()
    assert {r.i: r.w for r in back} == {i: w if w in known else None for i, w in enumerate(words)}
    empty = encode.dictionary(df.limit(0), "w")
    assert [r.w_index for r in encode.encoded(df.limit(2), {"w": empty}).collect()] == [0, 0]


def pairs(spark, spans, points, kind):
    a = spark.createDataFrame(spans, f"i int, k string, lo {kind}, hi {kind}")
    b = spark.createDataFrame(points, f"k string, t {kind}, p int")
    met = intervals.interval_join(a, b, ["k"], "lo", "hi", "t")
    assert met.columns == ["i", "k", "lo", "hi", "t", "p"]
    return sorted((r.i, r.p) for r in met.collect())


def naive(spans, points):
    return sorted(
        (i, p) for i, k, lo, hi in spans for j, t, p in points
        if None not in (k, lo, hi, t) and k == j and lo <= t < hi
    )


def test_intervals_of_any_length_and_overlap(spark):
    rng = random.Random(3)
    edge = lambda: rng.choice([rng.randint(-50, 50), rng.randint(-(2**40), 2**40)])
    spans = [(i, rng.choice("ab"), *((x := edge()), x + rng.choice([0, 1, 2, 7, 8, 9, 1000, 2**39, -5]))) for i in range(120)]
    spans += [(900, None, 0, 9), (901, "a", None, 9), (902, "a", 0, None)]
    points = [(rng.choice("ab"), rng.choice([edge(), *[s[2] for s in spans[:40]], *[s[3] for s in spans[:40]]]), p) for p in range(300)]
    points += [("a", None, 900), (None, 3, 901)]
    expected = naive(spans, points)
    assert len(expected) > 300
    assert pairs(spark, spans, points, "bigint") == expected
    assert pairs(spark, [], points, "bigint") == pairs(spark, spans, [], "bigint") == []


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_times_and_days(spark, kind):
    rng = random.Random(4)
    base = dt.datetime(1969, 12, 30)
    step = dt.timedelta(days=1) if kind == "date" else dt.timedelta(microseconds=500_001)
    at = lambda n: (base + n * step).date() if kind == "date" else base + n * step
    spans = [(i, "a", at(x := rng.randint(0, 300)), at(x + rng.randint(0, 60))) for i in range(60)]
    points = [("a", at(n), n) for n in range(0, 360, 3)]
    assert pairs(spark, spans, points, kind) == naive(spans, points)


def test_no_pairwise_join_and_few_candidates(spark):
    """A busy key is dealt by time: with broadcasts off there is no nested loop, and pairs that meet are few more than pairs that match."""
    spans = spark.range(2000).selectExpr("id AS i", "1 AS k", "id * 50 AS lo", "id * 50 + 40 + id % 30 AS hi")
    points = spark.range(50_000).selectExpr("1 AS k", "id * 2 AS t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = intervals.interval_join(spans, points, ["k"], "lo", "hi", "t")
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_cell" in plan
    assert met.count() == sum((i * 50 + 40 + i % 30 + 1) // 2 - i * 25 for i in range(2000) for _ in [0]) - sum(
        max(0, (i * 50 + 40 + i % 30 + 1) // 2 - 50_000) for i in range(2000)
    )


def test_arrivals_of_overlapping_sittings(spark):
    t = lambda h, m=0: dt.datetime(2024, 5, 1, h, m)
    sittings = spark.createDataFrame(
        [(1, "a", t(10), t(12)), (1, "b", t(11), dt.datetime(2024, 5, 2, 1)), (2, "a", t(10), t(12)), (3, "a", t(10), t(10))],
        "venue_key_id bigint, persistent_id string, opens timestamp_ntz, closes timestamp_ntz",
    )
    due = [(1, t(10), "OK", 2), (1, t(11, 59), "OK", 3), (1, t(12), "OK", None), (1, t(11), "CANCELED", 9), (1, t(11), None, 9), (1, None, "OK", 9)]
    due += [(1, dt.datetime(2024, 5, 2, 0, 59), "OK", 4), (2, t(9), "OK", 9), (3, t(10), "OK", 9)]
    reservations = spark.createDataFrame(due, "venue_key_id bigint, marked_time timestamp_ntz, status string, max_guests int")
    got = bookings.arrivals_while_open(sittings, reservations, ["venue_key_id", "persistent_id"]).collect()
    assert {(r.venue_key_id, r.persistent_id): (r.guests, r.parties) for r in got} == {(1, "a"): (5, 2), (1, "b"): (7, 3), (2, "a"): (0, 0), (3, "a"): (0, 0)}
