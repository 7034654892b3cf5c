"""Exact quantiles: against a sorted list, groups of any size and spread, odd values, and no task that holds a group."""

import math
import random

import pytest
from pyspark.sql import functions as F

from covercast.operators.quantile import exact_quantile, octave_cell

NAN, INF = float("nan"), float("inf")


def direct(rows, q):
    groups = {}
    for k, x in rows:
        groups.setdefault(k, []).extend([] if x is None else [x])
    out = {}
    for k, xs in groups.items():
        xs = sorted(xs, key=lambda x: (math.isnan(x), x if not math.isnan(x) else 0))
        out[k] = xs[max(1, math.ceil(q * len(xs))) - 1] if xs else None
    return out


def found(spark, rows, q):
    df = spark.createDataFrame(rows, "k string, x double")
    got = exact_quantile(df, ["k"], "x", q, "at").collect()
    assert len({r.k for r in got}) == len(got)
    return {r.k: r["at"] for r in got}


def same(a, b):
    return a.keys() == b.keys() and all(a[k] == b[k] or None not in (a[k], b[k]) and math.isnan(a[k]) and math.isnan(b[k]) for k in a)


@pytest.mark.parametrize("q", [0.0, 0.5, 0.8, 1.0])
def test_spreads_signs_and_odd_values(spark, q):
    rng = random.Random(1)
    rows = [("normal", rng.gauss(0, 1)) for _ in range(700)]
    rows += [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300)) for _ in range(500)]
    base = 1.0
    for _ in range(400):
        rows.append(("dense", base))
        base = math.nextafter(base, 2)
    rows += [("outlier", 1 + i * 2.0**-50) for i in range(300)] + [("outlier", 1e300)]
    rows += [("ties", float(i % 3)) for i in range(200)] + [(None, float(i)) for i in range(7)] + [("none", None), ("one", -0.0)]
    rows += [("odd", x) for x in (NAN, INF, -INF, 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, None, NAN)]
    assert same(found(spark, rows, q), direct(rows, q))


def test_cells_never_fall(spark):
    values = sorted([0.0, 5e-324, 1e-310, 2.0**-16, 1.0, math.nextafter(1, 0), math.nextafter(1, 2), 3.0, 1.7e308, INF] * 1)
    values = [-v for v in reversed(values)] + values + [NAN]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    cells = [r.c for r in df.select("i", octave_cell(F.col("x")).alias("c")).orderBy("i").collect()]
    assert cells == sorted(cells)


def test_a_group_with_nine_tenths_of_the_rows(spark):
    """All rounds read one shuffle of counted values, and what is ordered in the end are few of them."""
    big = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 9, "big").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("k"),
        F.round(F.pow(F.pmod(F.xxhash64("id"), F.lit(100_003)) / 100_003.0, 3), 7).alias("x"),
    )
    result = exact_quantile(big, ["k"], "x", 0.8, "at")
    got = {r.k: r["at"] for r in result.collect()}
    assert got == direct([(r.k, r.x) for r in big.collect()], 0.8)
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # One scan counts the values, one finds the groups without any.
    assert plan.count("ReusedExchange") >= 4 and plan.count(" Range (") == 2, plan


def test_an_empty_table(spark):
    assert found(spark, [], 0.5) == {}
