"""Snapshot operators against the naive inequality join, on random bookings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from covercast.keys import INSTANCE
from covercast.operators import asof, bookings, labels

DAY = dt.date(2024, 6, 1)


def booking_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "venue_key_id bigint, persistent_id string, shift_date date, creation_day date, "
        "covers_created_on_day bigint, reservations_created_on_day bigint",
    )


def sitting_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "venue_key_id bigint, persistent_id string, shift_date date, int_id bigint, "
        "util_capacity double, shift_category string",
    )


@pytest.fixture(scope="module")
def random_data():
    """40 sittings, some without bookings, one with most of them, some doubled."""
    rng = random.Random(11)
    sittings, booked = [], {}
    for i in range(40):
        key = (i % 3, "lunch" if i % 2 else "dinner", DAY + dt.timedelta(days=i))
        for copy in range(2 if i % 7 == 0 else 1):
            sittings.append((*key, 100 + copy, 40.0 + i, "A"))
        many = 300 if i == 5 else rng.choice([0, 1, 4, 9])
        for _ in range(many):
            lead = rng.choice([0, 1, 2, 7, 8, 30, 364, 365, 366, 400, -2, rng.randint(0, 500)])
            made = key[2] - dt.timedelta(days=lead)
            covers, count = booked.get((*key, made), (0, 0))
            booked[(*key, made)] = (covers + rng.randint(1, 9), count + 1)
    return sittings, [(*k, c, n) for k, (c, n) in booked.items()]


def collected(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def of_sitting(booked, key):
    return [(b[3], b[4], b[5]) for b in booked if b[:3] == key]


def test_asof_covers_equals_naive_join(spark, random_data):
    sittings, booked = random_data
    got = asof.asof_covers(sitting_rows(spark, sittings), booking_rows(spark, booked))
    want = []
    for s in sittings:
        mine = of_sitting(booked, s[:3])
        for d in range(366):
            snapshot = s[2] - dt.timedelta(days=d)
            want.append((*s[:4], d, snapshot, sum(c for made, c, _ in mine if made <= snapshot)))
    assert collected(got, *INSTANCE, "int_id", "day_prior", "snapshot_timestamp", "covers_as_of_date") == sorted(want)


def test_recent_pace_equals_naive_join(spark, random_data):
    sittings, booked = random_data
    got = asof.recent_pace(sitting_rows(spark, sittings), booking_rows(spark, booked), days=7)
    want = []
    for s in sittings:
        mine = of_sitting(booked, s[:3])
        for d in range(366):
            snapshot = s[2] - dt.timedelta(days=d)
            since = snapshot - dt.timedelta(days=7)
            want.append((*s[:4], d, sum(c for made, c, _ in mine if since <= made <= snapshot)))
    assert collected(got, *INSTANCE, "int_id", "day_prior", "covers_recent") == sorted(want)


def test_running_snapshots_equal_range_window_over_naive_join(spark, random_data):
    sittings, booked = random_data
    df = sitting_rows(spark, sittings)
    joined = asof.attach_curve(
        asof.with_copies(df), asof.booking_curve(booking_rows(spark, booked), running=True)
    )
    got = asof.running_snapshots(joined)
    want = []
    for s in sittings:
        copies = sum(1 for x in sittings if x[:3] == s[:3])
        mine, total = of_sitting(booked, s[:3]), 0
        for d in range(365, -1, -1):
            snapshot = s[2] - dt.timedelta(days=d)
            seen = [c for made, c, _ in mine if made <= snapshot]
            total += copies * sum(seen)
            want += [(*s[:4], d, total)] * max(1, len(seen))
    assert collected(got, *INSTANCE, "int_id", "day_prior", "covers_as_of_date") == sorted(want)


def test_small_example_of_plain_and_running_totals(spark):
    """Bookings of 4, 2 and 5 guests made 10, 3 and 0 days ahead."""
    key = (1, "lunch", DAY)
    booked = booking_rows(
        spark, [(*key, DAY - dt.timedelta(days=n), c, 1) for n, c in [(10, 4), (3, 2), (0, 5)]]
    )
    sittings = sitting_rows(spark, [(*key, 1, 10.0, "A")])
    plain = asof.asof_covers(sittings, booked).filter("day_prior in (10, 3, 0)")
    assert collected(plain, "day_prior", "covers_as_of_date") == [(0, 11), (3, 6), (10, 4)]
    visible = asof.visible_bookings(
        sittings.join(asof.gathered_bookings(booked), INSTANCE, "left"),
        F.array(F.lit(0), F.lit(3), F.lit(10)),
    )
    summed = asof.running_features(visible)
    # one row per visible booking day: 1, 2 and 3 rows
    assert collected(summed, "day_prior", "covers_as_of_date") == [
        (0, 14), (0, 16), (0, 21), (3, 8), (3, 10), (10, 4),
    ]


def test_covers_never_fall_as_the_day_comes_closer(spark, random_data):
    sittings, booked = random_data
    pdf = asof.asof_covers(sitting_rows(spark, sittings), booking_rows(spark, booked)).toPandas()
    for _, one in pdf.groupby([*INSTANCE, "int_id"]):
        ordered = one.sort_values("day_prior", ascending=False)["covers_as_of_date"]
        assert ordered.is_monotonic_increasing


def test_scaffold_sizes(spark):
    one = sitting_rows(spark, [(1, "lunch", DAY, 1, 10.0, "A")])
    assert asof.snapshot_scaffold(one).count() == 366
    assert asof.snapshot_scaffold(one, asof.horizon_days()).count() == 182
    assert asof.horizon_filter(asof.snapshot_scaffold(one)).count() == 182


def test_party_size_and_utilization_guards(spark):
    df = spark.createDataFrame(
        [(6, 2, 12.0), (0, 0, 0.0)],
        "covers_as_of_date bigint, reservations_as_of_date bigint, util_capacity double",
    )
    rows = asof.utilization_asof(asof.party_size_asof(df)).collect()
    assert [(r.avg_party_size_as_of_date, r.utilization_as_of_date) for r in rows] == [(3.0, 0.5), (0.0, 0.0)]


def test_running_sum_frames(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 4)], "k string, o int, v int")
    by_rows = asof.running_sum(df, ["k"], ["o", "v"], {"s": "v"})
    by_range = asof.running_sum(df, ["k"], ["o"], {"s": "v"}, "range")
    assert collected(by_rows, "v", "s") == [(1, 1), (2, 3), (4, 7)]
    assert collected(by_range, "v", "s") == [(1, 3), (2, 3), (4, 7)]


RES = "venue_key_id bigint, shift_persistent_id string, marked_time timestamp_ntz, date date, created timestamp_ntz, status string, max_guests int"


def test_unknown_status_is_not_active(spark):
    at = dt.datetime(2024, 6, 1, 19)
    rows = [(1, "dinner", at, at.date(), at, status, 2) for status in ("COMPLETE", "CANCELED", None)]
    assert bookings.active_reservations(spark.createDataFrame(rows, RES)).count() == 1


def test_lead_time_bucket_edges(spark):
    at = dt.datetime(2024, 6, 1, 19)
    rows = [
        (1, "dinner", at, at.date(), at - dt.timedelta(days=n), "COMPLETE", 1) for n in (0, 1, 3, 7, 14, 30, 31)
    ]
    row = bookings.lead_time_buckets(spark.createDataFrame(rows, RES)).first()
    assert row.final_actual_covers == 7
    assert [row[bookings.bucket_name(n)] for n in (30, 14, 7, 3, 1)] == [2, 3, 4, 5, 6]
    assert bookings.bucket_name(1) == "covers_booked_1_day_prior"


def test_quantile_label_ignores_unbooked_and_includes_the_threshold(spark):
    rows = [(1, "s", DAY + dt.timedelta(days=7 * i), 10.0, i, DAY.isoweekday() % 7 + 1) for i in range(1, 11)]
    rows.append((1, "s", DAY, 10.0, None, DAY.isoweekday() % 7 + 1))
    df = spark.createDataFrame(
        rows,
        "venue_key_id bigint, persistent_id string, shift_date date, util_capacity double, "
        "final_actual_covers bigint, day_of_week int",
    )
    assert labels.weekday_threshold(df).first().hot_threshold == 0.8
    labelled = labels.label_by_quantile(df)
    hot = sorted(r.final_actual_covers for r in labelled.filter("is_hot = 1").collect())
    assert hot == [8, 9, 10]
    assert labelled.count() == 11


def test_threshold_is_the_exact_order_statistic(spark):
    """Also for a venue with a third of several thousand sittings."""
    rng = random.Random(5)
    rows = [
        (0 if i % 3 == 0 else rng.randint(1, 9), "s", DAY, 97.0, rng.randint(0, 100000), 1 + rng.randrange(2))
        for i in range(9000)
    ]
    df = spark.createDataFrame(
        rows,
        "venue_key_id bigint, persistent_id string, shift_date date, util_capacity double, "
        "final_actual_covers bigint, day_of_week int",
    )
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[5]), []).append(r[4] / 97.0)
    for got in labels.weekday_threshold(df.repartition(16)).collect():
        values = sorted(groups[(got.venue_key_id, got.day_of_week)])
        assert got.hot_threshold == values[-(-len(values) * 4 // 5) - 1]


def test_history_and_backtest_windows(spark):
    as_of = dt.date(2024, 3, 31)
    days = [(as_of - dt.timedelta(days=n),) for n in (0, 1, 90, 91, 800)]
    df = spark.createDataFrame(days, "shift_date date")
    assert labels.history_window(df, as_of).count() == 4
    assert labels.history_window(df, as_of, years=2).count() == 3
    assert labels.backtest_window(df, as_of).count() == 2


def test_running_visible_needs_no_window_over_the_expanded_rows(spark):
    """Equal to the windows over the expanded rows: several capacity rows, unknown guests, late and old bookings, none at all."""
    day = dt.date(2024, 3, 1)
    leads = [(0, 2), (0, 2), (3, None), (7, 4), (8, 1), (15, 5), (180, 3), (200, 6), (365, 7), (400, 8), (-2, 9)]
    booked = spark.createDataFrame(
        [(1, "dinner", day, day - dt.timedelta(days=lead), n, n and n + 1) for lead, n in set(leads)]
        + [(2, "dinner", day, day - dt.timedelta(days=5), 3, 1), (2, "dinner", day, None, 4, 1)],
        "venue_key_id bigint, persistent_id string, shift_date date, creation_day date, covers_created_on_day bigint, "
        "reservations_created_on_day bigint",
    )
    rows = [(v, "dinner", day, i, c, 10.0 * i) for v in (1, 2, 3, None) for i, c in ((1, None), (1, "a"), (2, "b"))][:-1]
    sittings = spark.createDataFrame(
        rows, "venue_key_id bigint, persistent_id string, shift_date date, int_id bigint, shift_category string, util_capacity double"
    )
    keys = ["venue_key_id", "persistent_id", "shift_date"]
    gathered = asof.gathered_bookings(booked)
    listed = sittings.groupBy(*keys).agg(
        F.collect_list(F.struct("int_id", "shift_category", "util_capacity")).alias("definitions")
    )
    found = asof.running_visible(listed.join(gathered, keys, "full"), asof.horizon_list())
    plain = asof.running_features(asof.visible_bookings(sittings.join(gathered, keys, "left"), asof.horizon_days()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    assert found.select(plain.columns).exceptAll(plain).count() == 0
    assert plain.exceptAll(found.select(plain.columns)).count() == 0
    assert found.count() == plain.count() > 182 * 11
