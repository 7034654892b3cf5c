import datetime as dt

import pytest
from pyspark.sql import functions as F

from covercast.functions import dates
from covercast.operators import calendar, capacity


def test_holidays_of_2024(spark):
    found = calendar.holidays(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31)).collect()
    got = {(r.check_date.month, r.check_date.day): r.holiday_name for r in found}
    assert got == {
        (1, 1): "New Year's Day", (2, 14): "Valentine's Day", (5, 12): "Mother's Day",
        (5, 27): "Memorial Day", (7, 4): "Independence Day", (9, 2): "Labor Day",
        (11, 28): "Thanksgiving", (12, 24): "Christmas Eve", (12, 25): "Christmas Day",
        (12, 31): "New Year's Eve",
    }


def test_spine_and_weekday_numbers(spark):
    spine = calendar.date_spine(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 3))
    assert [r.day_of_week for r in spine.orderBy("date").collect()] == [3, 4, 5, 6, 7]
    row = spark.sql("select date'2024-03-03' as d").select(
        F.dayofweek("d").alias("dow"), dates.week_start(F.col("d")).alias("week"),
        dates.week_start(F.date_sub("d", 1)).alias("before"),
    ).first()
    assert (row.dow, row.week, row.before) == (1, dt.date(2024, 3, 3), dt.date(2024, 2, 25))
    assert calendar.days_prior(spark, 365).count() == 366


def test_names_and_flags(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 3), 7), (dt.date(2024, 12, 4), 91)], "d date, p int")
    named = calendar.calendar_names(df.withColumns(dates.date_parts(F.col("d")))).orderBy("d").collect()
    assert [(r.day_of_week, r.month) for r in named] == [("sunday", "march"), ("wednesday", "december")]
    flags = calendar.calendar_flags(df, "d", "p").orderBy("d").collect()
    assert [(r.is_spring, r.is_winter, r.is_weekend, r.is_within_week, r.is_within_quarter) for r in flags] == [
        (1, 0, 1, 1, 1), (0, 1, 0, 0, 0),
    ]


TEMPLATE = (
    "int_id bigint, venue_key_id bigint, persistent_id string, name string, category string, "
    "effective_start_date date, effective_end_date date, day_of_week array<boolean>, "
    "excluded_dates array<date>, archived timestamp_ntz, deleted timestamp_ntz"
)
ALL_WEEK = [True] * 7


def template(int_id, start, end, mask=ALL_WEEK, excluded=None, archived=None, deleted=None):
    return (int_id, 1, "lunch", "Lunch", "A", start, end, mask, excluded, archived, deleted)


def test_calendar_respects_validity_mask_and_exclusions(spark):
    d = lambda n: dt.date(2024, 6, n)  # noqa: E731 - 2024-06-01 is a Saturday
    rows = [
        template(1, d(3), d(9)),
        template(2, d(3), None, [True, None, False]),
        template(3, d(3), d(9), ALL_WEEK, [d(4), None, d(30)]),
        template(4, d(3), d(9), archived=dt.datetime(2024, 1, 1)),
        template(5, d(3), d(9), deleted=dt.datetime(2024, 1, 1)),
        template(6, d(20), d(25)),
    ]
    days = calendar.shift_calendar(spark.createDataFrame(rows, TEMPLATE), d(5), d(16)).collect()
    got = {}
    for r in days:
        got.setdefault(r.int_id, []).append(r.date.day)
    assert got == {1: [5, 6, 7, 8, 9], 2: [10], 3: [5, 6, 7, 8, 9]}
    early = calendar.shift_calendar(spark.createDataFrame(rows, TEMPLATE), d(1), d(5)).collect()
    assert sorted(r.date.day for r in early if r.int_id == 3) == [3, 5]


def test_fill_days_lists_gaps(spark):
    daily = spark.createDataFrame(
        [(dt.date(2024, 6, 1), 5), (dt.date(2024, 6, 4), 2), (None, 9)], "date date, n bigint"
    )
    filled = calendar.fill_days(daily, "n").orderBy("date").collect()
    assert [(r.date.day, r.n) for r in filled] == [(1, 5), (2, 0), (3, 0), (4, 2)]


DENORM = (
    "int_id bigint, venue_key_id bigint, floorplan_int_id bigint, persistent_id string, "
    "interval_minutes int, deleted timestamp_ntz, name string, start_time timestamp_ntz, "
    "end_time timestamp_ntz, effective_start_date date, effective_end_date date, table_size int, "
    "turn_duration int, venue_start_of_day_time_min int, last_updated timestamp_ntz, "
    "custom_pacing_str string, covers_per_seating_interval int, shift_start_time_min int, "
    "shift_end_time_min int, duration_minutes_by_party_size_str string, duration_dict_ranges_str string"
)


def table(int_id, size, pacing="{}", per_interval=100):
    return (
        int_id, 1, None, "lunch", 60, None, "Lunch", dt.datetime(1900, 1, 1, 22), dt.datetime(1900, 1, 1, 1),
        None, None, size, None, None, None, pacing, per_interval, 660, 720, None, '{"11:00":{"2":60,"4":60}}',
    )


@pytest.fixture
def sources(spark):
    day = dt.date(2024, 6, 3)
    rows = [template(1, day, day), template(3, day, day)]
    override = [(day, 2, 1, "EVENT", None), (day, 2, 1, "EVENT", None)]
    return {
        "shift_default": spark.createDataFrame(rows, TEMPLATE),
        "shift_override": spark.createDataFrame(
            override, "date date, int_id bigint, venue_key_id bigint, category string, deleted timestamp_ntz"
        ),
        "shift_default_denorm": spark.createDataFrame([table(1, 2), table(1, 4), table(1, 4)], DENORM),
        "shift_override_denorm": spark.createDataFrame([table(2, 2, "{}", 3)], DENORM),
    }


def test_capacity_counts_tables_copies_and_caps(spark, sources):
    day = dt.date(2024, 6, 3)
    got = {
        r.int_id: (r.calculated_capacity, r.max_shift_capacity, r.util_capacity)
        for r in capacity.shift_capacity_per_day(sources, day, day).collect()
    }
    # two seatings per table (the end counts): 4 + 8 + 8; the doubled override counts twice
    assert got == {1: (20.0, 200.0, 20.0), 2: (8.0, 6.0, 6.0), 3: (None, None, None)}


def test_override_wins_drops_the_template(spark, sources):
    day = dt.date(2024, 6, 3)
    rows = capacity.shift_capacity_per_day(sources, day, day, override_wins=True)
    assert sorted(r.int_id for r in rows.filter("persistent_id is not null").collect()) == [2]


def test_shift_times_cross_midnight(spark, sources):
    day = dt.date(2024, 6, 3)
    dated = capacity.shift_capacity_per_day(sources, day, day, capacity.TIME_COLUMNS)
    row = capacity.shift_times(dated).filter("int_id = 1").first()
    assert row.normalized_start_time == dt.datetime(1970, 1, 1, 22)
    assert row.normalized_end_time == dt.datetime(1970, 1, 2, 1)
    assert (row.normalized_end_time_dom, row.normalized_end_time_minutes) == (2, 60)
    assert row.date_partition == dt.date(2024, 6, 2)
