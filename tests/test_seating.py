"""Hand-worked cases of the three seating expressions."""

import pytest
from pyspark.sql import functions as F

from covercast.functions.basic import capped
from covercast.functions.seating import pacing_at_minute, pacing_capacity, table_capacity

J1 = '{"11:00":{"2":90,"4":120},"17:00":{"2":105,"4":150}}'

TABLE_CASES = [
    (J1, 2, 660, 1320, 14.0),
    (J1, 4, 660, 1320, 24.0),
    (J1, 12, 660, 1320, 12.0),
    ('{"11:00":{"2":100},"17:00":{"2":105}}', 2, 660, 1320, 14.0),
    ('{"18:00":{"2":90}}', 2, 1080, 120, 12.0),
    ('{"18:00":{"2":0}}', 2, 1080, 1320, None),
    ('{"06:00":{"2":60},"11:00":{"2":60}}', 2, 720, 840, 6.0),
    (J1, None, 660, 1320, None),
    (None, 2, 660, 1320, None),
    ("{broken", 2, 660, 1320, None),
    ("null", 2, 660, 1320, None),
    ("{}", 2, 660, 1320, 0.0),
    ("[]", 2, 660, 1320, 0.0),
    (J1, 2, 100, 200, 0.0),
    ('{"11:00":{"2":null}}', 2, 660, 900, None),
    # the size is missing in the first range: one turn, then nothing more
    ('{"11:00":{"4":90},"17:00":{"2":105}}', 2, 660, 1320, 2.0),
    # ... but an unusable duration later still spoils the table
    ('{"11:00":{"4":90},"17:00":{"2":0}}', 2, 660, 1320, None),
    (J1, 2, None, 1320, 0.0),
    (J1, 2, 660, None, 0.0),
    ('{"11:00":{"2":0}}', 2, None, 1320, None),
    # document order, not clock order: "11:00" is the last range here
    ('{"17:00":{"2":100},"11:00":{"2":60}}', 2, 660, 1320, 8.0),
    # the last range includes its end, an inner range does not
    ('{"11:00":{"2":60}}', 2, 660, 720, 4.0),
    ('{"11:00":{"2":60},"12:00":{"2":60}}', 2, 660, 720, 2.0),
    ('{"11:00":null}', 2, 660, 900, None),
    ('{"11:00":5}', 2, 660, 900, 2.0),
]

PACING_CASES = [
    ('{"660":10,"675":null,"690":-1}', 8, 660, 705, 15, 26.0),
    ('{"660":10,"675":null,"690":-1}', None, 660, 705, 15, 10.0),
    ("{}", 8, 660, 705, 15, 32.0),
    (None, 8, 660, 705, 15, None),
    ("null", 8, 660, 705, 15, None),
    ("{broken", 8, 660, 705, 15, None),
    ('{"0":5,"1380":7}', 1, 1380, 30, 30, 14.0),
    ("[]", 8, 660, 705, 15, 32.0),
    ("{}", 8, 660, 705, None, 8.0),
    ("{}", 8, 660, 705, 0, None),
    ("{}", 8, 660, None, 15, 0.0),
    (None, 8, 660, None, 15, 0.0),
    ("{broken", 8, 660, None, 15, None),
    ("{}", 1, None, 30, 15, 3.0),
    ('{"660":2.5}', 0, 660, 660, 15, 2.5),
]

MINUTE_CASES = [
    ('{"660":12.7}', 660, 3, 12),
    ('{"660":-12.7}', 660, 3, -12),
    ('{"660":null}', 660, 3, 3),
    ('{"660":"7 covers"}', 660, 3, 7),
    ('{"660":"x"}', 660, 3, 3),
    ('{"660":1}', 675, 3, 3),
    ("", 660, 3, 3),
    (None, 660, 3, 3),
    ("{broken", 660, None, None),
    ('{"660":0}', 660, 3, 0),
]


def check(spark, cases, schema, expression):
    numbered = [(i, *case) for i, case in enumerate(cases)]
    rows = spark.createDataFrame(numbered, "i int, " + schema)
    got = {r["i"]: r["got"] for r in rows.select("i", expression.alias("got")).collect()}
    wrong = {cases[i]: got[i] for i in got if got[i] != cases[i][-1]}
    assert not wrong


def test_table_capacity(spark):
    check(
        spark, TABLE_CASES, "j string, size int, s int, e int, want double",
        table_capacity(F.col("j"), F.col("size"), F.col("s"), F.col("e")),
    )


def test_pacing_capacity(spark):
    check(
        spark, PACING_CASES, "j string, f int, s int, e int, step int, want double",
        pacing_capacity(F.col("j"), F.col("f"), F.col("s"), F.col("e"), F.col("step")),
    )


def test_pacing_at_minute(spark):
    check(
        spark, MINUTE_CASES, "j string, m int, d int, want bigint",
        pacing_at_minute(F.col("j"), F.col("m"), F.col("d")),
    )


def test_random_shifts_match_a_minute_by_minute_simulation(spark):
    """The closed form against seating party after party."""
    import json
    import random

    rng = random.Random(7)

    def simulate(ranges, size, start, end):
        end = end + 1440 if end < start else end
        cursor, guests = start, 0
        for i, (clock, minutes) in enumerate(ranges):
            last = i == len(ranges) - 1
            opens = int(clock[:2]) * 60 + int(clock[3:])
            closes = end if last else int(ranges[i + 1][0][:2]) * 60 + int(ranges[i + 1][0][3:])
            closes += 1440 if closes < opens else 0
            if start >= closes or end <= opens:
                continue
            at, stop = max(cursor, opens), min(end, closes)
            while at < stop or (last and at == stop):
                guests += size
                at += minutes
            cursor = max(cursor, at)
        return float(guests)

    cases = []
    for _ in range(400):
        clocks = rng.sample(range(0, 24 * 4), rng.randint(1, 4))
        if rng.random() < 0.8:
            clocks.sort()
        ranges = [(f"{c // 4:02d}:{c % 4 * 15:02d}", rng.randint(20, 200)) for c in clocks]
        start, end = rng.randrange(0, 1440, 15), rng.randrange(0, 1440, 15)
        text = json.dumps({clock: {"2": minutes} for clock, minutes in ranges})
        cases.append((text, 2, start, end, simulate(ranges, 2, start, end)))
    check(
        spark, cases, "j string, size int, s int, e int, want double",
        table_capacity(F.col("j"), F.col("size"), F.col("s"), F.col("e")),
    )


@pytest.mark.parametrize(
    "limit, value, want", [(5.0, 9.0, 5.0), (9.0, 5.0, 5.0), (None, 5.0, 5.0), (5.0, None, None)]
)
def test_capped_is_not_least(spark, limit, value, want):
    row = spark.createDataFrame([(limit, value)], "l double, v double")
    assert row.select(capped(F.col("l"), F.col("v"))).first()[0] == want
