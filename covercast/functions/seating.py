"""Seating-capacity expressions over the JSON settings of a shift.

All three are plain column expressions: JSON is parsed to maps, the loop over
time ranges is an array fold, and the number of turns of a table in one range
has a closed form. Quoted numbers in the JSON count as numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covercast.functions.basic import is_true, leading_int, let
from covercast.keys import MINUTES_PER_DAY

_TEXT_MAP = "map<string,string>"

# Fixed value: parties above this size use the turn time of this size.
LARGEST_LISTED_PARTY = 9


def _after(start: Column, end: Column) -> Column:
    """``end`` moved to the next day when it lies before ``start``."""
    return F.when(end < start, end + MINUTES_PER_DAY).otherwise(end)


def _clock_minutes(text: Column) -> Column:
    """Minutes after midnight of "HH:MM"; null when a part is not a number."""
    parts = F.split(text, ":")
    return leading_int(F.get(parts, F.lit(0))) * 60 + leading_int(F.get(parts, F.lit(1)))


def table_capacity(durations: Column, table_size: Column, start_min: Column, end_min: Column) -> Column:
    """Guests one table can seat over a shift.

    ``durations`` is ``{"HH:MM": {"party size": minutes}}``. Each key opens a
    range that lasts until the next key *in document order*; the last range ends
    with the shift, end included. Null when the settings are unusable.
    """
    start = start_min.cast("double")
    end = _after(start, end_min.cast("double"))
    party = F.least(table_size, F.lit(LARGEST_LISTED_PARTY)).cast("string")

    def describe(entries: Column):
        def one(entry: Column, i: Column) -> Column:
            opens = _clock_minutes(entry["key"]).cast("double")
            last = i == F.size(entries) - 1
            following = _clock_minutes(F.get(entries, i + 1)["key"]).cast("double")
            return F.struct(
                opens.alias("opens"),
                _after(opens, F.when(last, end).otherwise(following)).alias("closes"),
                last.alias("last"),
                entry["value"].isNull().alias("empty"),
                F.from_json(entry["value"], _TEXT_MAP).alias("minutes"),
            )

        return F.transform(entries, one)

    def seat(state: Column, r: Column) -> Column:
        reached = ~is_true(start >= r["closes"]) & ~is_true(end <= r["opens"])
        listed = is_true(F.map_contains_key(r["minutes"], party))
        text = F.try_element_at(r["minutes"], party)
        number = text.try_cast("double")
        unusable = r["empty"] | (listed & (text.isNull() | is_true(number < 1)))
        turn = F.when(number >= 1, number)

        # A null position means "unknown from here on": nothing more is seated.
        cursor = state["cursor"]
        first = F.when(cursor.isNotNull() & r["opens"].isNotNull(), F.greatest(cursor, r["opens"]))
        stop = F.when(r["closes"].isNotNull() & end.isNotNull(), F.least(end, r["closes"]))
        seats_any = is_true(F.when(r["last"], first <= stop).otherwise(first < stop))
        span = (stop - first) / turn
        turns = (
            F.when(~seats_any, F.lit(0.0))
            .when(turn.isNull(), F.lit(1.0))
            .when(r["last"], F.floor(span).cast("double") + 1)
            .otherwise(F.ceil(span).cast("double"))
        )
        after = F.when(~seats_any, first).otherwise(first + turns * turn)
        moved = F.when(cursor.isNotNull() & after.isNotNull(), F.greatest(cursor, after))
        return F.struct(
            F.when(reached, moved).otherwise(cursor).alias("cursor"),
            (state["guests"] + F.when(reached, turns * table_size).otherwise(F.lit(0.0))).alias("guests"),
            (state["failed"] | (reached & unusable)).alias("failed"),
        )

    begin = F.struct(
        start.alias("cursor"), F.lit(0.0).alias("guests"), F.lit(False).alias("failed")
    )
    ranges = F.map_entries(F.from_json(durations, _TEXT_MAP))
    guests = F.aggregate(
        let(ranges, describe),
        begin,
        seat,
        lambda state: F.when(~state["failed"], state["guests"]),
    )
    parsed = F.try_parse_json(durations)
    return F.when(
        table_size.isNotNull() & parsed.isNotNull() & ~F.is_variant_null(parsed),
        F.when(F.json_object_keys(durations).isNull(), F.lit(0.0)).otherwise(guests),
    )


def pacing_capacity(
    pacing: Column, fallback: Column, start_min: Column, end_min: Column, interval: Column
) -> Column:
    """Most guests the pacing rules admit over a shift, both ends included.

    ``pacing`` is ``{"minute of day": guests}``. A listed null adds nothing; an
    absent or negative entry adds ``fallback``. Null without readable pacing.
    """
    start = F.coalesce(start_min, F.lit(0)).cast("int")
    end = _after(start, end_min.cast("int"))
    minutes = (
        F.when(end.isNull(), F.array().cast("array<int>"))
        .when(interval.isNull(), F.array(start))
        .when(interval > 0, F.sequence(start, end, interval.cast("int")))
    )

    def total(rules: Column) -> Column:
        def add(acc: Column, minute: Column) -> Column:
            key = (minute % MINUTES_PER_DAY).cast("string")
            text = F.try_element_at(rules, key)
            guests = text.try_cast("double")
            return acc + (
                F.when(F.map_contains_key(rules, key) & text.isNull(), F.lit(0.0))
                .when(guests >= 0, guests)
                .otherwise(F.coalesce(fallback, F.lit(0)).cast("double"))
            )

        return F.aggregate(minutes, F.lit(0.0), add)

    parsed = F.try_parse_json(pacing)
    rules = F.coalesce(F.from_json(pacing, _TEXT_MAP), F.from_json(F.lit("{}"), _TEXT_MAP))
    without_rules = pacing.isNull() | is_true(F.is_variant_null(parsed))
    return (
        F.when(without_rules & end.isNull(), F.lit(0.0))
        .when(without_rules | parsed.isNull(), F.lit(None).cast("double"))
        .otherwise(let(rules, total))
    )


def pacing_rules(pacing: Column) -> Column:
    """The pacing document as a map; null when it is not a readable object."""
    return F.when(F.try_parse_json(pacing).isNotNull(), F.from_json(pacing, _TEXT_MAP))


def listed_guests(rules: Column, minute: Column) -> Column:
    """Whole guests a parsed pacing map lists for a minute, toward zero."""
    text = F.try_element_at(rules, minute.cast("string"))
    return F.coalesce(text.try_cast("double").try_cast("bigint"), leading_int(text).cast("bigint"))


def pacing_at_minute(pacing: Column, minute: Column, default: Column | None = None) -> Column:
    """Whole guests listed for one minute of the day, else ``default``.

    Negative entries are returned as they are.
    """
    whole = listed_guests(pacing_rules(pacing), minute)
    return whole if default is None else F.coalesce(whole, default.cast("bigint"))
