"""Filters and aggregates over reservations.

Every grouping is a plain hash aggregate, so a venue or a sitting that holds
much of the data is reduced on the map side before anything is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covercast.functions.basic import day, moment
from covercast.keys import INSTANCE
from covercast.operators.intervals import interval_join
from covercast.sources.layout import in_months

# Fixed value: the status of a withdrawn reservation.
DEAD_STATUS = ("CANCELED",)


def active_reservations(
    reservations: DataFrame,
    venues: Iterable[int] | None = None,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    dead_status: tuple[str, ...] = DEAD_STATUS,
) -> DataFrame:
    """Reservations that were not withdrawn (an unknown status does not count),
    optionally for some venues and a closed window of service times."""
    kept = reservations.filter(~F.col("status").isin(*dead_status))
    if venues is not None:
        kept = kept.filter(F.col("venue_key_id").isin(list(venues)))
    if start is not None:
        kept = kept.filter(F.col("marked_time") >= moment(start))
    if end is not None:
        kept = kept.filter(F.col("marked_time") <= moment(end))
    return in_months(kept, "marked_time", start, end)


def _service_day() -> Column:
    return F.to_date("marked_time")


def _creation_day() -> Column:
    return F.to_date("created")


def _lead_days() -> Column:
    return F.datediff(_service_day(), _creation_day())


def _instance(service_day: Column) -> list[Column]:
    return [
        F.col("venue_key_id"),
        F.col("shift_persistent_id").alias("persistent_id"),
        service_day.alias("shift_date"),
    ]


def _of_days(df: DataFrame, start: dt.date | None, before: dt.date | None) -> DataFrame:
    """Rows with a service time from ``start`` on and before ``before``."""
    kept = df.filter(F.col("marked_time").isNotNull())
    if start is not None:
        kept = kept.filter(F.col("marked_time") >= moment(start))
    if before is not None:
        kept = kept.filter(F.col("marked_time") < moment(before))
    return in_months(kept, "marked_time", start, before)


def actual_covers(
    reservations: DataFrame, start: dt.date | None = None, before: dt.date | None = None
) -> DataFrame:
    """Guests, bookings and mean party size of every sitting."""
    return (
        _of_days(active_reservations(reservations), start, before)
        .groupBy(*_instance(_service_day()))
        .agg(
            F.sum("max_guests").alias("final_actual_covers"),
            F.count(F.lit(1)).alias("total_reservations"),
            F.avg("max_guests").alias("avg_party_size"),
        )
    )


def bucket_name(days: int) -> str:
    return f"covers_booked_{days}_{'day' if days == 1 else 'days'}_prior"


def lead_time_buckets(
    reservations: DataFrame,
    days: Iterable[int] = (30, 14, 7, 3, 1),
    start: dt.date | None = None,
    before: dt.date | None = None,
) -> DataFrame:
    """Final guests of every sitting, and those booked at least n days ahead."""
    return (
        _of_days(active_reservations(reservations), start, before)
        .filter(F.col("created").isNotNull())
        .groupBy(*_instance(_service_day()))
        .agg(
            F.sum("max_guests").alias("final_actual_covers"),
            *[
                F.sum(F.when(_lead_days() >= n, F.col("max_guests")).otherwise(0)).alias(bucket_name(n))
                for n in days
            ],
        )
    )


def bookings_by_creation_day(
    reservations: DataFrame,
    start: dt.date | None = None,
    before: dt.date | None = None,
    undated: bool = False,
) -> DataFrame:
    """Guests and bookings of every sitting by the day they were booked.

    ``start`` (inclusive) and ``before`` (exclusive) bound the service day.
    ``undated`` keeps reservations without creation time, under a null day.
    """
    kept = _of_days(active_reservations(reservations), start, before)
    if not undated:
        kept = kept.filter(F.col("created").isNotNull())
    return kept.groupBy(*_instance(_service_day()), _creation_day().alias("creation_day")).agg(
        F.sum("max_guests").alias("covers_created_on_day"),
        F.count(F.lit(1)).alias("reservations_created_on_day"),
        F.avg("max_guests").alias("avg_party_size_created_on_day"),
        F.avg(_lead_days()).alias("avg_lead_time_for_day"),
    )


def current_bookings(
    reservations: DataFrame, now: dt.datetime | None = None, day_col: str = "date"
) -> DataFrame:
    """Bookings known at ``now`` for every sitting, by the booked service date
    (``day_col="marked_time"`` uses the date of the service time instead)."""
    kept = active_reservations(reservations)
    if now is not None:
        kept = kept.filter(F.col("created") <= moment(now))
    return kept.groupBy(*_instance(F.to_date(day_col))).agg(
        F.sum("max_guests").alias("current_total_covers"),
        F.count(F.lit(1)).alias("total_reservations"),
        F.avg("max_guests").alias("avg_party_size"),
        F.min("created").alias("first_booking_timestamp"),
        F.max("created").alias("latest_booking_timestamp"),
    )


def booking_timing(bookings: DataFrame, as_of: dt.date) -> DataFrame:
    """Days from the first booking to the service day, and since the last one."""
    return bookings.withColumns(
        {
            "days_since_first_booking": F.datediff("shift_date", F.to_date("first_booking_timestamp")),
            "days_since_latest_booking": F.datediff(day(as_of), F.to_date("latest_booking_timestamp")),
        }
    )


def booking_velocity(bookings: DataFrame, days: Iterable[int] = (7, 14, 30, 60)) -> DataFrame:
    """Mean guests per booking day close to the sitting, by weekday and month.

    Booking days further out than n days count as 0 in the mean.
    """
    lead = F.datediff("shift_date", "creation_day")
    return bookings.groupBy(
        "venue_key_id",
        "persistent_id",
        F.dayofweek("shift_date").alias("day_of_week"),
        F.month("shift_date").alias("month"),
    ).agg(
        *[
            F.avg(F.when(lead <= n, F.col("covers_created_on_day")).otherwise(0)).alias(
                f"avg_covers_{n}_days_out"
            )
            for n in days
        ]
    )


def booking_patterns(
    reservations: DataFrame, as_of: dt.date, years: int = 2, days: Iterable[int] = (30, 60, 90)
) -> DataFrame:
    """Mean guests per past reservation booked within n days, and mean lead time."""
    lead = F.datediff("date", _creation_day())
    # Some days more, where the month of the first one is shorter.
    first = as_of.replace(year=as_of.year - years, day=1)
    return (
        in_months(active_reservations(reservations), "date", first, as_of)
        .filter(
            F.col("created").isNotNull()
            & (F.col("date") >= F.add_months(day(as_of), -12 * years))
            & (F.col("date") < day(as_of))
        )
        .groupBy(
            "venue_key_id",
            F.col("shift_persistent_id").alias("persistent_id"),
            F.dayofweek("date").alias("day_of_week"),
            F.month("date").alias("month"),
        )
        .agg(
            *[
                F.avg(F.when(lead <= n, F.col("max_guests")).otherwise(0)).alias(
                    f"avg_covers_last_{n}_days"
                )
                for n in days
            ],
            F.avg(lead).alias("avg_lead_time_days"),
        )
    )


def attach_history(df: DataFrame, history: DataFrame, day_col: str = "shift_date") -> DataFrame:
    """Left join history by venue, shift, weekday and month of ``day_col``."""
    keys = ["venue_key_id", "persistent_id", "day_of_week", "month"]
    dated = df.withColumns(
        {"day_of_week": F.dayofweek(day_col), "month": F.month(day_col)}
    )
    return dated.join(history, keys, "left")


def attach_bookings(capacity: DataFrame, bookings: DataFrame) -> DataFrame:
    """Left join bookings onto sittings."""
    return capacity.join(bookings, INSTANCE, "left")


def open_hours(timed: DataFrame) -> DataFrame:
    """``capacity.shift_times`` with the moments a sitting ``opens`` and ``closes``, the latter maybe on the next day."""
    midnight = F.col("date").cast("timestamp_ntz")
    base = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return timed.withColumns(
        {
            "opens": midnight + (F.col("normalized_start_time") - base),
            "closes": midnight + (F.col("normalized_end_time") - base),
        }
    )


def arrivals_while_open(sittings: DataFrame, reservations: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Sittings with the guests and reservations of their venue that are due while they are open, 0 where none.

    keys: columns that tell the sittings apart, ``venue_key_id`` among them. Sittings may overlap and be of any length. Reservations
    are counted per venue and moment before they meet the sittings.
    """
    keys = list(keys)
    due = active_reservations(reservations).filter(F.col("marked_time").isNotNull()).groupBy("venue_key_id", "marked_time")
    due = due.agg(F.sum(F.coalesce("max_guests", F.lit(0))).alias("guests"), F.count(F.lit(1)).alias("parties"))
    met = interval_join(sittings.select(*keys, "opens", "closes"), due, ["venue_key_id"], "opens", "closes", "marked_time")
    counted = met.groupBy(*keys).agg(F.sum("guests").alias("guests"), F.sum("parties").alias("parties"))
    return sittings.join(counted, keys, "left").na.fill(0, ["guests", "parties"])
