"""Training tables: past sittings with features and a label."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covercast.functions import dates
from covercast.functions.basic import day, safe_ratio
from covercast.keys import INSTANCE
from covercast.operators import asof, bookings, calendar, capacity, labels, lookups, slots


def years_before(as_of: dt.date, years: int) -> dt.date:
    """The same calendar day some years earlier (28 February for a leap day)."""
    try:
        return as_of.replace(year=as_of.year - years)
    except ValueError:
        return as_of.replace(year=as_of.year - years, day=28)


def past_capacity(
    sources: dict[str, DataFrame], as_of: dt.date, start: dt.date, extra=(), **options
) -> DataFrame:
    """Sittings from ``start`` up to the day before ``as_of``."""
    end = as_of - dt.timedelta(days=1)
    found = capacity.shift_capacity_per_day(sources, start, end, extra, **options)
    return found.withColumnRenamed("date", "shift_date")


def labelled_sittings(
    sources: dict[str, DataFrame], as_of: dt.date, years: int = 12, threshold: float = 0.85
) -> DataFrame:
    """Past sittings with their outcome and ratio label."""
    start = years_before(as_of, years)
    actual = bookings.actual_covers(sources["reservation"], start, as_of)
    return labels.label_by_ratio(past_capacity(sources, as_of, start), actual, threshold)


def training_shift_final(
    sources: dict[str, DataFrame], as_of: dt.date, years: int = 12, threshold: float = 0.6
) -> DataFrame:
    """One row per past sitting: final guests, guests booked ahead, label."""
    start = years_before(as_of, years)
    sittings = past_capacity(sources, as_of, start, capacity.TIME_COLUMNS).filter(
        F.col("util_capacity").isNotNull()
    )
    buckets = bookings.lead_time_buckets(sources["reservation"], start=start, before=as_of)
    counts = [c for c in buckets.columns if c not in INSTANCE]
    labelled = labels.label_by_ratio(sittings, buckets, threshold)
    return lookups.venue_lookup(labelled, sources["venue"]).select(
        F.col("shift_date").alias("date"),
        "venue_key_id",
        "venue_name",
        F.col("name").alias("shift_name"),
        F.col("persistent_id").alias("shift_persistent_id"),
        "util_capacity",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        "is_hot",
    )


def training_shift_running(
    sources: dict[str, DataFrame], as_of: dt.date, years: int = 12, threshold: float = 0.85
) -> DataFrame:
    """366 snapshots per past sitting with the running total over snapshots.

    The running total adds up what every earlier snapshot showed and repeats a
    snapshot once per visible booking day; ``asof.asof_covers`` gives the plain
    guests-so-far instead. Label and snapshots come from one scan.
    """
    start = years_before(as_of, years)
    sittings = capacity.with_capacity(past_capacity(sources, as_of, start)).select(
        *INSTANCE, "util_capacity", "shift_category"
    )
    booked = bookings.bookings_by_creation_day(
        sources["reservation"], start=start, before=as_of, undated=True
    )
    joined = asof.attach_curve(
        asof.with_copies(sittings), asof.booking_curve(booked, running=True)
    ).withColumn("is_hot", labels.hot_by_ratio(threshold))
    return asof.running_snapshots(joined).select(
        "shift_date",
        "venue_key_id",
        "persistent_id",
        "snapshot_timestamp",
        "shift_category",
        "day_prior",
        "util_capacity",
        *_parts("shift_date"),
        "covers_as_of_date",
        "is_hot",
    )


def _parts(day_col: str) -> list:
    return [column.alias(name) for name, column in dates.date_parts(F.col(day_col)).items()]


def quantile_outcomes(sources: dict[str, DataFrame], as_of: dt.date, years: int = 12) -> DataFrame:
    """Outcomes of past sittings by bookings with a known creation time."""
    start = years_before(as_of, years)
    actual = bookings.bookings_by_creation_day(
        sources["reservation"], start=start, before=as_of
    ).groupBy(*INSTANCE).agg(F.sum("covers_created_on_day").alias("final_actual_covers"))
    sittings = past_capacity(sources, as_of, start, capacity.TIME_COLUMNS)
    return labels.final_outcomes(sittings, actual)


def training_shift_asof(
    sources: dict[str, DataFrame], as_of: dt.date, years: int = 12, q: float = 0.8, last_day: int = 364
) -> DataFrame:
    """365 snapshots per past sitting with guests so far, holiday flag, and the
    weekday-quantile label."""
    start = years_before(as_of, years)
    sittings = labels.merged_sittings(
        capacity.with_capacity(past_capacity(sources, as_of, start, capacity.TIME_COLUMNS))
    )
    booked = bookings.bookings_by_creation_day(sources["reservation"], start=start, before=as_of)
    curve = asof.booking_curve(booked, last_day)

    def outcomes(rows: DataFrame) -> DataFrame:
        return labels.count_copies(asof.attach_curve(rows, curve))

    thresholds = labels.weekday_threshold(asof.one_per_sitting(outcomes(sittings)), q)
    # Names join the sittings while these are few: before steps and snapshots.
    named = lookups.shift_name_lookup(
        lookups.venue_lookup(calendar.holiday_flag(sittings, "shift_date"), sources["venue"]),
        sources["shift_default"],
    )
    labelled = labels.label_by_threshold(outcomes(named), thresholds)
    return asof.expand_steps(labelled, ["visible"], last_day).select(
        F.col("shift_date").alias("reservation_date"),
        "venue_key_id",
        "venue_name",
        "shift_name",
        F.col("persistent_id").alias("shift_persistent_id"),
        *_parts("shift_date"),
        "util_capacity",
        "day_prior",
        F.col("visible").alias("cumulative_covers_as_of_snapshot"),
        F.coalesce("final_actual_covers", F.lit(0)).alias("final_actual_covers"),
        "is_holiday",
        "is_hot",
    )


def slot_table(slot_rows: DataFrame, covers: DataFrame) -> DataFrame:
    """Slots with the guests that fall into them."""
    return capacity.with_capacity(slots.attach_slot_covers(slot_rows, covers)).select(
        "shift_date",
        "venue_key_id",
        "persistent_id",
        "int_id",
        "shift_category",
        "util_capacity",
        "interval_minutes",
        "slot_index",
        "slot_start_time_min",
        "slot_start_timestamp",
        "slot_capacity",
        *_parts("shift_date"),
        F.coalesce("covers_in_slot", F.lit(0)).alias("covers_as_of_date"),
    )


def training_slot(
    sources: dict[str, DataFrame],
    as_of: dt.date,
    now: dt.datetime,
    days: int = 400,
    reservation_days: int = 1095,
    threshold: float = 0.85,
    match_shift: bool = False,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    **options,
) -> DataFrame:
    """Slots of past sittings with their final guests and label.

    ``day_prior`` is 0 and the guests are the final ones, so the label follows
    from two of the features: fit for description, not for honest training.
    ``keep`` (as ``shared.stored_over_cores``) holds the sittings, which slots and guests both read, and the guests: their size then
    decides on the join with the slots before the slots are moved.
    """
    sittings = past_capacity(
        sources, as_of, as_of - dt.timedelta(days=days), capacity.SLOT_COLUMNS, **options
    )
    if keep:
        sittings = keep(capacity.with_capacity(sittings), "sittings")
    arrived = bookings.active_reservations(
        sources["reservation"], start=now - dt.timedelta(days=reservation_days), end=now
    )
    covers = slots.slot_covers(sittings, arrived, match_shift)
    if keep:
        covers = keep(covers, "covers")
    table = slot_table(slots.slot_capacity(sittings), covers)
    return table.withColumn("day_prior", F.lit(0)).withColumn(
        "is_hot", labels.hot_by_ratio(threshold, "covers_as_of_date", "slot_capacity")
    )


def training_shift_rich(
    sources: dict[str, DataFrame],
    as_of: dt.date,
    years: int = 2,
    threshold: float = 0.85,
    history_end: dt.date | None = None,
) -> DataFrame:
    """Snapshots 0..180 and 365 of past sittings with the full feature set.

    History features use every booking of the window, later ones included,
    unless ``history_end`` closes it.

    One scan and one aggregation of the reservations feed label, history and
    snapshots. The rows are placed by venue, shift, weekday and month for the
    history means (a group holds the few such dates of the window) and stay
    there: the running totals come from sums over a sitting's bookings, so the
    expanded rows are neither shuffled nor sorted.
    """
    start = years_before(as_of, years)
    sittings = (
        capacity.with_capacity(past_capacity(sources, as_of, start))
        .groupBy(*INSTANCE)
        .agg(F.collect_list(F.struct("int_id", "shift_category", "util_capacity")).alias("definitions"))
    )
    booked = bookings.bookings_by_creation_day(sources["reservation"], start=start, undated=True)
    placed = sittings.join(asof.gathered_bookings(booked), INSTANCE, "full").withColumns(
        {"day_of_week": F.dayofweek("shift_date"), "month": F.month("shift_date")}
    )
    alike = Window.partitionBy("venue_key_id", "persistent_id", "day_of_week", "month")
    counts = F.lit(True) if history_end is None else F.col("shift_date") < day(history_end)
    means = {
        f"historical_avg_covers_{n}d": F.coalesce(
            safe_ratio(
                F.sum(F.when(counts, F.col(f"near_{n}"))).over(alike),
                F.sum(F.when(counts, F.col(f"days_{n}"))).over(alike),
            ),
            F.lit(0.0),
        )
        for n in asof.VELOCITY_DAYS
    }
    averaged = placed.withColumns(means).select(
        *INSTANCE, "day_of_week", "month", *means, "booked", "final_actual_covers", "definitions"
    )
    visible = asof.running_visible(averaged, asof.horizon_list())
    featured = asof.utilization_asof(asof.party_size_asof(visible)).withColumn("is_hot", labels.hot_by_ratio(threshold))
    return featured.select(
        "shift_date",
        "venue_key_id",
        "persistent_id",
        "snapshot_timestamp",
        "shift_category",
        "day_prior",
        *_parts("shift_date"),
        "util_capacity",
        "covers_as_of_date",
        "reservations_as_of_date",
        "avg_party_size_as_of_date",
        "utilization_as_of_date",
        "covers_last_7_days",
        *means,
        *[c.alias(n) for n, c in dates.season_flags(F.col("shift_date")).items()],
        *[c.alias(n) for n, c in dates.horizon_flags(F.col("day_prior")).items()],
        "is_hot",
    )
