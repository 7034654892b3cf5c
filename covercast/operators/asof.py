"""Bookings visible as of earlier days.

A booking made ``lead`` days before a sitting is visible in every snapshot
taken at most ``lead`` days before it. So what a sitting shows is a step
function of the snapshot's ``day_prior`` with a step at each lead time. The
steps (at most one per horizon day) are computed from pre-aggregated bookings
and joined to the sittings on their key; the snapshots are generated from the
steps afterwards, inside the task. The hundreds of snapshots per sitting are
therefore never shuffled and never compared with the bookings pair by pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covercast.functions.basic import is_true, let, ratio_or_zero
from covercast.keys import INSTANCE

LAST_DAY = 365
VELOCITY_DAYS = (7, 14, 30, 60)


def _lead() -> Column:
    return F.datediff("shift_date", "creation_day")


def horizon_list(lo: int = 0, hi: int = 180, extra: Iterable[int] = (365,)) -> list[int]:
    """The snapshot horizons: lo..hi and single extra days."""
    return [*range(lo, hi + 1), *(x for x in extra if not lo <= x <= hi)]


def horizon_days(lo: int = 0, hi: int = 180, extra: Iterable[int] = (365,)) -> Column:
    """The snapshot horizons as a constant array."""
    return F.array(*[F.lit(d) for d in horizon_list(lo, hi, extra)])


def horizon_filter(df: DataFrame, lo: int = 0, hi: int = 180, extra: Iterable[int] = (365,)) -> DataFrame:
    return df.filter(F.col("day_prior").between(lo, hi) | F.col("day_prior").isin(*extra))


def with_snapshot_day(df: DataFrame) -> DataFrame:
    return df.withColumn("snapshot_timestamp", F.date_sub("shift_date", F.col("day_prior")))


def snapshot_scaffold(instances: DataFrame, horizons: Column | None = None) -> DataFrame:
    """One row per sitting and snapshot day."""
    days = F.sequence(F.lit(0), F.lit(LAST_DAY)) if horizons is None else horizons
    return with_snapshot_day(instances.withColumn("day_prior", F.explode(days)))


def _steps(changes: DataFrame, measures: Iterable[str], total: str | None = None) -> DataFrame:
    """Turn changes at ``at`` into running totals valid for ``lo``..``hi``.

    ``changes`` hold one row per sitting and distinct ``at`` up to the last
    day, so a window never sees more rows than there are horizon days. An
    ``at`` of -1 stands for "never visible".
    """
    sitting = Window.partitionBy(*INSTANCE)
    downward = sitting.orderBy(F.desc("at"))
    so_far = downward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = [F.sum(total).over(sitting).alias("final_actual_covers")] if total else []
    steps = changes.select(
        *INSTANCE,
        F.col("at").alias("hi"),
        F.coalesce(F.lead("at").over(downward) + 1, F.lit(0)).alias("lo"),
        F.lag("at").over(downward).isNull().alias("topmost"),
        *[F.sum(m).over(so_far).alias(m) for m in measures],
        *totals,
    )
    return steps.filter((F.col("hi") >= 0) | F.col("topmost"))


def expand_steps(joined: DataFrame, measures: Iterable[str], last_day: int) -> DataFrame:
    """List the snapshots each step covers, for sittings joined to their steps.

    The topmost step also lists the earlier snapshots, where nothing was
    visible yet; a sitting without steps lists them all.
    """
    top = F.when(F.col("hi").isNull() | F.col("topmost"), F.lit(last_day)).otherwise(F.col("hi"))
    seen = F.coalesce(F.col("day_prior") <= F.col("hi"), F.lit(False))
    expanded = (
        joined.withColumn("day_prior", F.explode(F.sequence(F.coalesce("lo", F.lit(0)), top)))
        .withColumns({m: F.when(seen, F.coalesce(m, F.lit(0))).otherwise(0) for m in measures})
        .drop("hi", "lo", "topmost")
    )
    return with_snapshot_day(expanded)


def booking_curve(bookings: DataFrame, last_day: int = LAST_DAY, running: bool = False) -> DataFrame:
    """Steps of the guests visible per snapshot (``visible``), and the final
    guests of the sitting, from one aggregation of the bookings.

    ``running`` adds what ``running_snapshots`` needs.
    """
    covers = F.col("covers_created_on_day")
    at = F.when(_lead() >= 0, F.least(_lead(), F.lit(last_day))).otherwise(F.lit(-1))
    sums = {"visible": F.sum(covers)}
    if running:
        sums |= {"reached": F.sum(covers * (at + 1)), "booking_days": F.count(F.lit(1))}
    changes = bookings.groupBy(*INSTANCE, at.alias("at")).agg(
        *[column.alias(name) for name, column in sums.items()]
    )
    return _steps(changes, sums, total="visible")


def attach_curve(sittings: DataFrame, curve: DataFrame) -> DataFrame:
    """Sittings times their steps; a sitting without bookings stays one row."""
    return sittings.join(curve, INSTANCE, "left")


def one_per_sitting(joined: DataFrame) -> DataFrame:
    """Of sittings joined to their steps, one row each."""
    return joined.filter(F.col("hi").isNull() | F.col("topmost"))


def asof_covers(instances: DataFrame, bookings: DataFrame, last_day: int = LAST_DAY) -> DataFrame:
    """Guests booked on or before each snapshot day, snapshots 0..``last_day``."""
    joined = attach_curve(instances, booking_curve(bookings, last_day).drop("final_actual_covers"))
    return expand_steps(joined, ["visible"], last_day).withColumnRenamed("visible", "covers_as_of_date")


def recent_pace(
    instances: DataFrame, bookings: DataFrame, days: int = 7, last_day: int = LAST_DAY
) -> DataFrame:
    """Guests booked in the ``days`` days up to each snapshot day (both ends included)."""
    lead, covers = _lead(), F.col("covers_created_on_day")
    leaves = lead - days - 1
    changes = (
        bookings.filter((lead >= 0) & (leaves < last_day))
        .select(
            *INSTANCE,
            F.inline(
                F.array(
                    F.struct(F.least(lead, F.lit(last_day)).alias("at"), covers.alias("covers_recent")),
                    F.struct(leaves.alias("at"), (-covers).alias("covers_recent")),
                )
            ),
        )
        .filter(F.col("at") >= 0)
        .groupBy(*INSTANCE, "at")
        .agg(F.sum("covers_recent").alias("covers_recent"))
    )
    measures = ["covers_recent"]
    return expand_steps(attach_curve(instances, _steps(changes, measures)), measures, last_day)


def with_copies(instances: DataFrame) -> DataFrame:
    """Add how many capacity rows share the sitting (template plus overrides)."""
    return instances.withColumn(
        "copies", F.count(F.lit(1)).over(Window.partitionBy(*INSTANCE))
    )


def running_snapshots(joined: DataFrame, last_day: int = LAST_DAY) -> DataFrame:
    """Snapshots repeated per visible booking day, with the running total of
    what each earlier snapshot showed (peers included, copies counted).

    ``joined`` are sittings with ``copies`` and their ``running`` curve. Guests
    with lead l have been shown by l - d + 1 snapshots when day_prior d is
    reached, so the running total is a difference of two step functions.
    """
    measures = ["visible", "reached", "booking_days"]
    total = F.col("copies") * (F.col("reached") - F.col("day_prior") * F.col("visible"))
    repeats = F.sequence(F.lit(1), F.greatest(F.col("booking_days").cast("int"), F.lit(1)))
    return (
        expand_steps(joined, measures, last_day)
        .withColumn("covers_as_of_date", total)
        .withColumn("repeat", F.explode(repeats))
        .drop("copies", "repeat", *measures)
    )


def gathered_bookings(bookings: DataFrame) -> DataFrame:
    """One row per sitting: its visible booking days as an array (one entry per
    calendar day, already aggregated), its final guests, and what the booking
    velocity needs."""
    lead, covers = _lead(), F.col("covers_created_on_day")
    entry = F.struct("creation_day", "covers_created_on_day", "reservations_created_on_day")
    return bookings.groupBy(*INSTANCE).agg(
        F.collect_list(F.when(lead >= 0, entry)).alias("booked"),
        F.sum(covers).alias("final_actual_covers"),
        *[F.sum(F.when(lead <= n, covers).otherwise(0)).alias(f"near_{n}") for n in VELOCITY_DAYS],
        # Days within n whose party sizes are all unknown take no part in the mean.
        *[
            F.count(F.when(F.col("creation_day").isNotNull(), F.when(lead <= n, covers).otherwise(0))).alias(f"days_{n}")
            for n in VELOCITY_DAYS
        ],
    )


def visible_bookings(gathered: DataFrame, horizons: Column) -> DataFrame:
    """One row per sitting, snapshot and booking day visible in it (or one row
    without booking); ``gathered`` are sittings with their ``booked`` array."""
    scaffold = snapshot_scaffold(gathered, horizons)
    seen = F.filter("booked", lambda b: b["creation_day"] <= F.col("snapshot_timestamp"))
    return scaffold.withColumn("b", F.explode_outer(seen)).select(
        *[c for c in scaffold.columns if c != "booked"], "b.*"
    )


def running_sum(
    df: DataFrame,
    keys: Iterable[str],
    order: Iterable[str | Column],
    values: dict[str, Column | str],
    frame: str = "rows",
) -> DataFrame:
    """Running totals per key, null counting as 0. ``frame="range"`` gives peers the same total.

    Rows per key should be bounded, as after an aggregation by calendar day.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    bounds = (Window.unboundedPreceding, Window.currentRow)
    window = window.rowsBetween(*bounds) if frame == "rows" else window.rangeBetween(*bounds)
    columns = {n: F.col(v) if isinstance(v, str) else v for n, v in values.items()}
    return df.withColumns({n: F.sum(F.coalesce(v, F.lit(0))).over(window) for n, v in columns.items()})


def running_features(
    visible: DataFrame,
    keys: Iterable[str] = INSTANCE,
    tie_break: Iterable[str] = ("int_id", "shift_category"),
) -> DataFrame:
    """Row-by-row running totals over the visible bookings of a sitting.

    Rows run from the oldest snapshot; inside one snapshot by booking day with
    "none" first, then by capacity row. ``keys`` may name the sitting by more
    columns than needed, to match how the rows are already placed.
    """
    covers = F.coalesce("covers_created_on_day", F.lit(0))
    recent = F.datediff("snapshot_timestamp", "creation_day") <= 7
    return running_sum(
        visible,
        keys,
        [F.col("snapshot_timestamp"), F.asc_nulls_first("creation_day"), *tie_break],
        {
            "covers_as_of_date": covers,
            "reservations_as_of_date": F.coalesce("reservations_created_on_day", F.lit(0)),
            "covers_last_7_days": F.when(recent, covers).otherwise(0),
        },
    )


def _summed_entries(booked: T.DataType, horizons: Iterable[int]) -> tuple[Column, Callable[[Column], Column]]:
    """The ``booked`` array by booking day, with sums up to each entry; and the number of horizons up to a day.

    An entry is visible ``l`` days ahead and later, and recent up to 7 days after. So of the snapshots before the one ``d`` days
    ahead it stood in those with horizons above ``d`` and up to ``l``, and was recent in those of them from ``l - 7`` on.
    """
    days = sorted(set(horizons))
    counts = F.array(*[F.lit(sum(h <= d for h in days)) for d in range(days[-1] + 1)])

    def up_to(day: Column) -> Column:
        return F.when(day < 0, 0).otherwise(F.get(counts, F.least(day, F.lit(days[-1]))))

    entries = F.transform(
        F.array_sort(F.coalesce("booked", F.array().cast(booked))),
        lambda b: F.struct(
            b["creation_day"].alias("creation_day"),
            b["covers_created_on_day"].alias("covers_created_on_day"),
            b["reservations_created_on_day"].alias("reservations_created_on_day"),
            F.datediff("shift_date", b["creation_day"]).alias("lead"),
            F.coalesce(b["covers_created_on_day"], F.lit(0)).alias("covers"),
            F.coalesce(b["reservations_created_on_day"], F.lit(0)).alias("reservations"),
        ),
    )
    names = ["all_covers", "all_reservations", "shown_covers", "shown_reservations", "recent_covers"]

    def add(state: Column, e: Column) -> Column:
        seen, recent = up_to(e["lead"]), up_to(e["lead"]) - up_to(e["lead"] - 8)
        more = [e["covers"], e["reservations"], e["covers"] * seen, e["reservations"] * seen, e["covers"] * recent]
        sums = F.struct(*[(state["sums"][n] + m).alias(n) for n, m in zip(names, more)])
        return F.struct(sums.alias("sums"), F.array_append(state["listed"], F.struct(e.alias("entry"), sums.alias("sums"))).alias("listed"))

    def listed(ordered: Column) -> Column:
        zero = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in names])
        none = F.filter(F.transform(ordered, lambda e: F.struct(e.alias("entry"), zero.alias("sums"))), lambda _: F.lit(False))
        return F.aggregate(ordered, F.struct(zero.alias("sums"), none.alias("listed")), add, lambda state: state["listed"])

    return let(entries, listed), up_to


def running_visible(gathered: DataFrame, horizons: Iterable[int]) -> DataFrame:
    """``running_features`` of ``visible_bookings`` for sittings whose capacity rows are an array ``definitions`` of structs.

    The running totals follow from sums over the bookings of the sitting, so its snapshots are listed with them in place:
    the expanded rows are neither sorted nor held. Capacity rows run in the order of their fields.
    """
    horizons = list(horizons)
    entries, up_to = _summed_entries(gathered.schema["booked"].dataType, horizons)
    kept = [c for c in gathered.columns if c not in ("booked", "definitions")]
    ordered = gathered.filter(F.size("definitions") > 0).select(
        *kept, F.sort_array("definitions").alias("_definitions"), entries.alias("_entries")
    )
    scaffold = snapshot_scaffold(ordered, F.array(*[F.lit(d) for d in horizons]))
    kept = [*kept, "day_prior", "snapshot_timestamp"]
    day = F.col("day_prior")
    seen = scaffold.select(
        *kept, "_definitions", F.filter("_entries", lambda e: e["entry"]["lead"] >= day).alias("_seen")
    ).withColumn("_past", F.size(F.filter("_seen", lambda e: e["entry"]["lead"] > day + 7)))

    def sums(at: Column, name: str) -> Column:
        return F.coalesce(F.get("_seen", at - 1)["sums"][name], F.lit(0))

    size, past = F.size("_seen"), F.col("_past")

    def shown(name: str, start: Column | None = None) -> Column:
        """What the earlier snapshots showed of the visible bookings, or of those after the first ``start``."""
        total, times = sums(size, f"all_{name}"), sums(size, f"shown_{name}")
        if start is not None:
            total, times = total - sums(start, f"all_{name}"), times - sums(start, f"shown_{name}")
        return times - up_to(day) * total

    earlier = seen.select(
        *kept,
        "_definitions",
        F.size("_definitions").alias("_copies"),
        "_past",
        shown("covers").alias("_covers"),
        shown("reservations").alias("_reservations"),
        (sums(past, "recent_covers") + shown("covers", past)).alias("_recent"),
        sums(past, "all_covers").alias("_older"),
        F.posexplode_outer("_seen").alias("_place", "_booking"),
    )
    each = earlier.select(
        *kept, "_copies", "_past", "_covers", "_reservations", "_recent", "_older", "_place", "_booking",
        F.posexplode("_definitions").alias("_copy", "_definition"),
    )
    entry, so_far = F.col("_booking.entry"), F.col("_booking.sums")
    covers, reservations = (F.coalesce(entry[c], F.lit(0)) for c in ("covers", "reservations"))
    before = [F.coalesce(so_far[f"all_{c}"] - entry[c], F.lit(0)) for c in ("covers", "reservations")]
    is_recent = is_true(F.col("_place") >= past)

    def total(earlier_rows: Column, own: Column) -> Column:
        """Every earlier booking stands in a row per capacity row; the own one in those up to this one."""
        return F.col("_copies") * earlier_rows + (F.col("_copy") + 1) * own

    return each.select(
        *kept,
        "_definition.*",
        entry["creation_day"].alias("creation_day"),
        entry["covers_created_on_day"].alias("covers_created_on_day"),
        entry["reservations_created_on_day"].alias("reservations_created_on_day"),
        total(F.col("_covers") + before[0], covers).alias("covers_as_of_date"),
        total(F.col("_reservations") + before[1], reservations).alias("reservations_as_of_date"),
        total(
            F.col("_recent") + F.when(is_recent, before[0] - F.col("_older")).otherwise(0), F.when(is_recent, covers).otherwise(0)
        ).alias("covers_last_7_days"),
    )


def party_size_asof(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "avg_party_size_as_of_date",
        ratio_or_zero(F.col("covers_as_of_date"), F.col("reservations_as_of_date")),
    )


def utilization_asof(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "utilization_as_of_date", ratio_or_zero(F.col("covers_as_of_date"), F.col("util_capacity"))
    )
