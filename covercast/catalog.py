"""The registered queries: every operator run over the benchmark tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covercast.functions import dates
from covercast.functions.seating import pacing_at_minute
from covercast.keys import INSTANCE
from covercast.shared import shared_folder, stored, stored_over_cores
from covercast.operators import (
    asof, bookings, calendar, capacity, encode, evaluate, intervals, labels, lookups, rows, slots, totals,
)
from covercast.plans import importance, model, staged, training, upcoming
from covercast.sources import benchmark, sinks
from covercast.sources.benchmark import AS_OF, NOW

Query = Callable[[SparkSession, str], DataFrame]

FIRST_DAY = dt.date(1989, 1, 1)
LAST_DAY = AS_OF + dt.timedelta(days=365)

_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[dict[str, DataFrame]], DataFrame]) -> None:
    """Register a query over the booking tables under its function's name."""
    _QUERIES[build.__name__] = lambda spark, sf_dir: build(benchmark.sources(spark, sf_dir))


def _scored(build: Callable[[DataFrame], DataFrame]) -> None:
    """Register a query over the judged rows under its function's name."""
    _QUERIES[build.__name__] = lambda spark, sf_dir: build(
        evaluate.with_class(benchmark.scored(spark, sf_dir))
    )


# --- sources and calendar -------------------------------------------------------


@_query
def scan_reservations(src):
    return src["reservation"]


@_query
def active_reservations(src):
    return bookings.active_reservations(
        src["reservation"], start=NOW - dt.timedelta(days=1095), end=NOW
    )


@_query
def date_spine(src):
    daily = src["reservation"].groupBy("date").agg(F.count(F.lit(1)).alias("reservations"))
    return calendar.fill_days(daily, "reservations")


@_query
def holidays(src):
    live = F.when(~F.col("status").isin(*bookings.DEAD_STATUS), F.col("max_guests"))
    daily = src["reservation"].groupBy("date").agg(F.sum(live).alias("guests"))
    return calendar.holidays_of(calendar.fill_days(daily, "guests")).drop("day_of_week")


@_query
def excluded_dates(src):
    return calendar.excluded_dates(src["shift_default"])


@_query
def shift_calendar(src):
    return calendar.shift_calendar(src["shift_default"], FIRST_DAY, LAST_DAY)


@_query
def override_calendar(src):
    return calendar.override_calendar(src["shift_override"], FIRST_DAY, LAST_DAY)


@_query
def shift_calendar_all(src):
    return calendar.shift_calendar_all(
        calendar.shift_calendar(src["shift_default"], FIRST_DAY, LAST_DAY),
        calendar.override_calendar(src["shift_override"], FIRST_DAY, LAST_DAY),
    )


@_query
def calendar_names(src):
    sittings = bookings.actual_covers(src["reservation"])
    dated = sittings.withColumns(dates.date_parts(F.col("shift_date")))
    return calendar.calendar_names(dated).select(
        *INSTANCE, "day_of_week", "month", "year", "final_actual_covers"
    )


@_query
def calendar_flags(src):
    booked = bookings.bookings_by_creation_day(src["reservation"]).withColumn(
        "day_prior", F.datediff("shift_date", "creation_day")
    )
    kept = booked.select(*INSTANCE, "creation_day", "day_prior", "covers_created_on_day")
    return calendar.calendar_flags(kept, "shift_date", "day_prior")


@_query
def holiday_flag(src):
    sittings = bookings.actual_covers(src["reservation"]).select(*INSTANCE, "final_actual_covers")
    return calendar.holiday_flag(sittings, "shift_date")


@_query
def venue_lookup(src):
    return lookups.venue_lookup(bookings.actual_covers(src["reservation"]), src["venue"])


# --- capacity -------------------------------------------------------------------


def _denorm(src):
    return capacity.denorm_all(src["shift_default_denorm"], src["shift_override_denorm"])


@_query
def table_capacity(src):
    return capacity.table_capacities(_denorm(src)).select(
        "venue_key_id", "int_id", "table_size", "table_capacity"
    )


@_query
def pacing_capacity(src):
    return capacity.pacing_capacities(_denorm(src)).select(
        "venue_key_id", "int_id", "table_size", "max_shift_capacity"
    )


@_query
def shift_capacity(src):
    return capacity.shift_capacity_per_day(src, FIRST_DAY, LAST_DAY)


@_query
def shift_times(src):
    dated = capacity.shift_capacity_per_day(src, FIRST_DAY, LAST_DAY, capacity.TIME_COLUMNS)
    return capacity.shift_times(dated).select(
        "date", "venue_key_id", "int_id", "persistent_id", "name", "shift_category",
        "interval_minutes", "util_capacity", "normalized_start_time", "end_time",
        "normalized_end_time", "normalized_end_time_dom", "normalized_end_time_minutes",
        "normalized_start_time_minutes", "date_partition",
    )


@_query
def interval_covers(src):
    """Guests who arrive while a sitting is open, by its own clock times, for the last 400 days."""
    start = AS_OF - dt.timedelta(days=400)
    dated = capacity.shift_capacity_per_day(src, start, AS_OF, capacity.TIME_COLUMNS)
    keys = ["venue_key_id", "persistent_id", "date", "int_id"]
    sittings = bookings.open_hours(capacity.shift_times(dated)).select(*keys, "opens", "closes")
    return bookings.arrivals_while_open(sittings, src["reservation"], keys)


@_query
def future_capacity(src):
    return upcoming.future_capacity(src, AS_OF)


# --- bookings -------------------------------------------------------------------


@_query
def actual_covers(src):
    return bookings.actual_covers(src["reservation"])


@_query
def lead_time_buckets(src):
    return bookings.lead_time_buckets(src["reservation"])


@_query
def bookings_by_creation_day(src):
    return bookings.bookings_by_creation_day(src["reservation"])


@_query
def current_bookings(src):
    return bookings.current_bookings(src["reservation"], NOW)


@_query
def booking_timing(src):
    return bookings.booking_timing(bookings.current_bookings(src["reservation"], NOW), AS_OF)


@_query
def booking_velocity(src):
    return bookings.booking_velocity(
        bookings.bookings_by_creation_day(src["reservation"], start=training.years_before(AS_OF, 2))
    )


@_query
def booking_patterns(src):
    return bookings.booking_patterns(src["reservation"], AS_OF)


# --- labels ---------------------------------------------------------------------


@_query
def label_ratio(src):
    return training.labelled_sittings(src, AS_OF)


@_query
def backtest_window(src):
    return labels.backtest_window(training.labelled_sittings(src, AS_OF), AS_OF)


@_query
def final_outcomes(src):
    return training.quantile_outcomes(src, AS_OF)


@_query
def weekday_threshold(src):
    return labels.weekday_threshold(training.quantile_outcomes(src, AS_OF))


@_query
def weekday_threshold_exact(src):
    return labels.weekday_threshold(training.quantile_outcomes(src, AS_OF), exact=True)


@_query
def label_quantile(src):
    return labels.label_by_quantile(training.quantile_outcomes(src, AS_OF))


# --- snapshots ------------------------------------------------------------------


def _sittings(src):
    labelled = training.labelled_sittings(src, AS_OF, years=2)
    return capacity.with_capacity(labelled)


@_query
def snapshot_scaffold(src):
    kept = _sittings(src).select(*INSTANCE, "int_id", "util_capacity")
    return asof.snapshot_scaffold(kept, asof.horizon_days())


@_query
def asof_covers(src):
    booked = bookings.bookings_by_creation_day(src["reservation"])
    return asof.asof_covers(_sittings(src).select(*INSTANCE, "int_id"), booked)


@_query
def recent_pace(src):
    booked = bookings.bookings_by_creation_day(src["reservation"])
    return asof.recent_pace(_sittings(src).select(*INSTANCE, "int_id"), booked)


_RUNNING = {
    "running_covers": "covers_created_on_day",
    "running_reservations": "reservations_created_on_day",
}


@_query
def running_sum_rows(src):
    booked = bookings.bookings_by_creation_day(src["reservation"])
    return asof.running_sum(booked, INSTANCE, ["creation_day"], _RUNNING).select(
        *INSTANCE, "creation_day", *_RUNNING
    )


@_query
def running_sum_range(src):
    booked = bookings.bookings_by_creation_day(src["reservation"]).withColumn(
        "creation_week", dates.week_start(F.col("creation_day"))
    )
    return asof.running_sum(booked, INSTANCE, ["creation_week"], _RUNNING, "range").select(
        *INSTANCE, "creation_day", "creation_week", *_RUNNING
    )


#: Creation days of all sittings of a venue: a key of any size.
_BY_VENUE = ["creation_day", "persistent_id", "shift_date"]


@_query
def running_total_rows(src):
    booked = bookings.bookings_by_creation_day(src["reservation"])
    return totals.running_total(booked, ["venue_key_id"], _BY_VENUE, _RUNNING).select(*INSTANCE, "creation_day", *_RUNNING)


@_query
def running_total_range(src):
    booked = bookings.bookings_by_creation_day(src["reservation"]).withColumn(
        "creation_week", dates.week_start(F.col("creation_day"))
    )
    return totals.running_total(booked, ["venue_key_id"], ["creation_week"], _RUNNING, "range").select(
        *INSTANCE, "creation_day", "creation_week", *_RUNNING
    )


# --- categories -----------------------------------------------------------------


@_query
def encoded_categories(src):
    """Numbers of names learnt from past reservations, for all of them."""
    visit = F.concat_ws("/", "venue_key_id", "shift_persistent_id", "date")
    named = src["reservation"].select("venue_key_id", "shift_persistent_id", "status", "date", visit.alias("visit"))
    past = named.filter(F.col("date") < F.lit(AS_OF))
    columns = ["shift_persistent_id", "status", "visit"]
    return encode.encoded(named, {c: encode.dictionary(past, c) for c in columns})


# --- slots ----------------------------------------------------------------------


def _slot_sittings(src):
    return training.past_capacity(
        src, AS_OF, AS_OF - dt.timedelta(days=400), capacity.SLOT_COLUMNS
    )


@_query
def shift_slots(src):
    return slots.shift_slots(_slot_sittings(src)).select(
        *slots.SLOT, "shift_category", "slot_start_time_min", "slot_end_time_min",
        "slot_start_timestamp", "slot_end_timestamp",
    )


@_query
def pacing_at_minute_(src):
    listed = pacing_at_minute(
        F.col("custom_pacing_str"), F.col("slot_start_time_min"), F.col("covers_per_seating_interval")
    )
    return slots.shift_slots(_slot_sittings(src)).select(*slots.SLOT, listed.alias("pacing"))


_QUERIES["pacing_at_minute"] = _QUERIES.pop("pacing_at_minute_")


@_query
def slot_capacity(src):
    return slots.slot_capacity(_slot_sittings(src)).select(
        *slots.SLOT, "util_capacity", "raw_pacing", "pacing_weight", "total_weight", "slot_capacity"
    )


@_query
def slot_covers(src):
    arrived = bookings.active_reservations(
        src["reservation"], start=NOW - dt.timedelta(days=1095), end=NOW
    )
    return slots.slot_covers(_slot_sittings(src), arrived)


# --- tables ---------------------------------------------------------------------


@_query
def training_shift_final(src):
    return training.training_shift_final(src, AS_OF)


@_query
def training_shift_running(src):
    return training.training_shift_running(src, AS_OF)


@_query
def training_shift_asof(src):
    return training.training_shift_asof(src, AS_OF)


@_query
def training_slot(src):
    return training.training_slot(src, AS_OF, NOW)


@_query
def training_shift_rich(src):
    return training.training_shift_rich(src, AS_OF)


@_query
def upcoming_shift(src):
    return upcoming.upcoming_shift(src, AS_OF, NOW)


@_query
def upcoming_shift_holiday(src):
    return upcoming.upcoming_shift_holiday(src, AS_OF)


@_query
def upcoming_slot(src):
    return upcoming.upcoming_slot(src, AS_OF, NOW)


@_query
def upcoming_shift_rich(src):
    return upcoming.upcoming_shift_rich(src, AS_OF, NOW)


# --- rows and evaluation ----------------------------------------------------------


def clean_training_rows(spark, sf_dir):
    return rows.clean_training_rows(benchmark.raw_training_rows(spark, sf_dir))


_QUERIES["clean_training_rows"] = clean_training_rows


def prepared_rows(spark, sf_dir):
    """Rows as they are scored: numbers read, absent features added, nulls filled, features chosen by type and name."""
    raw = benchmark.raw_training_rows(spark, sf_dir).withColumn("as_of_date", F.current_date())
    read = rows.coerce_numeric(raw, ("util_capacity", "covers_as_of_date"))
    full = rows.fill_numeric(rows.ensure_columns(read, ("covers_as_of_date", "covers_last_7_days", "is_holiday")))
    keys = ["l_orderkey", "l_linenumber"]
    return full.select(*keys, *rows.feature_columns(full.schema, [*keys, *model.NOT_FEATURES]))


_QUERIES["prepared_rows"] = prepared_rows


@_scored
def backtest_results(judged):
    return evaluate.backtest_output(judged)


def exported_results(spark, sf_dir):
    """The saved back-test: written in order by month, the last month written again, and read back."""
    judged = evaluate.backtest_output(evaluate.with_class(benchmark.scored(spark, sf_dir)))
    results = judged.withColumn("result_month", F.date_format("shift_date", "yyyy-MM"))
    path = f"{shared_folder(spark)}/results-{uuid.uuid4().hex}"
    order = ["shift_date", "venue_key_id", "persistent_id"]
    sinks.write_ordered(results, path, order, "result_month")
    last = results.agg(F.max("result_month")).scalar()
    sinks.write_ordered(results.filter(F.col("result_month") == last), path, order, "result_month")
    return spark.read.schema(results.schema).option("header", True).csv(path)


_QUERIES["exported_results"] = exported_results


@_scored
def class_balance(judged):
    return rows.class_balance(judged)


@_scored
def score_summary(judged):
    return evaluate.score_summary(judged).withColumn(
        "avg_hot_probability", F.round("avg_hot_probability", 9)
    )


@_scored
def accuracy_by_weekday(judged):
    return evaluate.accuracy_by_weekday(judged)


@_scored
def accuracy_by_horizon(judged):
    return evaluate.accuracy_by_horizon(judged)


@_scored
def top_hot_shifts(judged):
    return evaluate.top_hot_shifts(judged).select(
        "shift_date", "venue_key_id", "persistent_id", "hot_probability", "predicted_hot"
    )


@_scored
def confusion_counts(judged):
    return evaluate.confusion_counts(judged)


@_scored
def classification_metrics(judged):
    return evaluate.classification_metrics(judged).withColumn("auc_score", F.round("auc_score", 9))


@_scored
def class_report(judged):
    return evaluate.class_report(judged)


@_scored
def roc_auc(judged):
    return evaluate.roc_auc(judged).withColumn("auc_score", F.round("auc_score", 9))


@_scored
def roc_points(judged):
    return evaluate.roc_points(judged)


@_scored
def pr_points(judged):
    return evaluate.pr_points(judged)


@_scored
def score_histogram(judged):
    return evaluate.score_histogram(judged, by="is_hot").withColumns(
        {c: F.round(c, 9) for c in ("bin_start", "bin_end")}
    )


@_scored
def score_histogram_all(judged):
    return evaluate.score_histogram(judged).withColumns({c: F.round(c, 9) for c in ("bin_start", "bin_end")})


@_scored
def row_weights(judged):
    counted = F.month("shift_date") % 5 != 0
    return rows.with_class_weight(judged.select("shift_date", "venue_key_id", "persistent_id", "day_prior", "is_hot"), counted=counted)


@_scored
def fixed_sample(judged):
    keys = ["shift_date", "venue_key_id", "persistent_id", "day_prior"]
    return rows.fixed_sample(judged.select(*keys, "is_hot"), 200, 42, keys)


@_scored
def calibration_curve(judged):
    return evaluate.calibration_curve(judged)


def stratified_split(spark, sf_dir):
    return rows.stratified_split(benchmark.scored(spark, sf_dir), "is_hot")


_QUERIES["stratified_split"] = stratified_split


def metrics_by_split(spark, sf_dir):
    judged = evaluate.with_class(stratified_split(spark, sf_dir))
    return evaluate.metrics_by(judged, "is_validation").withColumn("auc_score", F.round("auc_score", 9))


_QUERIES["metrics_by_split"] = metrics_by_split


@_scored
def metrics_by_shift(judged):
    return evaluate.metrics_by(judged, "persistent_id", "day_of_week").withColumn("auc_score", F.round("auc_score", 9))


# --- model --------------------------------------------------------------------------


#: The registered fits are shorter than ``BoostParams()``; README has time and AUC of both.
SHORT = model.BoostParams(trees=40, step=0.3, patience=20)


def _slot_settings(src):
    """Capacity and slot settings of every shift, written once: past and coming sittings read them."""
    return stored(capacity.all_setting_capacity(src, capacity.SLOT_COLUMNS), "settings")


def _slot_rows(src, settings):
    """Past slots, written once with their hash cell, and marked once: the class weight, every tree and every stage read the marked files."""
    numeric, cell = ("slot_capacity", "covers_as_of_date"), "split_cell"
    past = training.training_slot(src, AS_OF, NOW, keep=stored_over_cores, settings=settings)
    held = stored(model.with_split_cell(past, numeric, cell), "slots")
    marked, features = model.prepare_training(held, model.SLOT_FEATURES, numeric, cell=cell)
    return rows.with_class_weight(stored(marked, "marked"), counted=~F.col("is_validation")), features


def model_scores(spark, sf_dir):
    """Fit on the past slots and score the coming ones (no SQL counterpart)."""
    src = benchmark.sources(spark, sf_dir)
    settings = _slot_settings(src)
    marked, features = _slot_rows(src, settings)
    fitted = model.fit_model(marked, features, SHORT, validation_col="is_validation", weight_col="weight", in_files=True)
    coming = upcoming.upcoming_slot(src, AS_OF, NOW, keep=stored_over_cores, settings=settings)
    return model.predict_future(fitted, coming).select(
        *slots.SLOT, "slot_capacity", "covers_as_of_date", evaluate.SCORE, evaluate.PREDICTED
    )


_QUERIES["model_scores"] = model_scores


def model_stages(spark, sf_dir):
    """AUC of every prefix of the trees on the validation rows, and whether it is the one that stays (no SQL counterpart)."""
    src = benchmark.sources(spark, sf_dir)
    marked, features = _slot_rows(src, _slot_settings(src))
    fitted = model.fit_model(marked.filter("not is_validation"), features, SHORT, weight_col="weight", in_files=True)
    curve = staged.staged_auc(fitted, marked.filter("is_validation"))
    # One row per tree.
    best, _ = staged.best_prefix(curve.orderBy("trees").collect(), SHORT.patience)
    return curve.withColumn("stays", F.col("trees") == best)


_QUERIES["model_stages"] = model_stages

def feature_importances(spark, sf_dir):
    """The ten features of past slots whose shuffling costs most AUC on the validation rows (no SQL counterpart)."""
    src = benchmark.sources(spark, sf_dir)
    marked, features = _slot_rows(src, _slot_settings(src))
    params = model.BoostParams(trees=10, step=0.3)
    fitted = model.fit_model(marked.filter("not is_validation"), features, params, weight_col="weight", in_files=True)
    return importance.shuffled_importances(fitted, marked.filter("is_validation"), features, [*slots.SLOT]).orderBy(
        F.desc("importance"), "feature"
    ).limit(10)


_QUERIES["feature_importances"] = feature_importances

# Queries that SQL cannot express.
ITERATIVE = ("model_scores", "model_stages", "feature_importances")


def queries() -> dict[str, Query]:
    return dict(sorted(_QUERIES.items()))
