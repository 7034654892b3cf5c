"""Loading, layout and writing of tables."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covercast.operators import bookings
from covercast.plans import training, upcoming
from covercast.sources import benchmark, load, sinks
from covercast.sources.schemas import TABLES, schema_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The six tables written as a warehouse would hold them."""
    folder = str(tmp_path_factory.mktemp("warehouse"))
    for name, df in benchmark.sources(spark, SF_DIR).items():
        if name == "reservation":
            sinks.write_reservations(df, f"{folder}/{name}")
        else:
            sinks.write_table(df, f"{folder}/{name}")
    return folder


def test_loaded_tables_have_the_declared_schema(spark, stored):
    tables = load.load_sources(spark, stored)
    assert set(tables) == set(TABLES)
    for name, df in tables.items():
        folders = [] if name != "reservation" else [(c, T.StringType()) for c in ("service_month", "date_month")]
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema_of(name)] + folders


def test_stored_and_derived_tables_give_the_same_labels(spark, stored):
    a = training.labelled_sittings(load.load_sources(spark, stored), benchmark.AS_OF)
    b = training.labelled_sittings(benchmark.sources(spark, SF_DIR), benchmark.AS_OF)
    assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count()


def test_filters_reach_the_parquet_reader(spark, stored):
    res = load.load_sources(spark, stored, venues=[1])["reservation"]
    kept = bookings.active_reservations(res, start=dt.datetime(2000, 1, 1), end=dt.datetime(2001, 1, 1))
    plan = bookings.actual_covers(kept)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan" in line)
    for test in ("EqualTo(venue_key_id,1)", "Not(EqualTo(status,CANCELED))", "GreaterThanOrEqual(marked_time", "LessThanOrEqual(marked_time"):
        assert test in scan
    assert "created" not in scan.split("ReadSchema")[1]


def test_venue_filter_is_one_venue_run(spark, stored):
    everything = training.labelled_sittings(load.load_sources(spark, stored), benchmark.AS_OF)
    single = training.labelled_sittings(load.load_sources(spark, stored, venues=[1]), benchmark.AS_OF)
    assert single.exceptAll(everything.filter("venue_key_id = 1")).isEmpty()
    assert single.count() == everything.filter("venue_key_id = 1").count() > 0


def test_required_columns_and_emptiness(spark):
    df = spark.range(1)
    assert load.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="missing columns"):
        load.require_columns(df, ["id", "other"])
    assert load.is_empty(None) and load.is_empty(df.filter("id > 5")) and not load.is_empty(df)


def test_conform_casts_and_fills_optional_columns(spark):
    raw = spark.sql("select 1 as int_id, '2' as venue_key_id, date'2024-01-01' as date, 'A' as category, null as deleted")
    row = load.conform(raw, "shift_override").first()
    assert (row.int_id, row.venue_key_id, row.deleted) == (1, 2, None)
    with pytest.raises(ValueError):
        load.conform(spark.range(1), "venue")


def test_csv_round_trip_and_partitions(spark, tmp_path):
    df = spark.sql("select 0.25D as hot_probability, 'lunch' as persistent_id, date'2024-06-01' as shift_date")
    sinks.write_scores(df, f"{tmp_path}/csv")
    back = spark.read.option("header", True).csv(f"{tmp_path}/csv").first()
    assert (back.hot_probability, back.persistent_id, back.shift_date) == ("0.25", "lunch", "2024-06-01")
    sinks.write_scores(df, f"{tmp_path}/parquet", "parquet", ["shift_date"])
    assert (tmp_path / "parquet" / "shift_date=2024-06-01").exists()
    assert spark.read.parquet(f"{tmp_path}/parquet").count() == 1


def test_ordered(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (2, 0)], "a int, b int")
    assert [tuple(r) for r in sinks.ordered(df, ["a", "b"], ["a"]).collect()] == [(2, 0), (1, 1), (1, 2)]


def test_windows_skip_folders(spark, stored):
    """Every windowed table filters by folder, and only the folders of its window are left."""
    src = load.load_sources(spark, stored)
    as_of, now = benchmark.AS_OF, benchmark.NOW
    windowed = {
        "training_shift_final": training.training_shift_final(src, as_of),
        "training_slot": training.training_slot(src, as_of, now),
        "training_shift_rich": training.training_shift_rich(src, as_of),
        "upcoming_shift": upcoming.upcoming_shift(src, as_of, now),
        "upcoming_shift_holiday": upcoming.upcoming_shift_holiday(src, as_of),
        "upcoming_slot": upcoming.upcoming_slot(src, as_of, now),
        "booking_patterns": bookings.booking_patterns(src["reservation"], as_of),
    }
    for name, df in windowed.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan" in line and "max_guests" in line]
        assert scans, name
        for scan in scans:
            filters = scan.split("PartitionFilters: [")[1].split("]")[0]
            assert "service_month" in filters or "date_month" in filters, (name, scan)
    months = sorted(p.name.removeprefix("service_month=") for p in pathlib.Path(stored, "reservation").iterdir() if "=2" in p.name or "=19" in p.name)
    assert len(months) > 8
    chosen = months[4:6]
    first, last = (dt.datetime.strptime(m, "%Y-%m") for m in chosen)
    window = bookings.active_reservations(src["reservation"], start=first, end=last + dt.timedelta(days=27))
    read = {r.f.split("service_month=")[1].split("/")[0] for r in window.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read and read <= set(chosen)


def test_windows_give_the_same_rows_with_and_without_folders(spark, stored):
    a, b = load.load_sources(spark, stored), benchmark.sources(spark, SF_DIR)
    for build in (lambda s: upcoming.upcoming_shift(s, benchmark.AS_OF, benchmark.NOW), lambda s: training.training_shift_final(s, benchmark.AS_OF),
                  lambda s: bookings.booking_patterns(s["reservation"], benchmark.AS_OF)):
        x, y = build(a), build(b)
        assert x.count() == y.count() and x.exceptAll(y.select(x.columns)).isEmpty()


def test_ordered_export_replaces_what_it_writes(spark, tmp_path):
    rows = [(d, n, f"v{n}" if n % 5 else ("" if n % 2 else None)) for d in ("a", "b", None) for n in range(50)]
    df = spark.createDataFrame(rows, "day string, n int, v string")
    path = f"{tmp_path}/out"
    for again in (df, df.filter("day = 'b'"), df):
        sinks.write_ordered(again, path, ["n"], "day")
    back = spark.read.schema(df.schema).option("header", True).option("nullValue", "no such text").csv(path)
    assert sorted(map(repr, back.select(df.columns).collect())) == sorted(map(repr, df.collect()))
    sinks.write_ordered(df.filter("day = 'a' and n < 7"), path, ["n"], "day")
    counts = {r.day: r["count"] for r in spark.read.schema(df.schema).option("header", True).csv(path).groupBy("day").count().collect()}
    assert counts == {"a": 7, "b": 50, None: 50}
    for folder in pathlib.Path(path).glob("day=*"):
        lines = [int(line.split(",")[0]) for f in sorted(folder.glob("part-*")) for line in f.read_text().splitlines()[1:]]
        assert lines == sorted(lines)
