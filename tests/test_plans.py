"""Plan shapes that must hold at scale, with broadcasts switched off."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plan_of(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def text(name: str) -> str:
        return queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()

    yield text
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def final_plan(spark, name: str) -> str:
    """The adaptive plan after a run, in which equal shuffles are shared."""
    df = queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_no_pairwise_join(plan_of, name):
    assert not re.search("NestedLoop|Cartesian", plan_of(name))


def above(plan: str, marker: str) -> str:
    """The part of the plan that runs after the last node matching ``marker``."""
    lines = plan.split("\n")
    first = next(i for i, line in enumerate(lines) if marker in line)
    return "\n".join(lines[:first])


@pytest.mark.parametrize(
    "name", ["asof_covers", "recent_pace", "snapshot_scaffold", "training_shift_running", "training_shift_asof"]
)
def test_snapshots_are_never_shuffled(plan_of, name):
    assert "Exchange" not in above(plan_of(name), "Generate explode")


def test_rich_snapshots_are_never_shuffled(plan_of):
    plan = plan_of("training_shift_rich")
    assert "Window" in above(plan, "Generate explode")
    assert "Exchange" not in above(plan, "Generate explode")


def test_slots_need_no_window(plan_of):
    for name in ("slot_capacity", "shift_slots"):
        assert "Window" not in plan_of(name)


def test_calendar_needs_no_join(plan_of):
    assert "Join" not in plan_of("shift_calendar_all")


def test_booking_aggregates_combine_before_the_shuffle(plan_of):
    for name in ("actual_covers", "bookings_by_creation_day", "current_bookings", "booking_patterns", "lead_time_buckets"):
        plan = plan_of(name)
        assert plan.count("Exchange hashpartitioning") == 1 and ("partial_sum" in plan or "partial_avg" in plan)


@pytest.mark.parametrize(
    "name",
    ["training_shift_final", "training_shift_running", "training_shift_asof", "training_shift_rich",
     "training_slot", "upcoming_shift", "upcoming_slot", "label_quantile"],
)
def test_reservations_are_scanned_once(spark, plan_of, name):
    scans = re.findall(r"FileScan parquet \[[^\]]*l_orderkey", final_plan(spark, name))
    assert len(scans) == 1


def test_ranking_curves_scan_once(spark, plan_of):
    for name in ("roc_auc", "roc_points", "pr_points"):
        assert final_plan(spark, name).count("FileScan") == 1
