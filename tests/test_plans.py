"""What the registered queries' plans must and must not hold."""

import pytest

from __spark_entry__ import queries
from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    return {
        name: query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for name, query in queries().items()
    }


def test_no_python_and_no_cross_join(plans):
    for name, plan in plans.items():
        for banned in ("Python", "Pandas", "Cartesian", "NestedLoop"):
            assert banned not in plan, (name, banned)


NARROW = """
numeric_coercion used_percent_zero used_percent_keep byte_totals probe_dumps day_first_dates
recent_events threshold_levels disk_levels snapshot_flatten storage_usage
""".split()


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_queries_do_not_shuffle(plans, name):
    assert "Exchange" not in plans[name]


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("latest_per_user", 1), ("status_grid_long", 1), ("state_colours", 1), ("order_shares", 1),
        ("status_grid_wide", 1), ("report_counters", 2),
    ],
)
def test_shuffles(plans, name, shuffles):
    assert plans[name].count("Exchange hashpartitioning") == shuffles


@pytest.mark.parametrize("name", ["latest_per_user", "status_grid_long", "order_shares"])
def test_rows_are_combined_before_the_shuffle(plans, name):
    assert "partial_" in plans[name].split("Exchange")[1]


@pytest.mark.parametrize("name", ["report_counters", "document_line_counters", "storage_file_lines"])
def test_lines_are_read_before_the_shuffle_writes(plans, name):
    reading = plans[name].split("Exchange hashpartitioning")[-1]
    assert "Sort [" in reading and "Scan" in reading.split("Sort [")[1]


@pytest.mark.parametrize(
    "name", ["recent_events", "latest_per_user", "status_grid_long", "host_state_report"]
)
def test_window_reaches_the_scan(plans, name):
    assert "GreaterThanOrEqual(ts," in plans[name]


def test_scans_read_only_what_is_used(plans):
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plans["recent_events"]
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plans["order_shares"]
