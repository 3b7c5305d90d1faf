from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsmetrics.fixed_values import (
    DISK_LEVELS,
    GROUP_PATTERNS,
    HOST_ORDER,
    SNAPSHOT_LEVELS,
    STATE_PALETTE,
)
from opsmetrics.operators.hosts import assign_group, display_names, host_dimension
from opsmetrics.operators.levels import classify_by_rules, classify_levels, classify_states
from tests.rows import frame, values

HOSTS = ["host-09 repo", "host-02 data", "host-05 repo data", "host-01"]
PATTERNS = {"repos": "repo|Scheduler", "nodes": "data"}


def test_order_and_groups(spark):
    names = [*HOSTS, "host-77 repo", None, "HOST-09 REPO"]
    df = frame(spark, "server_name string", [(n,) for n in names])
    got = assign_group(df, "server_name", HOSTS, PATTERNS).orderBy("position", "group_name")
    assert [tuple(r) for r in got.select("server_name", "position", "group_name").collect()] == [
        ("host-09 repo", 0, "repos"),
        ("host-02 data", 1, "nodes"),
        ("host-05 repo data", 2, "nodes"),
        ("host-05 repo data", 2, "repos"),
    ]


def test_groups_from_a_table(spark):
    df = frame(spark, "server_name string, n int", [("a", 1), ("b", 2), ("c", 3)])
    table = frame(
        spark, "server_name string, position int, group_name string", [("b", 0, "x"), ("a", 1, "y")]
    )
    got = assign_group(df, "server_name", table, patterns=None).orderBy("position")
    assert [tuple(r) for r in got.select("server_name", "n", "group_name").collect()] == [
        ("b", 2, "x"),
        ("a", 1, "y"),
    ]


def test_every_listed_host_is_in_one_group(spark):
    df = frame(spark, "server_name string", [(n,) for n in HOST_ORDER])
    got = assign_group(df, "server_name").orderBy("position").collect()
    assert [r["server_name"] for r in got] == HOST_ORDER
    first, second = GROUP_PATTERNS
    assert [r["group_name"] for r in got] == [first] * 5 + [second] * 7


def test_small_dimension_is_broadcast_by_its_size(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    joined = assign_group(df, "o_orderpriority", ["1-URGENT"], {"all": "."})
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = assign_group(df, "o_orderpriority", ["1-URGENT"], {"all": "."})
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_dimension(spark):
    df = frame(spark, "k string", [("a",)])
    assert host_dimension(df, "k", []).count() == 0
    assert assign_group(df, "k", [], PATTERNS).count() == 0


def test_display_names(spark):
    df = frame(spark, "server_name string, used_ram_percent double, used_disk_gb double", [])
    assert display_names(df).columns == ["Name", "used_ram_percent", "useDisk(GB)"]


@pytest.mark.parametrize(
    ("value", "colour"),
    [
        (70.0, "white"), (70.01, "yellow"), (80.0, "yellow"), (80.01, "red"), (None, "white"),
        (float("nan"), "white"), (float("inf"), "red"), (-1.0, "white"),
    ],
)
def test_snapshot_levels(spark, value, colour):
    columns = list(SNAPSHOT_LEVELS)
    df = frame(spark, ", ".join(f"`{c}` double" for c in columns), [(value,) * 3])
    got = classify_levels(df, SNAPSHOT_LEVELS).first()
    assert [got[f"{c}_colour"] for c in columns] == [colour] * 3


def test_disk_levels(spark):
    df = frame(spark, "`useDisk(%)` double", [(70.0,), (70.01,), (99.0,), (None,)])
    got = classify_levels(df, DISK_LEVELS, default=None)
    assert values(got, "useDisk(%)", "useDisk(%)_colour") == [
        (70.0, None), (70.01, "yellow"), (99.0, "yellow"), (None, None),
    ]


STATES = [("GOOD",), ("CONCERNING",), ("BAD",), ("N/A",), ("DISABLED",), ("good",), (None,)]


@pytest.mark.parametrize("as_table", [False, True])
def test_state_colours(spark, as_table):
    palette = STATE_PALETTE
    if as_table:
        palette = frame(spark, "health_status string, tint string", list(STATE_PALETTE.items()))
    df = frame(spark, "state string", STATES)
    got = dict(values(classify_states(df, "state", palette), "state", "colour"))
    assert got == {
        "GOOD": "#4CAF50", "CONCERNING": "#FF9800", "BAD": "#F44336", "N/A": "#BDBDBD",
        "DISABLED": "white", "good": "white", None: "white",
    }


RULES = "metric string, level string, lower double, valid_from timestamp, valid_to timestamp"


def day(text):
    return datetime.fromisoformat(text) if text else None


def test_dated_rules(spark):
    rules = [
        ("cpu", "yellow", 70.0, None, day("2026-03-01")),
        ("cpu", "orange", 60.0, day("2026-03-01"), None),
        ("cpu", "red", 90.0, day("2026-01-15"), day("2026-06-01 12:00")),
        ("cpu", "amber", 60.0, day("2026-03-01"), None),
        ("disk", "red", 1.0, None, None),
        (None, "black", 0.0, None, None),
        ("cpu", None, 0.0, None, None),
        ("cpu", "black", None, None, None),
        ("cpu", "black", 0.0, day("2026-03-01"), day("2026-03-01")),
    ]
    rows = [
        (1, "cpu", 95.0, day("2026-01-14 23:59"), "yellow"),
        (2, "cpu", 95.0, day("2026-01-15"), "red"),
        (3, "cpu", 90.0, day("2026-02-28 23:59"), "yellow"),
        (4, "cpu", 90.0, day("2026-03-01"), "orange"),
        (5, "cpu", 95.0, day("2026-06-01 11:59"), "red"),
        (6, "cpu", 95.0, day("2026-06-01 12:00"), "orange"),
        (7, "cpu", 60.0, day("2026-07-01"), "white"),
        (8, "disk", 2.0, day("1969-01-01"), "red"),
        (9, "other", 2.0, day("2026-01-01"), "white"),
        (10, None, 2.0, day("2026-01-01"), "white"),
        (11, "cpu", None, day("2026-01-01"), "white"),
        (12, "cpu", float("nan"), day("2026-01-01"), "white"),
        (13, "disk", 2.0, None, "white"),
        (13, "disk", 2.0, None, "white"),
    ]
    table = frame(spark, RULES, rules)
    # Columns named like those of the rules and of the result.
    facts = frame(spark, "id int, lower string, value double, at timestamp, colour string", rows)
    wide = facts.withColumns({"bin": F.lit("b"), "metric": F.lit("m"), "level": F.lit("l")})
    for bins in (1, 30, 400):
        got = classify_by_rules(wide, table, "lower", "value", "at", bin_days=bins)
        assert got.columns == ["id", "lower", "value", "at", "bin", "metric", "level", "colour"]
        assert sorted((r.id, r.colour) for r in got.collect()) == [(r[0], r[4]) for r in rows]
        assert got.filter("bin = 'b' AND metric = 'm' AND level = 'l'").count() == len(rows)
    assert classify_by_rules(wide.limit(0), table, "lower", "value", "at").count() == 0
    bare = classify_by_rules(wide, table.limit(0), "lower", "value", "at", default=None)
    assert bare.filter("colour IS NULL").count() == len(rows)


def test_dated_rules_join_by_equality(spark):
    table = frame(spark, RULES, [("cpu", "red", 1.0, None, None)])
    facts = frame(spark, "metric string, value double, at timestamp", [("cpu", 2.0, day("2026-01-01"))])
    got = classify_by_rules(facts, table, "metric", "value", "at")
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
