import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from opsmetrics.operators.grid import (
    grid_dates,
    grid_table,
    status_grid,
    to_cells,
    wide_grid,
)
from opsmetrics.operators.locks import active_locks, numbered_locks
from opsmetrics.operators.numbering import number_rows
from tests.rows import frame, values

NOW = datetime(2026, 12, 4, 9, 30)
DAY = timedelta(days=1)
SCHEMA = "service_name string, timestamp timestamp, health_status string"
POLLS = [
    ("hive", NOW, "GOOD"),
    ("hive", NOW - 2 * DAY, "BAD"),
    ("yarn", NOW, None),
    ("yarn", NOW + 5 * DAY, "ODD"),
    ("yarn", None, "BAD"),
    ("yarn", None, "GOOD"),
]
REPOLL = ("hive", NOW + timedelta(hours=1), "CONCERNING")


def grid(df, **options):
    return status_grid(df, "service_name", "timestamp", "health_status", **options)


def wide(df, dates, **options):
    return wide_grid(df, "service_name", "timestamp", "health_status", dates, **options)


@pytest.mark.parametrize("policy", ["error", "latest"])
def test_grid_without_repeats(spark, policy):
    df = frame(spark, SCHEMA, POLLS)
    long = grid(df, on_duplicate=policy)
    assert values(long, "service_name", "date", "health_status") == [
        ("hive", "2026-12-02", "BAD"),
        ("hive", "2026-12-04", "GOOD"),
        ("yarn", "2026-12-04", "N/A"),
        ("yarn", "2026-12-09", "ODD"),
    ]
    dates = grid_dates(df, "timestamp")
    assert dates == ["2026-12-02", "2026-12-04", "2026-12-09"]
    assert [tuple(r) for r in wide(df, dates, on_duplicate=policy).collect()] == [
        ("hive", "BAD", "GOOD", "N/A"),
        ("yarn", "N/A", "N/A", "ODD"),
    ]


def test_wide_grid_cell_by_cell(spark):
    rng = random.Random(13)
    states = ["GOOD", "BAD", "CONCERNING", "DISABLED", None]
    cells = rng.sample([(f"s{n:02}", d) for n in range(30) for d in range(12) if d != 5], 200)
    rows = [
        (name, NOW - d * DAY + timedelta(minutes=rng.randint(-500, 800)), rng.choice(states))
        for name, d in cells
    ]
    seen = {(name, str(at.date())): state for name, at, state in rows}
    days = sorted({day for _, day in seen})
    expected = [
        (name, *[seen.get((name, day)) or "N/A" for day in days])
        for name in sorted({name for name, _ in seen})
    ]
    df = frame(spark, SCHEMA, rows).repartition(8)
    assert grid_dates(df, "timestamp") == days
    got = wide(df, days, on_duplicate="error")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in got.collect()] == expected


def test_repeats_take_the_latest(spark):
    long = grid(frame(spark, SCHEMA, [REPOLL, *POLLS]))
    assert ("hive", "2026-12-04", "CONCERNING") in values(
        long, "service_name", "date", "health_status"
    )


def test_repeats_can_fail(spark):
    long = grid(frame(spark, SCHEMA, [*POLLS, REPOLL]), on_duplicate="error")
    with pytest.raises(Exception, match="more than one row for hive on 2026-12-04"):
        long.collect()
    both = wide(frame(spark, SCHEMA, [*POLLS, REPOLL]), ["2026-12-04"], on_duplicate="error")
    with pytest.raises(Exception, match="more than one row for hive on 2026-12-04"):
        both.collect()


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        grid(frame(spark, SCHEMA, POLLS), on_duplicate="first")
    with pytest.raises(ValueError):
        wide(frame(spark, SCHEMA, POLLS), [], on_duplicate="first")


def test_ties_follow_the_tiebreak(spark):
    rows = [("s", NOW, state, n) for n, state in enumerate(["c", "z", "a"])]
    df = frame(spark, "service_name string, timestamp timestamp, health_status string, n int", rows)
    assert values(grid(df, tiebreak=["n"]), "health_status") == [("a",)]
    assert values(grid(df), "health_status") == [("z",)]


def test_seven_days_touch_eight_dates(spark):
    rows = [("s", NOW - n * timedelta(hours=6), "GOOD") for n in range(29)]
    assert len(grid_dates(frame(spark, SCHEMA, rows), "timestamp")) == 8


def test_too_many_days(spark):
    rows = [("s", NOW - n * DAY, "GOOD") for n in range(4)]
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError, match="more than 3 days"):
            grid_dates(frame(spark, SCHEMA, rows), "timestamp")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_cells(spark):
    rows = [("x", "a", "1"), ("z", "b", "6"), ("y", "a", "3"), ("y", "b", "4"), (None, "b", "0")]
    cells = to_cells(frame(spark, "s string, date string, state string", rows), "s", "state")
    assert values(cells, "s", "column_name", "value", "x", "y") == sorted([
        ("x", "a", "1", 0, 2), ("x", "b", "N/A", 1, 2),
        ("y", "a", "3", 0, 1), ("y", "b", "4", 1, 1),
        ("z", "a", "N/A", 0, 0), ("z", "b", "6", 1, 0),
        (None, "a", "N/A", 0, 3), (None, "b", "0", 1, 3),
    ], key=repr)


def test_cells_of_more_days_than_a_wide_grid_holds(spark):
    rows = [(f"s{n % 3}", NOW - n * DAY, "GOOD") for n in range(40)]
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        cells = to_cells(grid(frame(spark, SCHEMA, rows)), "service_name", "health_status")
        assert cells.count() == 3 * 40 and cells.filter("value = 'GOOD'").count() == 40
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


@pytest.mark.parametrize("days, most, wide_table", [(3, 3, True), (4, 3, False), (0, 3, True)])
def test_grid_table_of_any_number_of_days(spark, days, most, wide_table):
    rows = [(f"s{n % 2}", NOW - n * DAY, "GOOD") for n in range(days)]
    df = frame(spark, SCHEMA, rows)
    spark.conf.set("spark.sql.pivotMaxValues", str(most))
    try:
        got = grid_table(df, "service_name", "timestamp", "health_status")
        if wide_table:
            assert got.columns == ["service_name", *grid_dates(df, "timestamp")]
            assert got.count() == min(days, 2)
        else:
            cells = to_cells(grid(df), "service_name", "health_status")
            assert got.columns == cells.columns
            assert values(got, *got.columns) == values(cells, *cells.columns)
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_empty_grid(spark):
    df = frame(spark, SCHEMA, [])
    assert grid_dates(df, "timestamp") == []
    assert wide(df, []).columns == ["service_name"]
    cells = to_cells(grid(df), "service_name", "health_status")
    assert cells.columns == ["service_name", "column_name", "value", "x", "y"]
    assert cells.count() == 0


# --- numbering and locks ---------------------------------------------------


def test_numbers_of_a_hot_value_alone(spark):
    # The order names only the hot column; the other one spreads it.
    df = spark.range(0, 30000, 1, 8).selectExpr("if(id % 3 = 0, 0, id) AS k", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_rows(df, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = sorted((0 if i % 3 == 0 else i, i) for i in range(30000))
    assert [tuple(r) for r in got.orderBy("Index").collect()] == [
        (place, *row) for place, row in enumerate(expected)
    ]
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 10000


def test_equal_rows_are_spread(spark):
    df = spark.range(0, 40000, 1, 8).selectExpr("1 AS k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_rows(df, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.columns == ["Index", "k"]
    assert sorted(r["Index"] for r in got.collect()) == list(range(40000))
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 15000


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_follow_the_order(spark, partitions):
    rng = random.Random(4)
    numbers = rng.sample(range(10**6), 5000)
    df = frame(spark, "n long", [(n,) for n in numbers]).repartition(partitions)
    got = number_rows(df, [F.col("n").desc()], name="place", start=5)
    assert got.columns == ["place", "n"]
    expected = sorted(enumerate(sorted(numbers, reverse=True), 5))
    assert sorted(map(tuple, got.collect())) == expected


def test_numbers_with_a_hot_key(spark):
    # A third of the rows share the first key; the second key spreads them.
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    # AQE would join partitions this small again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = number_rows(df, ["k", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = sorted((str(i) if i % 3 else "hot", i) for i in range(30000))
    assert [tuple(r) for r in got.orderBy("Index").collect()] == [
        (place, *row) for place, row in enumerate(expected)
    ]
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 10000


def test_numbering_nothing(spark):
    assert number_rows(spark.range(0), ["id"]).collect() == []


LOCKS = [
    ("db2", "t1", "agent-a"), ("db2", "t1", "agent-a"),
    ("db1", "t1", "agent-a"),
    ("db1", None, "agent-a"),
    ("db1", "t2", "Unknown"), ("db1", "t2", "unknown"), ("db1", "t2", None),
    (None, "t0", "agent-b"), (None, "t0", "agent-b"),
    ("db1", "T9", "agent-c"),
]


def test_active_locks(spark):
    df = frame(spark, "hl_db string, hl_table string, hl_agent_info string", LOCKS)
    assert active_locks(df).count() == 5
    got = numbered_locks(df)
    assert got.columns == ["Index", "hl_db", "hl_table", "hl_agent_info"]
    assert dict(got.dtypes)["Index"] == "bigint"
    assert [tuple(r) for r in got.orderBy("Index").collect()] == [
        (0, "db1", "T9", "agent-c"),
        (1, None, "t0", "agent-b"),
        (2, "db1", "t1", "agent-a"),
        (3, "db2", "t1", "agent-a"),
        (4, "db1", "t2", "unknown"),
    ]


def test_numbered_locks_agree_with_pandas(spark):
    rng = random.Random(14)
    rows = [
        (
            rng.choice(["d1", "d2", None]),
            rng.choice([None, *[f"t{n}" for n in range(40)]]),
            rng.choice(["Unknown", None, "a", "b", "c"]),
        )
        for _ in range(3000)
    ]
    data = pd.DataFrame(rows, columns=["hl_db", "hl_table", "hl_agent_info"])
    known = data["hl_table"].notna() & data["hl_agent_info"].notna() & (data["hl_agent_info"] != "Unknown")
    kept = data[known].drop_duplicates()
    kept = kept.sort_values(["hl_table", "hl_agent_info", "hl_db"], na_position="first")
    expected = [
        (place, None if pd.isna(db) else db, table, agent)
        for place, (db, table, agent) in enumerate(kept.itertuples(index=False))
    ]
    df = frame(spark, "hl_db string, hl_table string, hl_agent_info string", rows).repartition(6)
    assert [tuple(r) for r in numbered_locks(df).orderBy("Index").collect()] == expected
