"""The kept grid against the grid of all polls so far."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsmetrics.operators.grid import status_grid, to_cells
from opsmetrics.sinks import commits
from opsmetrics.streaming.grid import day_versions, keep_grid, merge_polls, read_grid

SCHEMA = "service_name string, health_status string, timestamp timestamp_ntz"
START = datetime(2024, 3, 1)
KEY, TS = "service_name", "timestamp"


def polls(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def cells(df):
    found = status_grid(df, KEY, TS, "health_status")
    return sorted((tuple(r) for r in found.collect()), key=repr)


def some(pick, count, days=6):
    return [
        (f"s{pick.randrange(8)}", pick.choice(["GOOD", "BAD", None]),
         START + timedelta(minutes=pick.randrange(days * 1440)))
        for _ in range(count)
    ]


def kept(spark, folder):
    return read_grid(spark, folder, polls(spark, []).schema)


def test_batches_in_any_order(spark, tmp_path):
    pick, folder, rows = random.Random(2), str(tmp_path / "grid"), []
    for number in range(4):
        batch = some(pick, 40)
        rows += batch
        merge_polls(polls(spark, batch), folder, f"b{number}", KEY, TS)
        assert cells(kept(spark, folder)) == cells(polls(spark, rows).filter(f"{KEY} IS NOT NULL"))


def test_stream_with_late_polls_and_a_restart(spark, tmp_path):
    pick, rows = random.Random(3), []
    landing, folder, progress = (str(tmp_path / n) for n in ("in", "grid", "progress"))
    for days in (2, 6, 3):
        batch = some(pick, 60, days)
        rows += batch
        polls(spark, batch).repartition(3).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(polls(spark, []).schema).option("maxFilesPerTrigger", 1)
        keep_grid(stream.parquet(landing), folder, progress, KEY, TS).awaitTermination()
        assert cells(kept(spark, folder)) == cells(polls(spark, rows))


def test_only_the_days_of_a_batch_are_written(spark, tmp_path):
    folder = str(tmp_path / "grid")
    day = lambda n: START + timedelta(days=n, hours=8)
    merge_polls(polls(spark, [("a", "GOOD", day(n)) for n in range(4)]), folder, "first", KEY, TS)
    before = {r.day: r.attempt for r in day_versions(spark, folder).collect()}
    late = [("a", "BAD", day(1) + timedelta(hours=1)), ("b", "GOOD", day(1)), ("a", "OLD", day(2) - timedelta(hours=1))]
    changed = merge_polls(polls(spark, late), folder, "late", KEY, TS)
    after = {r.day: r.attempt for r in day_versions(spark, folder).collect()}
    assert list(changed) == ["2024-03-02", "2024-03-03"]
    assert {d.isoformat() for d in after if after[d] != before[d]} == set(changed)
    assert cells(kept(spark, folder)) == [
        ("a", "2024-03-01", "GOOD"), ("a", "2024-03-02", "BAD"), ("a", "2024-03-03", "GOOD"),
        ("a", "2024-03-04", "GOOD"), ("b", "2024-03-02", "GOOD"),
    ]
    one = read_grid(spark, folder, polls(spark, []).schema, ["2024-03-04"])
    assert [r.record_date.isoformat() for r in one.collect()] == ["2024-03-04"]


def test_broken_off_and_repeated_batches(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "grid")
    first, second = [("a", "GOOD", START)], [("a", "BAD", START + timedelta(hours=1)), ("b", "BAD", START)]
    merge_polls(polls(spark, first), folder, "1", KEY, TS)
    with monkeypatch.context() as patch:
        patch.setattr(commits, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            merge_polls(polls(spark, second), folder, "2", KEY, TS)
    assert cells(kept(spark, folder)) == [("a", "2024-03-01", "GOOD")]
    for _ in range(2):
        merge_polls(polls(spark, second), folder, "2", KEY, TS)
        merge_polls(polls(spark, first), folder, "1", KEY, TS)
        assert cells(kept(spark, folder)) == [("a", "2024-03-01", "BAD"), ("b", "2024-03-01", "BAD")]
    assert commits.commit_log(spark, folder).count() == 2


def test_missing_values_ties_and_no_rows(spark, tmp_path):
    folder = str(tmp_path / "grid")
    assert kept(spark, folder).count() == 0
    rows = [(None, "BAD", START), ("a", "BAD", None), ("a", None, START), ("b", "X", START), ("b", "Y", START)]
    merge_polls(polls(spark, rows), folder, "1", KEY, TS)
    assert merge_polls(polls(spark, []), folder, "2", KEY, TS) == ()
    assert cells(kept(spark, folder)) == [("a", "2024-03-01", "N/A"), ("b", "2024-03-01", "Y")]


def test_columns_that_belong_to_others(spark, tmp_path):
    """Names that the merge and the log use themselves, but for the partition's."""
    folder, names = str(tmp_path / "grid"), ["number", "day", "days", "batch", "rows", "_latest"]
    df = polls(spark, [("a", "GOOD", START)]).select("*", *[F.lit(n).alias(n) for n in names])
    merge_polls(df, folder, "1", KEY, TS)
    merge_polls(df, folder, "2", KEY, TS)
    found = read_grid(spark, folder, df.schema).select(*df.columns).collect()
    assert [tuple(r) for r in found] == [("a", "GOOD", START, *names)]


def test_dense_cells_hold_no_arrays(spark):
    """Every service on every day, from dictionaries: no aggregate collects."""
    rows = some(random.Random(4), 50) + [(None, "GOOD", START)]
    grid = status_grid(polls(spark, rows), KEY, TS, "health_status")
    dense = to_cells(grid, KEY, "health_status")
    plan = dense._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_" not in plan
    states = {(r[0], r[1]): r[2] for r in grid.collect()}
    days, keys = sorted({d for _, d in states}), sorted({k for k, _ in states}, key=lambda k: (k is None, k or ""))
    found = {(r[KEY], r["column_name"]): (r["value"], r["x"]) for r in dense.collect()}
    assert found == {(k, d): (states.get((k, d), "N/A"), x) for k in keys for x, d in enumerate(days)}


