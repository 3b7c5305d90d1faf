"""The live latest rows against the batch operators on all rows so far."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsmetrics.operators.history import latest_per_key, recent
from opsmetrics.streaming.live import (
    STATE_STORE,
    keep_latest,
    newest_of_batches,
    read_latest,
)

SCHEMA = "host string, zone bigint, ts timestamp_ntz, n bigint, load double, note string"
START = datetime(2024, 3, 29)


class Live:
    """A landing folder, the stream over it, and all rows landed so far."""

    def __init__(self, spark, folder, days=7, schema=SCHEMA, keys=("host", "zone"), tiebreak=("n",)):
        self.spark, self.days, self.keys, self.tiebreak = spark, days, list(keys), list(tiebreak)
        self.landing, self.target, self.progress = (f"{folder}/{n}" for n in ("in", "live", "progress"))
        self.empty = spark.createDataFrame([], schema)
        self.rows = []

    def land(self, rows, files=1):
        self.rows += rows
        landed = self.spark.createDataFrame(rows, self.empty.schema)
        landed.repartition(files).write.mode("append").parquet(self.landing)

    def run(self, files_per_batch=1):
        stream = self.spark.readStream.schema(self.empty.schema).option(
            "maxFilesPerTrigger", files_per_batch
        ).parquet(self.landing)
        run = keep_latest(
            stream, self.keys, "ts", self.target, self.progress, self.tiebreak, self.days, partitions=3
        )
        run.awaitTermination()

    def found(self):
        live = read_latest(self.spark, self.target, self.empty.schema, self.keys, "ts", self.tiebreak)
        return sorted((tuple(r) for r in live.collect()), key=repr)

    def expected(self):
        rows = self.spark.createDataFrame(self.rows, self.empty.schema)
        newest = rows.agg(F.max("ts")).first()[0]
        batch = latest_per_key(recent(rows, "ts", newest, self.days), self.keys, "ts", self.tiebreak)
        return sorted((tuple(r) for r in batch.collect()), key=repr)


def test_many_small_files_and_a_restart(spark, tmp_path):
    """Rows in any order within the window, one host with a third of them."""
    pick = random.Random(5)
    live = Live(spark, tmp_path)
    for run in range(3):
        rows = [
            (
                "hot" if pick.random() < 0.3 else f"h{pick.randrange(40)}", pick.randrange(2),
                START + timedelta(days=4 * run, minutes=pick.randrange(3 * 1440)),
                pick.randrange(10), pick.random(), pick.choice([None, "x", "y"]),
            )
            for _ in range(200)
        ]
        live.land(rows, files=5)
        live.run(files_per_batch=2)
        assert live.found() == live.expected()
    assert 0 < len(live.found()) < 82


def at(**ago):
    return START + timedelta(days=20) - timedelta(**ago)


def test_edges_of_the_window(spark, tmp_path):
    live = Live(spark, tmp_path)
    live.land([
        ("edge", 1, at(days=7), 1, 0.0, None),
        ("outside", 1, at(days=7, milliseconds=1), 1, 0.0, None),
        ("old", 1, at(days=9), 1, 0.0, None),
        ("inside", 1, at(days=6), 1, 0.0, None),
    ])
    live.run()
    live.land([("newest", 1, at(), 1, 0.0, None)])
    live.run()
    assert live.found() == live.expected()
    assert [r[0] for r in live.found()] == ["edge", "inside", "newest"]


def test_late_rows(spark, tmp_path):
    """Late ones within the window count if they are the newest of their key."""
    live = Live(spark, tmp_path)
    live.land([("newest", 1, at(), 1, 0.0, None), ("a", 1, at(days=2), 1, 0.0, None)])
    live.run()
    live.land([
        ("a", 1, at(days=3), 9, 9.0, "older"), ("b", 1, at(days=7), 1, 0.0, "on the edge"),
        ("c", 1, at(days=8), 1, 0.0, "too late"),
    ])
    live.run()
    assert live.found() == live.expected()
    assert [r[0] for r in live.found()] == ["a", "b", "newest"]


def test_host_that_comes_back(spark, tmp_path):
    live = Live(spark, tmp_path)
    for day, host in enumerate("abbaaba"):
        live.land([(host, 1, START + timedelta(days=5 * day), 1, float(day), None)])
        live.run()
        assert live.found() == live.expected()
    changes = spark.read.parquet(live.target)
    assert changes.filter("gone").count() == 2
    live.run()  # nothing new: nothing changes
    assert spark.read.parquet(live.target).count() == changes.count()


def test_ties_repeats_and_missing_values(spark, tmp_path):
    live = Live(spark, tmp_path)
    t = START
    live.land([("a", 1, t, None, None, "b"), ("a", 1, t, None, None, "a"), ("a", 1, t, None, 0.5, None)], 3)
    live.land([("b", 1, t, 1, None, None), ("b", 1, t, 2, None, None), ("b", 1, t, 2, None, None)], 3)
    live.land([(None, 1, t, 1, 1.0, None), ("c", None, t, 1, 1.0, None), ("d", 1, None, 1, 1.0, None)], 1)
    live.run()
    assert live.found() == live.expected()
    assert live.found() == [("a", 1, t, None, 0.5, None), ("b", 1, t, 2, None, None)]
    # The same rows once more change nothing, and large numbers stay exact.
    live.land([("b", 1, t, 1, None, None), ("a", 1, t, 2**62 + 1, None, None)])
    live.run()
    assert live.found() == live.expected()
    assert live.found()[0][3] == 2**62 + 1


def test_no_rows(spark, tmp_path):
    live = Live(spark, tmp_path)
    live.land([])
    live.run()
    assert live.found() == []


def test_instants(spark, tmp_path):
    """Times with a zone, and a state store setting that is left as it was."""
    live = Live(spark, tmp_path, 1, "host string, ts timestamp", ["host"], ())
    live.land([("a", datetime(2024, 3, 30, 12)), ("b", datetime(2024, 3, 31, 12, 0, 0, 1000))])
    before = spark.conf.get(STATE_STORE)
    live.run()
    assert spark.conf.get(STATE_STORE) == before
    assert live.found() == live.expected() == [("b", datetime(2024, 3, 31, 12, 0, 0, 1000))]


@pytest.mark.parametrize("rows", [0, 1, 500])
def test_tasks_send_one_row_per_key_and_batch(spark, rows):
    df = spark.range(rows).selectExpr("'hot' AS host", "id AS n", "id % 7 AS other").coalesce(1)
    found = newest_of_batches(df, ["host"], ["n", "other"]).collect()
    assert [r.n for r in found] == ([rows - 1] if rows else [])
