"""The latest row of each key, kept up to date as rows arrive.

A stream keeps one row per key in Spark's state store and writes down what changes:
a newer row, or that a key has had none for the length of the window and goes. The
window ends at the latest time that was seen, so that a replay gives the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from opsmetrics.operators.history import latest_per_key

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Of a change: whether its key goes.
GONE = "gone"
# The time of a row for Spark's watermark, and the same in milliseconds for the timer.
EVENT_TIME, MILLISECONDS = "_event_time", "_milliseconds"


@contextmanager
def changed_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _order(row: dict, names: Sequence[str]) -> tuple:
    """What rows are compared by: a missing value is the least."""
    return tuple((row[n] is not None, row[n]) for n in names)


def newest_of_batches(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key of each batch of rows that a task reads, so that a key
    that holds most of the rows sends few of them to the task that keeps it."""
    names, keys = rows.columns, list(keys)

    def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple, tuple] = {}
            own = batch.select(keys).to_pylist()
            for at, (key, row) in enumerate(zip(own, batch.select(list(order)).to_pylist())):
                place = tuple(key.values())
                value = _order(row, order)
                if place not in best or value > best[place][0]:
                    best[place] = (value, at)
            if best:
                yield batch.take(pa.array([at for _, at in best.values()])).select(names)

    return rows.mapInArrow(newest, rows.schema)


class LatestRow(StatefulProcessor):
    """One row per key, with a timer for the moment that it leaves the window."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], order: Sequence[str]):
        self.schema, self.keys, self.order = schema, list(keys), list(order)
        self.rest = [n for n in schema.fieldNames() if n not in self.keys]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kept = [*[self.schema[n] for n in self.rest], T.StructField(MILLISECONDS, T.LongType())]
        self.latest = handle.getValueState("latest", T.StructType(kept))

    def _kept(self) -> dict:
        return dict(zip([*self.rest, MILLISECONDS], self.latest.get()))

    def _changed(self, key: tuple, row: dict, gone: bool) -> Row:
        values = {**row, **dict(zip(self.keys, key)), GONE: gone}
        names = [*self.schema.fieldNames(), GONE]
        return Row(*names)(*[values[n] for n in names])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = max((row.asDict() for row in rows), key=lambda r: _order(r, self.order))
        if self.latest.exists():
            kept = self._kept()
            if _order(newest, self.order) <= _order(kept, self.order):
                return
            self.handle.deleteTimer(kept[MILLISECONDS])
        self.latest.update(tuple(newest[n] for n in [*self.rest, MILLISECONDS]))
        self.handle.registerTimer(newest[MILLISECONDS])
        yield self._changed(key, newest, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self._kept()
        self.latest.clear()
        yield self._changed(key, kept, True)

    def close(self) -> None:
        pass


def latest_changes(
    rows: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = (), days: int = 7
) -> DataFrame:
    """A stream of rows -> a stream of changes of the latest row per key.

    Every change has the columns of the rows and `gone`: the key had no row within
    the last `days` x 24 hours before the latest time seen, and the row is the one
    that it had. Rows that are older than that when they arrive are passed over, as
    are rows without key or time. Equal times are settled as by `latest_per_key`: by the
    tie-break and then by the other columns, a missing value being the least.

    Times count in whole milliseconds here, as Spark's watermark does.
    """
    order = [ts, *tiebreak, *[c for c in rows.columns if c not in [*keys, ts, *tiebreak]]]
    for name in [*keys, ts]:
        rows = rows.filter(F.col(name).isNotNull())
    schema = rows.schema
    event_time = F.col(ts).cast("timestamp")
    timed = newest_of_batches(rows, keys, order).withColumns(
        {EVENT_TIME: event_time, MILLISECONDS: F.unix_millis(event_time)}
    )
    changed = T.StructType([*schema, T.StructField(GONE, T.BooleanType())])
    # What lies on the edge of the window belongs to it; Spark drops what is not
    # after the watermark.
    delay = f"{int(days) * 86_400_000 + 1} milliseconds"
    return (
        timed.withWatermark(EVENT_TIME, delay)
        .groupBy(*keys)
        .transformWithState(
            LatestRow(schema, keys, order), changed, outputMode="append", timeMode="EventTime"
        )
    )


def keep_latest(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    target: str,
    checkpoint: str,
    tiebreak: Sequence[str] = (),
    days: int = 7,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start a run that takes the rows landed since the last one, exactly once, and
    adds the changes to the folder `target`, which the stream owns.

    The state is held in so many `partitions` (of the first run; by default as many
    as shuffles have), each in the store on local disk that Spark calls RocksDB.
    """
    changes = latest_changes(rows, keys, ts, tiebreak, days)
    settings = {STATE_STORE: ROCKS_DB}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    # A stream keeps the settings it is started with.
    with changed_settings(rows.sparkSession, settings):
        return (
            changes.writeStream.format("parquet").outputMode("append")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def read_latest(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The rows that `keep_latest` holds for now: of each key the last change,
    unless that says that the key has gone. `schema` is that of the rows.

    Changes need no number: each is greater than the one before in the order of
    the rows, and a key goes with the row that it had.
    """
    changes = spark.read.schema(T.StructType([*schema, T.StructField(GONE, T.BooleanType())]))
    last = latest_per_key(changes.parquet(target), keys, ts, tiebreak)
    return last.filter(~F.col(GONE)).drop(GONE)
