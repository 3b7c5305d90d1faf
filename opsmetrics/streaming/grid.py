"""The service grid, kept up to date: polls go into the days that they belong to.

Every run of the stream writes the days that its polls touch anew, whole and beside
the old ones, and then publishes them in the log of the folder. Late polls change the
days they are from; all other days stay as they are, and are not even read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from opsmetrics.operators.history import latest_per_key
from opsmetrics.schemas import RECORD_DATE
from opsmetrics.sinks.commits import (
    ATTEMPT,
    commit_batch,
    commit_log,
    committed,
    has_log,
)


def day_versions(spark: SparkSession, folder: str) -> DataFrame:
    """(day, attempt, number): of each day the folder that holds it now, one row per day."""
    held = commit_log(spark, folder).select(
        "attempt", "number", F.explode(F.col("days").cast("array<date>")).alias("day")
    )
    newest = F.max(F.struct("number", "attempt")).alias("_newest")
    return held.groupBy("day").agg(newest).select("day", "_newest.attempt", "_newest.number")


def read_grid(
    spark: SparkSession, folder: str, schema: T.StructType, days: Sequence[str] | None = None
) -> DataFrame:
    """The newest poll of each key and day, with its `record_date`; of all `days`
    (`yyyy-MM-dd`), or of some.

    Folders of other days and of versions that were replaced are pruned.
    """
    if not has_log(spark, folder):
        return spark.createDataFrame([], T.StructType([*schema, T.StructField(RECORD_DATE, T.DateType())]))
    versions = day_versions(spark, folder)
    if days is not None:
        versions = versions.filter(F.col("day").cast("string").isin(list(days)))
    else:
        # Dynamic pruning wants a filter; numbers start at one.
        versions = versions.filter("number > 0")
    stored = T.StructType([
        *schema, T.StructField(ATTEMPT, T.StringType()), T.StructField(RECORD_DATE, T.DateType())
    ])
    rows = spark.read.schema(stored).parquet(folder)
    held = (rows[ATTEMPT] == versions["attempt"]) & (rows[RECORD_DATE] == versions["day"])
    return rows.join(versions.drop("number"), held, "left_semi").drop(ATTEMPT)


def merge_polls(
    polls: DataFrame,
    folder: str,
    batch: str,
    key: str,
    ts: str,
    tiebreak: Sequence[str] = (),
) -> Sequence[str]:
    """Bring the polls of a batch into the grid, once, and return the days it changed.

    Of several polls of a key on a day the latest stays, by `ts`, then the
    tie-break, then the other columns; polls without key or time have no cell.
    So the order in which batches arrive does not matter. A batch in the log is
    not read again; one that was broken off leaves the grid as it was. One writer
    at a time.
    """
    spark, schema = polls.sparkSession, polls.schema
    if (before := committed(spark, folder, batch)) is not None:
        return before.days
    dated = polls.withColumn(RECORD_DATE, F.to_date(ts))
    new = latest_per_key(dated, [key, RECORD_DATE], ts, tiebreak)
    # One row per day of the batch.
    days = [r[0] for r in new.select(F.col(RECORD_DATE).cast("string")).distinct().collect()]
    old = read_grid(spark, folder, schema, days)
    number = commit_log(spark, folder).agg(F.max("number")).first()[0] or 0
    merged = latest_per_key(old.unionByName(new), [key, RECORD_DATE], ts, tiebreak)
    found = commit_batch(
        merged.select(*schema.fieldNames()), folder, batch, ts, rebalance=True, number=number + 1
    )
    return found.days


def keep_grid(
    polls: DataFrame,
    folder: str,
    checkpoint: str,
    key: str,
    ts: str,
    tiebreak: Sequence[str] = (),
) -> StreamingQuery:
    """Start a run that brings the polls landed since the last one into the grid. A
    batch is named by its checkpoint and number, so one that is repeated after a
    failure changes nothing twice."""

    def merge(batch: DataFrame, number: int) -> None:
        merge_polls(batch, folder, f"{checkpoint}#{number}", key, ts, tiebreak)

    return (
        polls.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


