"""Histories to which a batch is added once, however often its job is run.

A run writes the rows of its batch to a folder of its own, `attempt=…`, and then
publishes them: a small file named after the batch, which only one run can create,
says which attempt counts. Readers take the attempts that are named there, so that
they see a batch as a whole or not at all, and a repeated job adds nothing.

    HISTORY/attempt=<run>/record_date=<day>/part-….parquet
    HISTORY/_commits/<digest of the batch>.json
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmetrics.schemas import COMMIT_LOG, RECORD_DATE, STATUS_HISTORY
from opsmetrics.session import path_exists, remove_folder
from opsmetrics.sinks.tables import require_values

ATTEMPT = "attempt"
COMMITS = T.StructType(
    [
        T.StructField("batch", T.StringType()), T.StructField("attempt", T.StringType()),
        T.StructField("rows", T.LongType()), T.StructField("committed_at", T.StringType()),
        T.StructField("number", T.LongType()), T.StructField("days", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class Commit:
    """What the log says about a batch: its attempt, rows and record dates, and a
    number where its writer orders batches."""

    batch: str
    attempt: str
    rows: int
    committed_at: str
    number: int = 0
    days: tuple[str, ...] = ()


def _place(spark: SparkSession, path: str):
    """The path as Hadoop's class, and the file context that reaches it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark._jsc.hadoopConfiguration()
    place = place.getFileSystem(configuration).makeQualified(place)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        place.toUri(), configuration
    )
    return place, context


def _log(history: str) -> str:
    return f"{history.rstrip('/')}/{COMMIT_LOG}"


def _entry(history: str, batch: str) -> str:
    return f"{_log(history)}/{hashlib.sha256(batch.encode()).hexdigest()}.json"


def committed(spark: SparkSession, history: str, batch: str) -> Commit | None:
    """The commit of a batch, or None."""
    place, context = _place(spark, _entry(history, batch))
    if not context.util().exists(place):
        return None
    stream = context.open(place)
    try:
        content = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    entry = json.loads(content)
    return Commit(**{**entry, "days": tuple(entry["days"])})


@dataclass(frozen=True)
class Attempt:
    """A batch that was written but does not count yet."""

    name: str
    rows: int
    days: tuple[str, ...]


def write_attempt(df: DataFrame, history: str, ts: str, rebalance: bool = False) -> Attempt:
    """Write the rows of a batch beside the history, unseen by its readers. Rows and
    record dates are taken down while they are written."""
    # From here on readers of the folder go by the log, even while it is empty.
    log, _ = _place(df.sparkSession, _log(history))
    log.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).mkdirs(log)
    attempt = uuid.uuid4().hex
    counted = Observation("rows")
    rows = df.withColumn(RECORD_DATE, F.to_date(ts))
    if rebalance:
        rows = rows.hint("rebalance", F.col(RECORD_DATE))
    day = F.col(RECORD_DATE).cast("string")
    (
        rows.observe(counted, F.count(F.lit(1)).alias("rows"), F.collect_set(day).alias("days"))
        .write.partitionBy(RECORD_DATE).parquet(_attempt_folder(history, attempt))
    )
    return Attempt(attempt, counted.get["rows"], tuple(sorted(counted.get["days"])))


def _attempt_folder(history: str, attempt: str) -> str:
    return f"{history.rstrip('/')}/{ATTEMPT}={attempt}"


def publish(
    spark: SparkSession, history: str, batch: str, attempt: Attempt, number: int = 0
) -> Commit:
    """Make the attempt the one that counts for its batch, unless another run was
    first; returns the commit that holds.

    The entry is written aside and renamed, which fails if there is one
    already. So no reader finds half an entry, and of two runs one wins.
    """
    now = datetime.now(timezone.utc).isoformat()
    found = Commit(batch, attempt.name, attempt.rows, now, number, attempt.days)
    target, context = _place(spark, _entry(history, batch))
    aside, _ = _place(spark, f"{target.getParent().toString()}/.{attempt.name}")
    system = aside.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(asdict(found)).encode()))
    finally:
        stream.close()
    kinds = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    try:
        context.rename(aside, target, options)
    except Exception:
        system.delete(aside, False)
        before = committed(spark, history, batch)
        if before is None:
            raise
        return before
    return found


def commit_batch(
    df: DataFrame, history: str, batch: str, ts: str, rebalance: bool = False, number: int = 0
) -> Commit:
    """Add a batch to the history, once.

    `batch` names it, for example by the folder it was landed in; a batch that is
    in the log is not even read again. A run that fails or is killed leaves the
    history as it was; its files stay unseen until `drop_uncommitted`.
    """
    spark = df.sparkSession
    if (before := committed(spark, history, batch)) is not None:
        return before
    attempt = write_attempt(df, history, ts, rebalance)
    commit = publish(spark, history, batch, attempt, number)
    if commit.attempt != attempt.name:
        remove_folder(spark, _attempt_folder(history, attempt.name))
    return commit


def commit_metrics(
    df: DataFrame, history: str, batch: str, ts: str = "datetime_record", rebalance: bool = False
) -> Commit:
    """Add host metrics once."""
    return commit_batch(df, history, batch, ts, rebalance)


def commit_status(df: DataFrame, history: str, batch: str, rebalance: bool = False) -> Commit:
    """Add service states once; a row without one of the three columns fails the
    run, and nothing of the batch is seen."""
    names = STATUS_HISTORY.fieldNames()
    checked = require_values(df.select(*names), *names)
    return commit_batch(checked, history, batch, "timestamp", rebalance)


def has_log(spark: SparkSession, history: str) -> bool:
    return path_exists(spark, _log(history))


def commit_log(spark: SparkSession, history: str) -> DataFrame:
    """(batch, attempt, rows, committed_at, number, days) of every committed batch;
    none if there is no log yet."""
    if not has_log(spark, history):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).json(_log(history))


def read_committed(spark: SparkSession, history: str, schema: T.StructType) -> DataFrame:
    """The rows of the committed batches, with their date partition.

    The attempts are folders, so Spark's dynamic partition pruning, which wants a
    filter on the log, drops those that are not in it before a file of theirs
    is opened.
    """
    log = commit_log(spark, history).filter("rows > 0").select(F.col("attempt").alias("_counts"))
    kept = [*schema.fieldNames(), RECORD_DATE]
    stored = T.StructType([
        *schema, T.StructField(ATTEMPT, T.StringType()), T.StructField(RECORD_DATE, T.DateType())
    ])
    rows = spark.read.schema(stored).parquet(history)
    return rows.join(log, rows[ATTEMPT] == log["_counts"], "left_semi").select(*kept)


def drop_uncommitted(spark: SparkSession, history: str, before: datetime) -> list[str]:
    """Remove attempts that count for no batch and were last written before the
    instant `before`, and return their names. A run under way must be younger.

    An attempt published meanwhile is safe: the log is read after the folders.
    """
    limit = before.astimezone(timezone.utc).timestamp() * 1000
    place, context = _place(spark, history)
    old = {}
    for status in context.util().listStatus(place):
        name = status.getPath().getName()
        if name.startswith(f"{ATTEMPT}=") and status.getModificationTime() < limit:
            old[name.split("=", 1)[1]] = status.getPath().toString()
    counts = {r["attempt"] for r in commit_log(spark, history).select("attempt").collect()}
    for attempt in sorted(old.keys() - counts):
        remove_folder(spark, old[attempt])
    return sorted(old.keys() - counts)
