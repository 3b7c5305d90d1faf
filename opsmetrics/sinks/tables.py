"""Append-only histories and report tables.

A target is a folder of Parquet files (any text with a slash), the name of a
catalog table, or a mapping of JDBC options. A repeated job appends its rows again;
`sinks.commits` adds a batch once.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from opsmetrics.schemas import BROKEN, COMMIT_LOG, RECORD_DATE, STATUS_HISTORY
from opsmetrics.session import path_exists, remove_folder

Target = str | Mapping[str, str]

REPORT_NAME_FORMAT = "%Y-%m-%d_%H-%M-%S"


def _append(df: DataFrame, target: Target, ts: str, rebalance: bool) -> int:
    """Append with a date partition and return the number of rows written.

    The rows are counted while they are written, in the writing stage itself,
    where a repeated task counts once. An empty batch writes no data file, so
    no check has to run the query a second time.
    """
    counted = Observation("rows")
    rows = F.count(F.lit(1)).alias("rows")
    if not isinstance(target, str):
        df.observe(counted, rows).write.format("jdbc").options(**target).mode("append").save()
        return counted.get["rows"]
    if "/" in target and path_exists(df.sparkSession, f"{target.rstrip('/')}/{COMMIT_LOG}"):
        raise ValueError(f"{target} has a commit log: add to it by batches")
    df = df.withColumn(RECORD_DATE, F.to_date(ts))
    if rebalance:
        df = df.hint("rebalance", F.col(RECORD_DATE))
    writer = df.observe(counted, rows).write.mode("append").partitionBy(RECORD_DATE)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)
    return counted.get["rows"]


def append_metrics(
    df: DataFrame, target: Target, ts: str = "datetime_record", rebalance: bool = False
) -> int:
    """Append host metrics; the first batch creates the table.

    A batch has one stamp and lands in one date. For a load of many dates set
    `rebalance`: AQE then joins small and splits large dates, so that no task
    writes a file per date and none writes a whole hot date.
    """
    return _append(df, target, ts, rebalance)


def require_values(df: DataFrame, *columns: str) -> DataFrame:
    """Fail the query at a row that lacks one of the columns."""
    return df.withColumns(
        {
            c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is missing"))).otherwise(F.col(c))
            for c in columns
        }
    )


def create_status_table(spark: SparkSession, table: str) -> None:
    """Create the status table, if absent, with its NOT NULL columns."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()} NOT NULL" for f in STATUS_HISTORY
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {RECORD_DATE} DATE) "
        f"USING parquet PARTITIONED BY ({RECORD_DATE})"
    )


def append_status(df: DataFrame, target: Target, rebalance: bool = False) -> int:
    """Append service states. All three columns are required: a row without one
    fails the job. Into a folder or catalog table nothing is written then; over
    JDBC, Spark commits each partition by itself, so others may have been."""
    names = STATUS_HISTORY.fieldNames()
    if isinstance(target, str) and "/" not in target:
        create_status_table(df.sparkSession, target)
    checked = require_values(df.select(*names), *names)
    return _append(checked, target, "timestamp", rebalance)


def write_report(df: DataFrame, path: str, report_ts: datetime) -> int:
    """Keep a report run under its time and return its row count.

    Each run is one `report_ts` partition. A rerun with the same time replaces
    its partition and no other, so a retried job leaves one copy; a report
    without rows leaves none.
    """
    counted = Observation("rows")
    name = report_ts.strftime(REPORT_NAME_FORMAT)
    (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .withColumn("report_ts", F.lit(name))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_ts")
        .parquet(path)
    )
    rows = counted.get["rows"]
    if not rows:
        remove_folder(df.sparkSession, f"{path}/report_ts={name}")
    return rows


def quarantine(lines: DataFrame, path: str) -> int:
    """Append what could not be read (`broken` is not missing) to a folder, and
    return how many lines or documents that were."""
    counted = Observation("broken")
    (
        lines.filter(F.col(BROKEN).isNotNull())
        .select(F.col(BROKEN), F.current_timestamp().alias("found_at"), F.to_json(
            F.struct(*[c for c in lines.columns if c != BROKEN])
        ).alias("read_as"))
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("append").parquet(path)
    )
    return counted.get["rows"]
