"""Histories and the lock table: a folder, a catalog table or a database.

A source is a folder of Parquet files (any text with a slash), the name of a
catalog table, or a mapping of JDBC options. Only the declared columns are
selected, so nothing else is read. Of a folder with a commit log only the committed
batches are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from opsmetrics.schemas import LOCKS, METRIC_HISTORY, RECORD_DATE, STATUS_HISTORY
from opsmetrics.sinks.commits import has_log, read_committed

Source = str | Mapping[str, str]


def open_source(spark: SparkSession, source: Source, schema: T.StructType) -> DataFrame:
    """The declared columns, and the date partition where there is one.

    A folder is read with the declared schema: no file is opened to infer it,
    and a folder without data yet is an empty table.
    """
    if not isinstance(source, str):
        df = spark.read.format("jdbc").options(**source).load()
    elif "/" in source:
        if has_log(spark, source):
            return read_committed(spark, source, schema)
        df = spark.read.schema(schema).parquet(source)
    else:
        df = spark.table(source)
    kept = schema.fieldNames()
    return df.select(*kept, *[c for c in [RECORD_DATE] if c in df.columns])


def read_metric_history(spark: SparkSession, source: Source) -> DataFrame:
    """The nine metric columns, and the date partition where there is one."""
    return open_source(spark, source, METRIC_HISTORY)


def read_status_history(spark: SparkSession, source: Source) -> DataFrame:
    """Service, state and time, and the date partition where there is one."""
    return open_source(spark, source, STATUS_HISTORY)


def read_locks(spark: SparkSession, source: Source) -> DataFrame:
    """The three lock columns. Over JDBC the filter of `active_locks` runs in
    the database; `partitionColumn` and its bounds split a large table."""
    return open_source(spark, source, LOCKS)
