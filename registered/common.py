"""Shared by the registered queries."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsmetrics.session import checkpoint_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def last_instant(events: DataFrame) -> datetime:
    """The greatest time in the table: the `as_of` of the window queries."""
    return events.agg(F.max("ts")).first()[0]


def landing(spark: SparkSession, name: str) -> str:
    """A new folder for files a query writes and reads back."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


# The window of the last seven days, for the SQL side.
RECENT_SQL = """
    SELECT * FROM events
    WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
"""
