"""Operators on time-stamped histories."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmetrics.functions.times import as_of_column, is_naive, minute_text

# Dates of one instant in two time zones differ by so many days at most.
ZONE_DAYS = 2

# Types of which Spark can keep the greatest in a hash table.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def stamp(
    df: DataFrame,
    name: str,
    as_of: datetime | Column | None = None,
    naive: bool = True,
) -> DataFrame:
    """Add one collection time for the whole batch."""
    return df.withColumn(name, as_of_column(as_of, naive))


def recent(
    df: DataFrame,
    ts: str,
    as_of: datetime | Column | None = None,
    days: int = 7,
    date_column: str | None = None,
) -> DataFrame:
    """Rows of the last `days` x 24 hours before `as_of`, the bound included.

    There is no upper bound: rows stamped in the future stay. The cutoff is a
    constant, so it reaches the scan; with `date_column`, the date partition
    column of the history, older partitions are not listed at all. The writer
    may have taken its dates in another time zone: they differ from the dates
    here by two days at most, and so much more is read.
    """
    cutoff = as_of_column(as_of, is_naive(df, ts)) - F.expr(f"INTERVAL '{int(days)}' DAY")
    kept = F.col(ts) >= cutoff
    if date_column:
        kept = kept & (F.col(date_column) >= F.date_sub(F.to_date(cutoff), ZONE_DAYS))
    return df.filter(kept)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: Sequence[str] = (),
    unique_times: bool = False,
) -> DataFrame:
    """The row with the greatest `ts` per key; rows without key or time drop out.

    Equal times are settled by the greatest `tiebreak`, then by the other
    columns in their order, a missing value being the least.

    One row per key leaves each map task, so a key holding most of the rows
    shuffles no more than any other. A row travels as its own sort key:
    `max_by` of a struct would carry its time and tie-break twice. Where the
    caller knows that no key has a time twice (`unique_times`), numbers and
    times are kept per column in a hash table, without sorting the rows.
    """
    keys = list(keys)
    order = [ts, *tiebreak]
    rest = [c for c in df.columns if c not in keys and c not in order]
    for name in [*keys, ts]:
        df = df.filter(F.col(name).isNotNull())
    rows = df.groupBy(*keys)
    fixed = all(isinstance(f.dataType, FIXED_WIDTH) for f in df.schema if f.name in rest)
    if fixed and unique_times:
        newest = rows.agg(F.max(ts).alias(ts), *[F.max_by(c, ts).alias(c) for c in rest])
    else:
        whole = rows.agg(F.max(F.struct(*order, *rest)).alias("_latest"))
        newest = whole.select(*keys, "_latest.*")
    return newest.select(*df.columns)


def latest_snapshot(
    df: DataFrame,
    sheet: str,
    ts: str,
    lead_sheet: str,
) -> DataFrame:
    """Rows of all sheets taken at the latest time *of the lead sheet*.

    A sheet without that minute gives no row. The maximum is a scalar
    subquery: one partial value per task, and Spark compares the scan with the
    finished value. `ts` becomes `yyyy-MM-dd HH:mm` text.
    """
    lead_time = df.filter(F.col(sheet) == lead_sheet).select(F.max(ts)).scalar()
    return df.filter(F.col(ts) == lead_time).withColumn(ts, minute_text(F.col(ts)))
