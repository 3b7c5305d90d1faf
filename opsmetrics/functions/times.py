"""Times: explicit report instant, day-first text, pinned report hour."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_FIRST = r"\A(\d{1,2})-(\d{1,2})-(\d{4}) (\d{1,2}):(\d{1,2})\z"


def as_of_column(as_of: datetime | Column | None, naive: bool) -> Column:
    """The report instant as a constant, so that filters on it reach the scan.

    `naive` says whether it is compared with TIMESTAMP_NTZ (wall-clock) or
    TIMESTAMP columns. None means now; a naive datetime is wall-clock time of
    the session zone.
    """
    if as_of is None:
        return F.localtimestamp() if naive else F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if as_of.tzinfo is not None:
        text = as_of.astimezone(timezone.utc).replace(tzinfo=None).isoformat(" ")
        instant = F.expr(f"TIMESTAMP_LTZ '{text} UTC'")
        return instant.cast("timestamp_ntz") if naive else instant
    kind = "TIMESTAMP_NTZ" if naive else "TIMESTAMP_LTZ"
    return F.expr(f"{kind} '{as_of.isoformat(' ')}'")


def is_naive(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def parse_day_first(text: Column) -> Column:
    """`d-M-yyyy H:m` text -> TIMESTAMP_NTZ; text that does not match is NULL.

    Leading zeros are optional, as the day-first input has both spellings. The
    text is put in ISO order and cast, so no time zone and none of its clock
    changes are involved.
    """
    iso = F.regexp_replace(text, DAY_FIRST, "$3-$2-$1 $4:$5")
    return F.when(text.rlike(DAY_FIRST), iso.try_cast("timestamp_ntz"))


def pin_report_hour(ts: Column, hour: int = 8) -> Column:
    """The day of `ts` at a fixed hour; stays wall-clock time."""
    return F.to_date(ts).cast("timestamp_ntz") + F.expr(f"INTERVAL '{int(hour)}' HOUR")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")
