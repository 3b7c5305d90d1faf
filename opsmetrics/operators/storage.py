"""Two counters out of storage reports, and their shares.

A report is read top down. Every match of a pattern replaces its counter, and
the report is done at the first line after which both counters hold digits;
later lines are ignored. A capture of commas alone replaces the counter but
holds no digits. A report that never gets there gives no row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsmetrics.fixed_values import REMAINING_PATTERN, USED_PATTERN
from opsmetrics.functions.numbers import bytes_to_tb, round_half_even

# Everything that ends a line: \R, and the three information separators.
LINE_BREAK = r"\R|[\x1c\x1d\x1e]"
RARE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# Lines per piece when a report is scanned line by line.
PIECE_LINES = 1 << 16


def split_lines(text: Column) -> Column:
    """The lines of a text. Splitting at one character is several times faster
    than at a pattern, so the pattern is for texts that need it."""
    rare = reduce(or_, [text.contains(mark) for mark in RARE_BREAKS])
    return F.when(rare, F.split(text, LINE_BREAK, -1)).otherwise(F.split(text, "\n", -1))


def _capture(line: Column, pattern: str) -> Column:
    """The digits captured in `line`; '' for commas only, NULL for no match."""
    return F.when(
        line.rlike(pattern), F.regexp_replace(F.regexp_extract(line, pattern, 1), ",", "")
    )


def line_captures(lines: Column, patterns: tuple[str, str]) -> Column:
    """(used, remaining) of the lines that match a pattern, in their order. Each line
    is matched once."""
    used, remaining = patterns
    captures = F.transform(
        lines,
        lambda line: F.struct(
            _capture(line, used).alias("used"), _capture(line, remaining).alias("remaining")
        ),
    )
    return F.filter(captures, lambda c: c["used"].isNotNull() | c["remaining"].isNotNull())


def _has_digits(*counters: Column) -> Column:
    """All counters hold digits; false, not NULL, where one was never seen."""
    found = F.lit(True)
    for counter in counters:
        found = found & (F.coalesce(counter, F.lit("")) != "")
    return found


def byte_counts(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        F.col("used").try_cast("decimal(38,0)").alias("used_bytes"),
        F.col("remaining").try_cast("decimal(38,0)").alias("remaining_bytes"),
    )


def scan_report(
    df: DataFrame,
    report_id: str,
    txt: str,
    patterns: tuple[str, str] = (USED_PATTERN, REMAINING_PATTERN),
) -> DataFrame:
    """(report_id, used_bytes, remaining_bytes) of reports held as whole texts,
    one per row. Works within the row: no explode, no shuffle."""
    hits = line_captures(split_lines(F.col(txt)), patterns)
    unseen = F.lit(None).cast("string")
    state = F.reduce(
        hits,
        F.struct(unseen.alias("used"), unseen.alias("remaining")),
        lambda seen, hit: F.when(_has_digits(seen["used"], seen["remaining"]), seen).otherwise(
            F.struct(
                F.coalesce(hit["used"], seen["used"]).alias("used"),
                F.coalesce(hit["remaining"], seen["remaining"]).alias("remaining"),
            )
        ),
    )
    # Generated as a list of at most one state: Spark evaluates a generator
    # once per row, whereas a filter on the state would be pushed down and
    # repeat the scan.
    complete = F.filter(
        F.array(state), lambda seen: _has_digits(seen["used"], seen["remaining"])
    )
    return byte_counts(df.select(report_id, F.inline(complete)), report_id)


def scan_report_lines(
    df: DataFrame,
    report_id: str,
    line_no: str,
    line: str,
    piece: Column | None = None,
    patterns: tuple[str, str] = (USED_PATTERN, REMAINING_PATTERN),
) -> DataFrame:
    """`scan_report` for reports held as lines, of any length.

    One report may hold most of all lines, so it is cut into pieces of
    consecutive lines (`piece`, ascending with the line number; by default by
    the number itself). A piece yields one row: the counters it ends with, and
    its first complete line for each case of what the pieces before it may
    have left (nothing needed, a used counter, a remaining counter). Only
    those rows meet per report.
    """
    if piece is None:
        piece = F.floor(F.col(line_no) / PIECE_LINES)
    text = F.col(line)
    hits = df.select(
        F.col(report_id),
        piece.alias("_piece"),
        F.col(line_no).alias("_at"),
        _capture(text, patterns[0]).alias("_used"),
        _capture(text, patterns[1]).alias("_remaining"),
    ).filter(F.col("_used").isNotNull() | F.col("_remaining").isNotNull())
    # Sorted where they are read: a task is done with its input, which may be
    # whole texts, before it holds a buffer for each partition of the shuffle.
    hits = hits.sortWithinPartitions(report_id, "_piece", "_at")

    so_far = (
        Window.partitionBy(report_id, "_piece")
        .orderBy("_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = hits.select(
        report_id,
        "_piece",
        "_at",
        F.last("_used", ignorenulls=True).over(so_far).alias("used"),
        F.last("_remaining", ignorenulls=True).over(so_far).alias("remaining"),
    )
    used, remaining = F.col("used"), F.col("remaining")
    # The line number comes first, so the least and greatest states are those
    # of the first and last line.
    state = F.struct("_at", "used", "remaining")

    def first_where(condition: Column) -> Column:
        return F.min(F.when(condition, state))

    pieces = running.groupBy(report_id, "_piece").agg(
        F.max(state).alias("_end"),
        first_where(_has_digits(used, remaining)).alias("_alone"),
        first_where(used.isNull() & _has_digits(remaining)).alias("_needs_used"),
        first_where(remaining.isNull() & _has_digits(used)).alias("_needs_remaining"),
    )

    earlier = (
        Window.partitionBy(report_id)
        .orderBy("_piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    entered = pieces.select(
        "*",
        F.last("_end.used", ignorenulls=True).over(earlier).alias("_used_before"),
        F.last("_end.remaining", ignorenulls=True).over(earlier).alias("_remaining_before"),
    )
    with_used = F.when(
        _has_digits(F.col("_used_before")),
        F.struct("_needs_used._at", F.col("_used_before").alias("used"), "_needs_used.remaining"),
    )
    with_remaining = F.when(
        _has_digits(F.col("_remaining_before")),
        F.struct(
            "_needs_remaining._at",
            "_needs_remaining.used",
            F.col("_remaining_before").alias("remaining"),
        ),
    )
    candidates = F.filter(
        F.array("_alone", with_used, with_remaining), lambda state: state["_at"].isNotNull()
    )
    complete = (
        entered.select(report_id, "_piece", F.array_min(candidates).alias("_first"))
        .filter(F.col("_first").isNotNull())
        .groupBy(report_id)
        .agg(F.min(F.struct("_piece", "_first")).alias("_least"))
        .select(report_id, "_least._first.*")
    )
    return byte_counts(complete, report_id)


def usage_tb(df: DataFrame) -> DataFrame:
    """Byte counts of a scanned report -> `dfs_used_tb`, `dfs_remaining_tb`."""
    return df.withColumns(
        {
            "dfs_used_tb": bytes_to_tb(F.col("used_bytes")),
            "dfs_remaining_tb": bytes_to_tb(F.col("remaining_bytes")),
        }
    ).drop("used_bytes", "remaining_bytes")


def usage_shares(
    df: DataFrame, used: str = "dfs_used_tb", remaining: str = "dfs_remaining_tb"
) -> DataFrame:
    """Add used and remaining shares of their sum, in percent: a number with
    one decimal (`used_share`, `remaining_share`) and its text (`..._text`).
    A report of zeros has no shares."""
    total = F.col(used) + F.col(remaining)

    def share(part: str) -> Column:
        return round_half_even(F.try_divide(F.col(part), total) * 100, 1)

    shares = df.withColumns({"used_share": share(used), "remaining_share": share(remaining)})
    return shares.withColumns(
        {
            f"{name}_text": F.when(F.col(name).isNotNull(), F.format_string("%.1f%%", name))
            for name in ("used_share", "remaining_share")
        }
    )
