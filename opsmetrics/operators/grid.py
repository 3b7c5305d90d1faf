"""State of each key on each day: long, wide and as drawn cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmetrics.functions.times import day_text
from opsmetrics.operators.numbering import number_rows

MISSING = "N/A"


def _twice(key: Column, date: Column) -> Column:
    return F.concat(F.lit("more than one row for "), key.cast("string"), F.lit(" on "), date)


def status_grid(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    on_duplicate: str = "latest",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Long grid (key, `date`, value): one row per key and day that has a row.

    Several rows in one cell: "error" fails the query, "latest" takes the value
    with the greatest time, then `tiebreak`, then value. A missing state shows
    as N/A; a row without time has no cell. Each map task sends one row per
    cell, however many polls it holds.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError("on_duplicate must be 'error' or 'latest'")
    day = F.to_date(ts).alias("_day")
    cells = df.filter(F.col(ts).isNotNull()).groupBy(F.col(key), day).agg(
        F.max(F.struct(F.col(ts), *tiebreak, F.col(value).alias("_state"))).alias("_latest"),
        *([F.count(F.lit(1)).alias("_rows")] if on_duplicate == "error" else []),
    )
    state = F.col("_latest._state")
    if on_duplicate == "error":
        message = _twice(F.col(key), day_text(F.col("_day")))
        state = F.when(F.col("_rows") > 1, F.raise_error(message)).otherwise(state)
    return cells.select(
        key,
        day_text(F.col("_day")).alias("date"),
        F.coalesce(state, F.lit(MISSING)).alias(value),
    )


def _most_days(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))


def _first_days(df: DataFrame, ts: str, most: int) -> list[str]:
    """Of the days that have rows `most` at most, ascending."""
    days = df.select(F.to_date(ts).alias("_day")).distinct().filter(F.col("_day").isNotNull())
    return sorted(r[0] for r in days.select(day_text(F.col("_day"))).limit(most).collect())


def grid_dates(df: DataFrame, ts: str) -> list[str]:
    """The days that have rows, ascending: the columns of the wide grid.

    Reads the time column only. At most `spark.sql.pivotMaxValues` days, the
    bound Spark itself sets on pivot columns; beyond it this raises.
    """
    bound = _most_days(df)
    found = _first_days(df, ts, bound + 1)
    if len(found) > bound:
        raise ValueError(f"the grid has more than {bound} days")
    return found


def grid_table(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    on_duplicate: str = "latest",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """`wide_grid` over all days. Of more days than `spark.sql.pivotMaxValues` it is the
    same grid as the rows of `to_cells`, whose days are never columns: no state is lost,
    and a history that grows does not fail its report."""
    days = _first_days(df, ts, _most_days(df) + 1)
    if len(days) <= _most_days(df):
        return wide_grid(df, key, ts, value, days, on_duplicate, tiebreak)
    return to_cells(status_grid(df, key, ts, value, on_duplicate, tiebreak), key, value)


def wide_grid(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    dates: Sequence[str],
    on_duplicate: str = "latest",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """`status_grid` with one row per key and one column per day of `dates`, keys
    ascending; absent cells are N/A.

    As the days are known, rows are grouped by key once, with the state of each
    day as an aggregate of its own: one row per key leaves each map task.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError("on_duplicate must be 'error' or 'latest'")
    polls = df.filter(F.col(ts).isNotNull())
    if not dates:
        return polls.select(key).distinct().orderBy(key)
    row = F.struct(F.col(ts), *tiebreak, F.col(value).alias("_state"))
    on_day = [F.to_date(ts) == F.lit(day).cast("date") for day in dates]
    cells = polls.groupBy(F.col(key)).agg(
        *[F.max(F.when(day, row)).alias(f"_latest{x}") for x, day in enumerate(on_day)],
        *[
            F.count(F.when(day, F.lit(1))).alias(f"_rows{x}")
            for x, day in enumerate(on_day)
            if on_duplicate == "error"
        ],
    )

    def state(x: int, date: str) -> Column:
        found = F.coalesce(F.col(f"_latest{x}._state"), F.lit(MISSING))
        if on_duplicate == "error":
            message = _twice(F.col(key), F.lit(date))
            found = F.when(F.col(f"_rows{x}") > 1, F.raise_error(message)).otherwise(found)
        return found.alias(date)

    return cells.select(key, *[state(x, d) for x, d in enumerate(dates)]).orderBy(key)


def to_cells(long_grid: DataFrame, row_key: str, value: str) -> DataFrame:
    """A long grid (row_key, `date`, value) as dense cells (row_key, column_name,
    value, x, y): N/A where a key has no row on a day that others have.

    x counts days from the left, y keys from the bottom: the first key in
    ascending order has the greatest y. Both come from dictionaries, of the days
    and of the keys, each numbered once: the places of the cells are made from
    the number of days alone, and days and states joined to them. So no row
    ever holds all days or all states of a key.
    """
    days = number_rows(
        long_grid.select(F.col("date").alias("column_name")).distinct(), [F.col("column_name")], name="x"
    )
    keys = number_rows(
        long_grid.select(F.col(row_key).alias("_key")).distinct(), [F.col("_key").desc()], name="y"
    )
    places = keys.select(
        "_key", "y", F.explode(F.sequence(F.lit(0), F.lit(days.count()) - 1)).alias("x")
    )
    dense = places.join(days.withColumn("x", F.col("x").cast("int")), "x")
    cell = dense["_key"].eqNullSafe(long_grid[row_key]) & (dense["column_name"] == long_grid["date"])
    return dense.join(long_grid, cell, "left").select(
        F.col("_key").alias(row_key),
        "column_name",
        F.coalesce(F.col(value), F.lit(MISSING)).alias("value"),
        "x",
        "y",
    )
