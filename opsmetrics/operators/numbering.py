"""Consecutive row numbers over a global order, without a global window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmetrics.session import cut_lineage

# Types that can settle a tie.
ORDERED = (
    T.NumericType,
    T.StringType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)

# monotonically_increasing_id: partition number above bit 33, row below.
_ROW_BITS = 33


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "Index",
    start: int = 0,
) -> DataFrame:
    """Add `name`: start, start+1, ... following `order_by`, as first column.

    Rows are range-partitioned, sorted and numbered within their partition;
    the sizes of the preceding partitions are added afterwards. Rows equal in
    the order are ordered by their other columns and, if they agree in all of
    them, by their place in the input, which also spreads a value that many
    rows share over several partitions. The sorted rows are
    checkpointed, since sampled range bounds and row places must be the same
    for both uses; this runs a job when called.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    named = {c for c in order_by if isinstance(c, str)}
    keys += [
        F.col(f"`{field.name}`")
        for field in df.schema
        if field.name not in named and isinstance(field.dataType, ORDERED)
    ]
    keys.append(F.col("_arrived"))
    placed = cut_lineage(
        df.withColumn("_arrived", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_arrived")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    rows = placed.select(
        F.shiftright("_place", _ROW_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit(2**_ROW_BITS - 1)).alias("_row"),
        *df.columns,
    )
    # One row per partition: the window and the broadcast are bounded by the
    # partition count, whatever the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    index = (F.col("_offset") + F.col("_row") + F.lit(start)).cast("bigint")
    return rows.join(F.broadcast(offsets), "_part").select(index.alias(name), *df.columns)
