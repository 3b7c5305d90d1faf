"""Threshold colours and state colours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmetrics.fixed_values import STATE_PALETTE
from opsmetrics.functions.numbers import missing_if_nan


def level_of(
    value: Column, levels: Sequence[tuple[float, str]], default: str | None = "white"
) -> Column:
    """The label of the highest lower bound that `value` exceeds. Bounds are
    exclusive; a missing value exceeds none."""
    value = missing_if_nan(value.cast("double"))
    label = F.lit(default).cast("string")
    for bound, name in sorted(levels, key=lambda level: level[0]):
        label = F.when(value > bound, F.lit(name)).otherwise(label)
    return label


def classify_levels(
    df: DataFrame,
    rules: Mapping[str, Sequence[tuple[float, str]]],
    default: str | None = "white",
    suffix: str = "_colour",
) -> DataFrame:
    """Add `<metric><suffix>` for every metric with rules."""
    return df.withColumns(
        {
            f"{metric}{suffix}": level_of(F.col(f"`{metric}`"), levels, default)
            for metric, levels in rules.items()
        }
    )


def classify_by_rules(
    df: DataFrame,
    rules: DataFrame,
    metric: str,
    value: str,
    at: str,
    name: str = "colour",
    default: str | None = "white",
    bin_days: int = 30,
) -> DataFrame:
    """Add the level of each value under the rules in force at its time.

    `rules` has (metric, level, lower, valid_from, valid_to): of the rules of the
    row's metric with valid_from <= time < valid_to whose lower bound the value
    exceeds, that with the highest bound gives the level; of equal bounds, the
    greatest level. A missing end of the validity is open. Rows without a metric,
    a time, a number or a matching rule get `default`; rules without a metric, a
    bound or a level match nothing. A column `name` of `df` is replaced.

    Times are cut into bins of `bin_days`. The bins that each metric has rows in
    are joined to its rules and give one row per metric and bin, which `df` is
    joined to by equality: a hot metric is split or broadcast as in any such
    join, and a row is held to the rules of its own bin only.
    """
    row, found = "_level_row", "_level_rules"
    bin_of = lambda c: F.floor(F.unix_date(F.to_date(c)) / bin_days)
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    rows = df.select(
        F.struct(*kept).alias(row),
        F.col(f"`{metric}`").alias("metric"),
        missing_if_nan(F.col(f"`{value}`").cast("double")).alias("value"),
        F.col(f"`{at}`").alias("at"),
        bin_of(F.col(f"`{at}`")).alias("bin"),
    )
    asked = rows.select("metric", "bin").where("metric IS NOT NULL AND bin IS NOT NULL").distinct()
    valid = rules.where("lower IS NOT NULL AND level IS NOT NULL").select(
        F.col("metric").alias("of_metric"),
        F.struct(
            F.col("lower").cast("double").alias("lower"), "level", "valid_from", "valid_to"
        ).alias("rule"),
        bin_of(F.col("valid_from")).alias("first_bin"),
        bin_of(F.col("valid_to")).alias("last_bin"),
    )
    in_bin = (
        (F.col("metric") == F.col("of_metric"))
        & F.coalesce(F.col("bin") >= F.col("first_bin"), F.lit(True))
        & F.coalesce(F.col("bin") <= F.col("last_bin"), F.lit(True))
    )
    by_bin = (
        asked.join(valid, in_bin)
        .groupBy(F.col("metric").alias("of_metric"), F.col("bin").alias("of_bin"))
        .agg(F.collect_list("rule").alias(found))
    )

    def exceeded(rule: Column) -> Column:
        return (
            (F.col("value") > rule["lower"])
            & F.coalesce(F.col("at") >= rule["valid_from"], F.lit(True))
            & F.coalesce(F.col("at") < rule["valid_to"], F.lit(True))
        )

    highest = F.array_max(
        F.transform(F.filter(found, exceeded), lambda r: F.struct(r["lower"], r["level"]))
    )
    same_bin = (F.col("metric") == F.col("of_metric")) & (F.col("bin") == F.col("of_bin"))
    # Two steps: beside columns named like those of `rows`, the lambdas would read these.
    judged = rows.join(by_bin, same_bin, "left").select(row, highest["level"].alias("level"))
    return judged.select(
        *[F.col(row)[c].alias(c) for c in df.columns if c != name],
        F.coalesce("level", F.lit(default)).alias(name),
    )


def classify_states(
    df: DataFrame,
    state: str,
    palette: Mapping[str, str] | DataFrame = STATE_PALETTE,
    default: str = "white",
    name: str = "colour",
) -> DataFrame:
    """Add the colour of a state. A palette held in code is a constant map, no
    join; a palette table (state, colour; one row per state) is left-joined,
    and Catalyst broadcasts it if its size allows."""
    if isinstance(palette, DataFrame):
        key, colour = palette.columns[:2]
        table = palette.select(F.col(key).alias(state), F.col(colour).alias(name))
        return df.join(table, state, "left").withColumn(
            name, F.coalesce(F.col(name), F.lit(default))
        )
    pairs = [F.lit(text) for pair in palette.items() for text in pair]
    found = F.try_element_at(F.create_map(*pairs), F.col(state))
    return df.withColumn(name, F.coalesce(found, F.lit(default)))
