"""Business order, report groups and display names of hosts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmetrics.fixed_values import DISPLAY_NAMES, GROUP_PATTERNS, HOST_ORDER
from opsmetrics.session import dimension


def host_dimension(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Host names with their 0-based place in the report."""
    schema = T.StructType(
        [T.StructField(key, T.StringType()), T.StructField("position", T.IntegerType())]
    )
    rows = [(name, place) for place, name in enumerate(order)]
    return dimension(df.sparkSession, rows, schema)


def assign_group(
    df: DataFrame,
    key: str,
    hosts: Sequence[str] | DataFrame = HOST_ORDER,
    patterns: Mapping[str, str] | None = GROUP_PATTERNS,
) -> DataFrame:
    """Add `position` and `group_name`; hosts that are not listed drop out.

    `hosts` is the ordered list of names, or a table (key, position[,
    group_name]). The join carries no hint: Catalyst broadcasts the table when
    its size allows and shuffles otherwise. With `patterns` (group -> pattern
    on the name) a host is in every group it matches, so it may give several
    rows, or none; without, the group comes from the table.
    """
    if not isinstance(hosts, DataFrame):
        hosts = host_dimension(df, key, hosts)
    listed = df.join(hosts, key, "inner")
    if patterns is None:
        return listed
    groups = F.array(
        *[F.when(F.col(key).rlike(p), F.lit(g)) for g, p in patterns.items()]
    )
    matches = listed.withColumn("group_name", F.explode(groups))
    return matches.filter(F.col("group_name").isNotNull())


def display_names(df: DataFrame, mapping: Mapping[str, str] = DISPLAY_NAMES) -> DataFrame:
    """Rename the mapped columns, keep the others and the order."""
    return df.withColumnsRenamed(dict(mapping))
