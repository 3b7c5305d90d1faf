"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmetrics.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: bigint): the least node
    that can be reached.

    Alternates two steps until nothing changes: each node's greater neighbours
    go to its least neighbour, then its smaller ones do. The rounds grow with
    the logarithm of the longest path. Least neighbours are combined in the map
    tasks; the joins with them split hot nodes. Each round is written to the
    shared folder, two numbers come to the driver.
    """
    edges = staged(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        )
        large = staged(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                    F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        edges = staged(small, "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
