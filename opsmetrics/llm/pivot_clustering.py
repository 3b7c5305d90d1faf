"""Centroid clustering of whole-number vectors with a LAESA pivot table.

The distances of all vectors to a few fixed pivots are stored once. In each round the
differences between them and a centroid's distances to the pivots bound that
centroid's distance from below; only the centroids that stay below the best one
found are measured, in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsmetrics.llm.common import staged

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
PIVOTS = 8
# A component may have so many bits at most: squared distances then fit in 64.
COMPONENT_BITS = 27
# Bounds are lowered by so much of themselves, and one, against rounding.
MARGIN = 1e-9


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): the rows with exactly `dimensions` components, none missing
    or not finite, each component x as floor(scale * x).

    A component beyond 2^27 in size fails, since distances would not be whole
    numbers of 64 bits.
    """
    x = F.col("embedding")
    whole = (F.size(x) == dimensions) & F.forall(x, lambda v: F.coalesce(
        ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)
    ))

    def component(v: Column) -> Column:
        scaled = v.cast("double") * scale
        return F.when(F.abs(scaled) <= 2**COMPONENT_BITS, F.floor(scaled).cast("bigint")).otherwise(
            F.raise_error(F.concat(F.lit("component too large: "), v.cast("string"))).cast("bigint")
        )

    return vectors.select("vec_id", "embedding").filter(F.coalesce(whole, F.lit(False))).select(
        "vec_id", F.transform(x, component).alias("vector")
    )


def starting_centroids(vectors: DataFrame, centroids: int = CENTROIDS) -> np.ndarray:
    """The vectors of the smallest lowercase-hex sha256 of `1:<vec_id>`, in that
    order; equal ids are ordered by their vectors, missing ids come last. There
    are fewer if there are fewer vectors."""
    digest = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = (
        vectors.select(digest.alias("_digest"), "vector")
        .orderBy(F.asc_nulls_last("_digest"), "vector").limit(centroids).collect()
    )
    return np.array([row["vector"] for row in first], dtype=np.int64)


def spread_pivots(candidates: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those taken."""
    taken = [0]
    nearest = squared_distances(candidates, candidates[:1])[:, 0]
    while len(taken) < min(pivots, len(candidates)):
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared_distances(candidates, candidates[taken[-1:]])[:, 0])
    return candidates[taken]


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of `a` to every row of `b`."""
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for j, row in enumerate(b):
        difference = a - row
        out[:, j] = np.einsum("ij,ij->i", difference, difference)
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    # Not `values`: a slice of a batch has an offset.
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.ravel())
    )


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, vector, pivot_distances), stored: the squared distances to the pivots."""
    width = pivots.shape[1]

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = squared_distances(_matrix(batch.column("vector"), width), pivots)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vector"), _lists(found)],
                    ["vec_id", "vector", "pivot_distances"],
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    table = vectors.mapInArrow(
        distances, f"vec_id {kind}, vector array<bigint>, pivot_distances array<bigint>"
    )
    return staged(table, "pivot-table")


def nearest_centroids(
    vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, the smaller
    number among equals; and how many distances were computed.

    By the triangle inequality a centroid is at least as far as its and the
    vector's distances to any pivot differ. Centroids are tried in the order
    of that bound over all vectors, and for each one only the vectors whose
    bound does not exceed the best distance so far.
    """
    of_centroids = np.sqrt(squared_distances(centroids, pivots).astype(np.float64))
    of_vectors = np.sqrt(to_pivots.astype(np.float64))
    bound = np.zeros((len(vectors), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(of_vectors[:, p, None] - of_centroids[None, :, p]), out=bound)
    bound = np.maximum(bound * (1 - MARGIN) - MARGIN, 0) ** 2

    rows = np.arange(len(vectors))
    number = bound.argmin(axis=1)
    difference = vectors - centroids[number]
    distance = np.einsum("ij,ij->i", difference, difference)
    computed = len(vectors)
    first = number.copy()
    for j in range(len(centroids)):
        asked = rows[(first != j) & (bound[:, j] <= distance)]
        difference = vectors[asked] - centroids[j]
        found = np.einsum("ij,ij->i", difference, difference)
        better = (found < distance[asked]) | ((found == distance[asked]) & (j < number[asked]))
        distance[asked[better]] = found[better]
        number[asked[better]] = j
        computed += len(asked)
    return number, distance, computed


def _assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    width = centroids.shape[1]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("vector"), width)
                to_pivots = _matrix(batch.column("pivot_distances"), len(pivots))
                number, distance, _ = nearest_centroids(vectors, to_pivots, centroids, pivots)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"],
                )

    kind = table.schema["vec_id"].dataType.simpleString()
    return table.mapInArrow(nearest, f"vec_id {kind}, cluster int, distance bigint")


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors.

    A task gives one row of exact sums per cluster, so the driver gets as many
    numbers as the centroids have, whatever the number of vectors.
    """
    count, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Halves, since sums of a whole task may exceed 64 bits in the end.
        rows = np.zeros(count, dtype=np.int64)
        total = np.zeros((count, width), dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"), width)
            to_pivots = _matrix(batch.column("pivot_distances"), len(pivots))
            number, _, _ = nearest_centroids(vectors, to_pivots, centroids, pivots)
            part = np.zeros((count, width), dtype=np.int64)
            np.add.at(part, number, vectors)
            total += part
            rows += np.bincount(number, minlength=count)
        held = np.flatnonzero(rows)
        digits = [[str(x) for x in total[j]] for j in held]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held.astype(np.int32)), pa.array(rows[held]),
                pa.array(digits, pa.list_(pa.string())),
            ],
            ["cluster", "vectors", "sums"],
        )

    parts = table.mapInArrow(sums, "cluster int, vectors bigint, sums array<string>")
    added = (
        parts.select("cluster", "vectors", F.posexplode("sums").alias("at", "sum"))
        .groupBy("cluster", "at")
        .agg(
            F.sum("vectors").alias("vectors"),
            F.sum(F.col("sum").cast("decimal(28,0)")).alias("sum"),
        )
        .collect()
    )
    moved = centroids.copy()
    for row in added:
        moved[row["cluster"], row["at"]] = int(row["sum"]) // row["vectors"]
    return moved


def cluster_vectors(
    vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, pivots: int = PIVOTS
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance), stored, after `rounds` rounds and a last
    assignment; and the centroids. `vectors` is (vec_id, vector), all of one length.

    Repeated rows are vectors of their own; without vectors there is no row.
    """
    vectors = staged(vectors, "vectors")
    means = starting_centroids(vectors, centroids)
    if not len(means):
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, cluster int, distance bigint"
        ), means
    fixed = spread_pivots(means, pivots)
    table = pivot_table(vectors, fixed)
    for _ in range(rounds):
        means = _moved(table, means, fixed)
    return staged(_assigned(table, means, fixed), "assigned"), means


def cluster_report(vectors: DataFrame) -> DataFrame:
    """Per kept row of `vectors`: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256.

    Only vec_id and embedding are used; other columns may have any names. A
    missing vec_id is a value like any other, repeated rows are vectors of their
    own, a missing embedding or one of another length is left out, and an empty
    table gives no rows.
    """
    assigned, means = cluster_vectors(whole_vectors(vectors))
    exact = F.sum(F.col("distance").cast("decimal(20,0)"))
    # One row per centroid.
    of_cluster = assigned.groupBy("cluster").agg(exact.alias("_sum")).collect()
    total = sum(int(row["_sum"]) for row in of_cluster)
    known = assigned.sparkSession.createDataFrame(
        [
            (
                row["cluster"], int(row["_sum"]), total,
                hashlib.sha256(",".join(map(str, means[row["cluster"]])).encode()).hexdigest(),
            )
            for row in of_cluster
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _distance_sql(a: str, b: str) -> str:
    return (
        f"CAST(list_sum(list_transform(list_zip({a}, {b}), "
        "lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    )


def _assignment_sql(k: int) -> str:
    return f"""a{k} AS (
    SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
        SELECT r, c, {_distance_sql("kept.v", f"c{k}.v")} AS d FROM kept, c{k}
    ) x GROUP BY r
)"""


def _means_sql(k: int) -> str:
    # Exact floors: the remainder is made non-negative before the division.
    return f"""m{k} AS (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY place) AS v FROM (
        SELECT a.c, place, sum(v[place]) AS s, count(*) AS n
        FROM a{k - 1} a JOIN kept USING (r), (SELECT unnest(range(1, {DIMENSIONS + 1})) AS place) g
        GROUP BY a.c, place
    ) x GROUP BY c
), c{k} AS (
    SELECT c, CAST(coalesce(m{k}.v, c{k - 1}.v) AS HUGEINT[]) AS v FROM c{k - 1} LEFT JOIN m{k} USING (c)
)"""


CLUSTER_SQL = f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id,
        [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE len(embedding) = {DIMENSIONS}
        AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS}
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM kept
    QUALIFY c < {CENTROIDS}
), {_assignment_sql(0)}, {", ".join(f"{_means_sql(k)}, {_assignment_sql(k)}" for k in range(1, ROUNDS + 1))}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
    CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c{ROUNDS}.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN kept USING (r) JOIN c{ROUNDS} USING (c)
"""
