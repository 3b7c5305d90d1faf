"""Clustering against plain whole-number arithmetic, and the bounds of the pivot table."""

import hashlib
import math

import numpy as np
import pytest

from __spark_entry__ import queries
from opsmetrics.llm.pivot_clustering import (
    CLUSTER_SQL,
    CENTROIDS,
    cluster_report,
    cluster_vectors,
    nearest_centroids,
    spread_pivots,
    squared_distances,
    whole_vectors,
)
from tests.comparison import difference, duckdb_on
from tests.llm.conftest import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain_clusters(rows):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    kept = [
        (i, tuple(math.floor(64 * float(np.float32(x))) for x in v))
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, digest(r[0]) if r[0] is not None else "", r[1]))
    means = [v for _, v in order[:CENTROIDS]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))

    for _ in range(3):
        held = [[] for _ in means]
        for _, v in kept:
            held[nearest(v)[1]].append(v)
        means = [
            tuple(sum(x) // len(own) for x in zip(*own)) if own else m for own, m in zip(held, means)
        ]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = [sum(d for _, d, c in last if c == k) for k in range(len(means))]
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return [(i, c, d, inertia[c], sum(inertia), sha[c]) for i, d, c in last]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(count, seed=3, spread=0.3):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(7, 64))
    return [
        (i, (centres[i % 7] + random.normal(scale=spread, size=64)).astype(np.float32).tolist())
        for i in range(count)
    ]


def test_sql(spark):
    report = queries()["op11_pivot_clusters"](spark, SF)
    assert difference(report, CLUSTER_SQL, duckdb_on(SF)) is None


def test_plain_version(spark):
    rows = vectors(300)
    same = [0.5] * 64
    rows += [(1000, same)] * 150 + [(1000, same), (None, same), (None, [-0.51] * 64), (7, rows[3][1])]
    rows += [
        (2000, None), (2001, []), (2002, [0.1] * 63), (2003, [0.1] * 65), (2004, [None] + [0.1] * 63),
        (2005, [math.nan] + [0.1] * 63), (2006, [math.inf] + [0.1] * 63), (2007, [-math.inf] * 64),
    ]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    for name in ["vector", "cluster", "distance", "pivot_distances", "inertia", "cluster_inertia"]:
        df = df.selectExpr("*", f"'theirs' AS {name}")
    assert found(cluster_report(df)) == sorted(plain_clusters(rows), key=repr)


@pytest.mark.parametrize("count", [0, 1, 5])
def test_few_vectors(spark, count):
    rows = vectors(count)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert found(cluster_report(df)) == sorted(plain_clusters(rows), key=repr)


def test_too_large_component_fails(spark):
    df = spark.createDataFrame([(1, [3e7] * 64, 0)], SCHEMA)
    with pytest.raises(Exception, match="component too large"):
        whole_vectors(df).collect()


def test_bounds_spare_distances():
    """The same nearest centroids as from all distances, from far fewer of them."""
    data = np.array([np.floor(np.array(v) * 64) for _, v in vectors(500, spread=0.1)], dtype=np.int64)
    centroids = data[:14]
    pivots = spread_pivots(centroids, 8)
    number, distance, computed = nearest_centroids(
        data, squared_distances(data, pivots), centroids, pivots
    )
    every = squared_distances(data, centroids)
    assert (number == every.argmin(axis=1)).all()
    assert (distance == every.min(axis=1)).all()
    assert computed < every.size / 3


def test_largest_components_are_exact():
    """Squared distances of the largest components, and ties to the smaller number."""
    data = np.array([[2**27] * 64, [-(2**27)] * 64, [0] * 64], dtype=np.int64)
    centroids = np.array([[2**27] * 64, [2**27] * 64, [-(2**27)] * 64], dtype=np.int64)
    pivots = spread_pivots(centroids, 2)
    number, distance, _ = nearest_centroids(data, squared_distances(data, pivots), centroids, pivots)
    assert number.tolist() == [0, 2, 0]
    assert distance.tolist() == [0, 0, 64 * 2**54]


def test_sums_beyond_64_bits(spark):
    """The mean of vectors whose sums are large is still the exact floor."""
    rows = [(i, [float(2**21 - i % 2)] * 64) for i in range(400)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    _, means = cluster_vectors(whole_vectors(df), centroids=1)
    assert means.tolist() == [[math.floor(64 * (2**21 - 0.5))] * 64]
