"""Centroid clustering against plain Python."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textforge.llm import cluster


def _brute(rows, k, rounds, dims, scale, seed):
    """``rows`` of (id, vector); every number is a Python integer."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    x = [[math.floor(scale * c) if abs(c) < 2**40 else int(c) * scale for c in v] for _, v in kept]
    order = sorted(range(len(x)), key=lambda i: (kept[i][0] is None, hashlib.sha256(f"{seed}:{kept[i][0]}".encode()).hexdigest(), kept[i][1]))
    centroids = [x[i] for i in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for v in x]
        for n in range(len(centroids)):
            mine = [v for v, o in zip(x, own) if o == n]
            if mine:
                centroids[n] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [(kept[i][0], nearest(v)[1], nearest(v)[0]) for i, v in enumerate(x)]
    return [(i, n, d if d < 2**63 else None) for i, n, d in out], [",".join(map(str, c)) for c in centroids]


def _key(row):
    return tuple(str(x) for x in row)


def _same(found, centroids, want, texts):
    assert sorted(map(tuple, found.collect()), key=_key) == sorted(want, key=_key)
    assert [r.components for r in centroids.orderBy("cluster").collect()] == texts


EDGES = [
    (1, [0.5, -0.25, 0.1]),
    (1, [0.5, -0.25, 0.1]),
    (2, [0.5, -0.25, 0.1]),
    (None, [9.0, 9.0, 9.0]),
    (None, [0.0, 0.0, 0.0]),
    (3, None),
    (4, [1.0, 2.0]),
    (5, [1.0, None, 2.0]),
    (6, [1.0, float("nan"), 2.0]),
    (7, [1.0, float("inf"), 2.0]),
    (8, []),
    (9, [1e300, -1e300, 3.0]),
    (10, [1e300, -1e300, 2.0]),
    (11, [-7.25, 1e18, 4.0]),
]


@pytest.mark.parametrize("k", [2, 4, 50])
def test_edge_rows(spark, k):
    df = spark.createDataFrame(EDGES, "id long, vector array<double>").repartition(3)
    for name in ("chunk", "block", "cluster", "distance", "data"):
        df = df.withColumn(name, F.lit("own"))
    found, centroids = cluster.cluster_vectors(df, k, 3, dims=3, scale=8, block=2)
    want, texts = _brute(EDGES, k, 3, 3, 8, cluster.SEED)
    assert found.columns == ["id", "cluster", "distance"]
    _same(found, centroids, want, texts)
    assert {w[0] for w in want} == {1, 2, None, 9, 10, 11}


def test_empty(spark):
    df = spark.createDataFrame([(3, None)], "id long, vector array<float>")
    found, centroids = cluster.cluster_vectors(df)
    assert found.count() == 0 and centroids.count() == 0


def test_many_chunks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(cluster, "CHUNK", 16)
    draw = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate((draw.integers(0, 4, (300, 1)) + draw.normal(0, 0.2, (300, 10))).tolist())]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a third of all rows are one vector
    df = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    found, centroids = cluster.cluster_vectors(df, 5, 4, dims=10, scale=64, block=3)
    _same(found, centroids, *_brute(rows, 5, 4, 10, 64, cluster.SEED))


def test_numbers_in_few_bytes():
    for numbers in ([[1, -2]], [[40_000, 1]], [[1 << 40, 0]], [[1 << 70, -5]]):
        a = np.array(numbers, object if numbers[0][0] > 1 << 62 else np.int64)
        assert cluster.unpack(cluster.pack(a), 2).tolist() == numbers
    assert len(cluster.pack(np.zeros((10, 2), np.int64))) == 41


def test_vectors_stay_in_their_buckets(spark, tmp_path):
    """The blocks' side of the join back has no exchange; only clusters move."""
    plans = []
    run, cluster.materialize = cluster.materialize, lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or run(df, name)
    try:
        rows = [(i, [float(i % 7), 1.0, 2.0]) for i in range(50)]
        cluster.cluster_vectors(spark.createDataFrame(rows, "id long, vector array<double>"), 2, 2, dims=3)
    finally:
        cluster.materialize = run
    plan = [p for n, p in plans if n == "centroid-slices"][-1]
    assert "ShuffledHashJoin" in plan and plan.count("Bucketed: true") >= 1 and "hashpartitioning(chunk" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
