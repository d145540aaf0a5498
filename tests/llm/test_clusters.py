"""Centroid clustering against comparing all vectors with all centroids in Python's integers."""

import hashlib
import math

import numpy as np
import pytest

from tidewire.llm import clusters

SCHEMA = "vec_id bigint, embedding array<double>, label int, v string, cluster string, upper int"


def brute(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) and abs(64 * x) < 2**27 for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    points = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), c) for c, p in enumerate(points))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for c in range(len(points)):
            own = [v for (_, v), o in zip(kept, of, strict=True) if o == c]
            if own:
                points[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total, own = sum(d for _, _, d in found), {}
    for _, c, d in found:
        own[c] = own.get(c, 0) + d
    return sorted(((i, c, d, own[c], total, hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest()) for i, c, d in found), key=str)


@pytest.mark.parametrize("spread", [0.02, 2.0, 100_000.0])
def test_equals_comparing_all(spark, spread):
    draw = np.random.default_rng(3)
    middles = draw.normal(size=(9, 64)) * spread
    rows = [(i, (middles[i % 9] + draw.normal(size=64) * spread / 3).tolist()) for i in range(160)]
    # Ties, repeated rows, equal vectors under other ids, and rows that are not kept.
    rows += [(3, rows[3][1]), (3, rows[4][1]), (500, rows[3][1]), (None, rows[5][1]), (None, rows[6][1])] + [(600 + i, [0.0] * 64) for i in range(5)]
    rows += [(700, None), (701, [1.0] * 63), (702, [None] + [1.0] * 63), (703, [float("nan")] * 64), (704, [float("inf")] * 64), (705, []), (706, [3e6] * 64)]
    df = spark.createDataFrame([(i, v, 1, "a", "b", 2) for i, v in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in clusters.report(*clusters.cluster(df)).collect()), key=str) == brute(rows)


def test_few_vectors_and_none(spark):
    few = [(i, [float(i)] * 64) for i in range(4)]
    df = spark.createDataFrame([(i, v, 1, "a", "b", 2) for i, v in few], SCHEMA)
    assert sorted((tuple(r) for r in clusters.report(*clusters.cluster(df)).collect()), key=str) == brute(few)
    empty = clusters.report(*clusters.cluster(spark.createDataFrame([], SCHEMA)))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and empty.count() == 0


def test_bounds_spare_distances_and_keep_ties():
    draw = np.random.default_rng(4)
    points = draw.integers(-60, 60, (64, 8)) * np.int64(20)
    x = points[draw.integers(0, 64, 4000)] + draw.integers(-9, 10, (4000, 8))
    first = clusters.Centroids(points)
    cluster, upper, lower, own = first.first(x)
    moved = points + draw.integers(-3, 4, points.shape)
    moved[7], moved[11] = moved[3], moved[3]  # three centroids in one place: the smallest number wins
    again, _, _, distance, taken = clusters.Centroids(moved, points).again(x, cluster, upper, lower)
    every = clusters.squares(x, moved)
    assert (again == every.argmin(1)).all() and (distance == every.min(1)).all() and taken < every.size / 5
    assert (own == clusters.squares(x, points).min(1)).all()


def test_large_integers_are_exact():
    x, p = np.array([[2**27 - 1, -(2**27) + 1]]), np.array([[-(2**27) + 1, 2**27 - 1]])
    assert clusters.squares(x, p)[0, 0] == 2 * (2 * (2**27 - 1)) ** 2
