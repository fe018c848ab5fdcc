"""Clustering against plain Python integers: ties, odd vectors, repeated rows, clashing columns, empty tables."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from strata.llm import bisector

SCHEMA = "vec_id long, embedding array<float>, cluster int, distance string"


def plain(rows, k, size, rounds):
    kept = []
    for vec_id, vector in rows:
        if vector is None or len(vector) != size or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector]))
    drawn = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in drawn[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, vs in groups.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    by = {}
    for _, c, d in found:
        by[c] = by.get(c, 0) + d
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, by[c], sum(by.values()), shas[c]) for i, c, d in found]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("spread", [0.02, 1.0, 300_000.0])
def test_clusters(spark, spread):
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-spread, spread) for _ in range(4)]) for i in range(60)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (None, [0.5, 0.25, -0.5, -0.004]), (70, [0.0] * 4), (71, [0.0] * 4)]
    rows += [(80, None), (81, []), (82, [1.0] * 3), (83, [1.0] * 5), (84, [1.0, None, 1.0, 1.0])]
    rows += [(85, [math.nan] * 4), (86, [math.inf, 0.0, 0.0, 0.0]), (87, [-math.inf, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 9, "x") for i, v in rows], SCHEMA).repartition(5)
    for k, rounds in ((5, 5), (100, 2), (1, 1)):
        got = bisector.cluster(df, k=k, size=4, rounds=rounds)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert order(map(tuple, got.collect())) == order(plain(rows, k, 4, rounds))


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1, "")], [(1, [1.0], 1, "")]):
        assert bisector.cluster(spark.createDataFrame(rows, SCHEMA), size=4).collect() == []


def test_vectors_too_large_for_a_long(spark):
    rows = [(1, [1e6, 0.0], 1, ""), (2, [0.0, 0.0], 1, "")]
    with pytest.raises(Exception, match="would not fit a long"):
        bisector.cluster(spark.createDataFrame(rows, SCHEMA), size=2).collect()


def test_zero_favours_the_smaller_number():
    bisectors = bisector.Bisectors.of([[2, 0], [0, 0], [2, 0], [0, 4]])
    winner, distance = bisectors.nearest(np.array([[1, 0], [2, 0], [0, 2], [-1, 2], [0, 3]], np.int64))
    assert winner.tolist() == [0, 0, 1, 1, 3] and distance.tolist() == [1, 0, 4, 5, 1]
    # Beyond the range of exact floating point whole numbers are compared.
    far = 1 << 26
    winner, distance = bisector.Bisectors.of([[far, 0], [far + 1, 0]]).nearest(np.array([[far + 1, 1], [far, 5]], np.int64))
    assert winner.tolist() == [1, 0] and distance.tolist() == [1, 25]
