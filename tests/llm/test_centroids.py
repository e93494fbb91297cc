import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locrank.llm.centroids import MOST, assigned, clustered, digest, half_gaps, loosening, squared_distances


def by_hand(rows, k, rounds, dims, scale=256, seed=2):
    """(id, vector) rows, cluster, distance and final centroids, scanned in full."""
    kept = [
        (i, [math.floor(scale * e) for e in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(e is not None and math.isfinite(e) for e in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[0] or 0, r[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, centroids)]
    return [(i, *reversed(nearest(v))) for i, v in kept], centroids


def test_against_a_full_scan(spark):
    draw = random.Random(12)
    centres = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(n, [c + draw.gauss(0, 0.3) for c in draw.choice(centres)]) for n in range(400)]
    rows += [(n, rows[0][1]) for n in range(1000, 1200)]  # a third are copies of one
    rows += [(2000, None), (2001, [1.0] * 7), (2002, [1.0] * 9), (2003, [None] + [1.0] * 7), (2004, [float("nan")] * 8)]
    rows += [(2005, [float("inf")] * 8), (5, rows[1][1]), (5, rows[2][1]), (None, rows[3][1]), (2006, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {name: F.lit(1) for name in ("x", "cluster", "distance", "lower", "n", "centroid")}
    )
    expected, centroids = by_hand(rows, 9, 4, 8)
    found = clustered(frame.repartition(5), k=9, rounds=4, dims=8).collect()
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found), key=key) == sorted(expected, key=key)
    whole = sum(d for _, _, d in expected)
    for r in found:
        assert r.centroid == centroids[r.cluster] and r.inertia == whole
        assert r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert clustered(spark.createDataFrame([], schema)).count() == 0
    assert clustered(spark.createDataFrame([(1, None)], schema)).count() == 0
    rows = [(n, [n / 4.0, 0.0]) for n in range(3)]
    found = clustered(spark.createDataFrame(rows, schema), dims=2).collect()
    assert sorted(r.vec_id for r in found) == [0, 1, 2] and {r.distance for r in found} == {0}


def test_components_too_large_for_64_bits(spark):
    rows = [(1, [1e300, -1e300]), (2, [0.0, 0.0])]
    found = clustered(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1, rounds=1, dims=2).collect()
    assert {r.cluster for r in found} == {0}
    assert {tuple(r.centroid) for r in found} == {(MOST // 2, -MOST // 2)}


@pytest.mark.parametrize("scale", [10, 2**24])
def test_squared_distances_are_exact(scale):
    draw = np.random.default_rng(3)
    x, c = draw.integers(-scale, scale, (20, 64)), draw.integers(-scale, scale, (5, 64))
    expected = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w)) for w in c] for v in x]
    assert squared_distances(x, c).tolist() == expected


def test_loosening_holds_and_is_less_than_the_drift():
    """No distance of a vector in a sphere shrinks by more; in many cases the drift is far more than that."""
    draw = np.random.default_rng(4)
    shares = []
    for _ in range(200):
        dims, k = int(draw.integers(2, 9)), int(draw.integers(2, 6))
        old = draw.integers(-300, 300, (k, dims))
        new = old + draw.integers(-40, 40, (k, dims))
        radii = draw.uniform(0, 200, k)
        loosened = loosening(old, radii, old, new)
        drift = np.linalg.norm(new - old, axis=1)
        for i in range(k):
            away = draw.normal(size=(200, dims))
            x = old[i] + away / np.linalg.norm(away, axis=1)[:, None] * radii[i] * draw.uniform(0, 1, (200, 1)) ** 0.1
            others = [j for j in range(k) if j != i]
            shrunk = np.linalg.norm(x[:, None] - old[others], axis=2) - np.linalg.norm(x[:, None] - new[others], axis=2)
            assert shrunk.max() <= loosened[i] + 1e-6
            assert loosened[i] <= drift[others].max() * (1 + 1e-6)
            shares.append(loosened[i] / drift[others].max())
    assert np.mean(np.array(shares) < 0.8) > 0.3


def test_most_vectors_are_not_scanned_again():
    draw = np.random.default_rng(5)
    middles = draw.integers(-400, 400, (8, 64))
    x = middles[draw.integers(0, 8, 3000)] + draw.integers(-30, 30, (3000, 64))
    old = middles + draw.integers(-20, 20, (8, 64))
    cluster, distance, lower, scanned = assigned(x, old)
    assert scanned.all()
    radii = np.array([np.sqrt(distance[cluster == j].max()) for j in range(8)])
    new = np.array([x[cluster == j].sum(axis=0) // (cluster == j).sum() for j in range(8)])
    loose = loosening(old, radii, old, new)
    after = assigned(x, new, cluster, lower - loose[cluster])
    assert after[3].mean() < 0.05
    full = squared_distances(x, new)
    assert (after[0] == full.argmin(axis=1)).all() and (after[1] == full.min(axis=1)).all()
    assert (after[2] <= np.sqrt(np.sort(full, axis=1)[:, 1])).all()
    assert half_gaps(new).shape == (8,) and digest([1, -2]) == hashlib.sha256(b"1,-2").hexdigest()
