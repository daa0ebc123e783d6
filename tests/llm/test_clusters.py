"""Centroid clusters against plain k-means over whole numbers."""

import hashlib
import math
import random

import numpy as np

from glyphvec.llm import clusters


def _brute(rows, k, rounds):
    """(vec_id, cluster, distance) of ``rows`` [(vec_id, parts)] and the centroids."""
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [r[1] for r in sorted(rows, key=key)[:k]]

    def nearest(p):
        return min((sum((x - y) ** 2 for x, y in zip(p, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, p in rows:
            members.setdefault(nearest(p)[1], []).append(p)
        centroids = [
            [sum(x) // len(members[i]) for x in zip(*members[i])] if i in members else c for i, c in enumerate(centroids)
        ]
    return sorted((str(v), nearest(p)[1], nearest(p)[0]) for v, p in rows), centroids


def _whole(vector, dim=64):
    if vector is None or len(vector) != dim or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(64 * x) for x in vector]


def _check(spark, rows, k=16, rounds=3):
    df = spark.createDataFrame([(v, e, "x", 1) for v, e in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, cluster STRING, parts INT")
    found, centroids = clusters.cluster(clusters.whole_vectors(df.repartition(3)), k, rounds)
    mine = clusters.described(found, centroids).collect()
    exact = [(v, [float(np.float32(x)) if x is not None else None for x in e] if e is not None else None) for v, e in rows]
    kept = [(v, _whole(e)) for v, e in exact if _whole(e) is not None]
    expected, final = _brute(kept, k, rounds)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in mine) == expected
    assert centroids.tolist() == final or not kept
    for r in mine:
        assert r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in expected)
        name = ",".join(map(str, final[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(name.encode()).hexdigest()
    return mine


def test_against_brute_force(spark):
    random.seed(5)
    centres = [[random.gauss(0, 1) for _ in range(64)] for _ in range(7)]
    rows = [(i, [x + random.gauss(0, 0.2) for x in random.choice(centres)]) for i in range(400)]
    _check(spark, rows)


def test_ties_copies_and_hot_cluster(spark):
    one, other = [0.5] * 64, [-0.5] * 64
    rows = [(i, one) for i in range(60)] + [(100 + i, other) for i in range(5)] + [(7, [0.0] * 64), (7, one), (7, other)]
    _check(spark, rows)


def test_rows_left_out_and_null_ids(spark):
    good = [[i / 9 + j / 100 for j in range(64)] for i in range(9)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] * 64, [float("inf")] + [0.0] * 63, [None] + [0.0] * 63]
    rows = [(i, v) for i, v in enumerate(good + bad)] + [(None, good[0]), (None, good[3])]
    assert len(_check(spark, rows)) == 11


def test_fewer_vectors_than_clusters_and_none(spark):
    assert len(_check(spark, [(3, [0.25] * 64), (4, [0.5] * 64)])) == 2
    assert _check(spark, [(3, None)]) == []
    assert _check(spark, []) == []


def test_large_components_are_exact(spark):
    random.seed(6)
    rows = [(i, [random.choice([-1, 1]) * random.random() * 1e6 for _ in range(64)]) for i in range(60)]
    _check(spark, rows, k=5)
    held = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64)], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    points = clusters.whole_vectors(held)
    assert {max(r.parts) for r in points.collect()} == {1 << 27, -(1 << 27)}
    assert len(clusters.described(*clusters.cluster(points, 1, 1)).collect()) == 2


def test_pivots_save_distances(spark):
    random.seed(7)
    centres = [[random.gauss(0, 3) for _ in range(64)] for _ in range(16)]
    rows = [(i, [x + random.gauss(0, 0.1) for x in centres[i % 16]]) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    found, centroids = clusters.cluster(clusters.whole_vectors(df))
    assert found.groupBy().sum("computed").first()[0] < 0.5 * len(rows) * len(centroids)


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(3)
    for spread in (1, 64, 1 << 20, 1 << 26):
        points = rng.integers(-spread, spread + 1, (300, 64))
        centroids, pivots = rng.integers(-spread, spread + 1, (9, 64)), clusters.far_apart(points, 6)
        found = clusters.Centroids.at(centroids, pivots).nearest(points, np.sqrt(clusters.squared(points, pivots)))
        exact = ((points[:, None, :].astype(object) - centroids[None].astype(object)) ** 2).sum(axis=2)
        assert found[0].tolist() == [row.tolist().index(min(row)) for row in exact]
        assert found[1].tolist() == [min(row) for row in exact]
