from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from llm_helpers import workers_find_the_package  # noqa: F401
from millrace.llm.centroids import LARGEST, Simplex, bounds, cluster_report, nearest, squares

NAMES = ("id", "vector", "apex", "cluster", "distance", "n", "sums", "order", "inertia")


def table(spark, rows: list[tuple]):
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return plain.withColumns({name: F.lit(name) for name in NAMES})


def plain(rows: list[tuple], width: int = 64, clusters: int = 16, rounds: int = 3) -> list[tuple]:
    """In Python's whole numbers, every vector against every centroid."""
    kept = [(key, [max(-LARGEST, min(LARGEST, math.floor(64 * float(np.float32(x))))) for x in vector]) for key, vector in rows
            if vector is not None and len(vector) == width and all(x is not None and math.isfinite(x) for x in vector)]

    def order(row):
        return hashlib.sha256(f"1:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]

    centroids = [vector for _, vector in sorted(kept, key=order)[:clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(vector, c)), n) for n, c in enumerate(centroids)) for _, vector in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centroids)):
            mine = [vector for (_, vector), (_, cluster) in zip(kept, found) if cluster == n]
            if mine:
                centroids[n] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assign()
    most = (1 << 63) - 1
    return sorted(((key, cluster, distance, min(most, sum(d for d, c in found if c == cluster)),
                    min(most, sum(d for d, _ in found)), hashlib.sha256(",".join(map(str, centroids[cluster])).encode()).hexdigest())
                   for (key, _), (distance, cluster) in zip(kept, found)), key=repr)


def report(spark, rows: list[tuple], **settings) -> list[tuple]:
    return sorted((tuple(row) for row in cluster_report(table(spark, rows), **settings).collect()), key=repr)


def vectors(count: int, groups: int, seed: int = 0) -> list[list[float]]:
    chance = np.random.default_rng(seed)
    middles = chance.normal(size=(groups, 64))
    return (middles[chance.integers(0, groups, count)] + 0.1 * chance.normal(size=(count, 64))).astype(np.float32).tolist()


def test_clusters_equal_a_plain_version(spark):
    rows = list(enumerate(vectors(400, 7)))
    assert report(spark, rows) == plain(rows)


def test_rows_of_all_kinds(spark):
    some = vectors(40, 3, seed=1)
    rows = [*enumerate(some), (3, some[3]), (3, some[9]), (None, some[5]), (None, some[6]), (100, None), (101, []), (102, some[0][:63]),
            (103, [*some[0][:63], None]), (104, [*some[0][:63], math.nan]), (105, [*some[0][:63], math.inf]), (106, [0.0] * 64),
            (107, [-0.001] * 64), (108, some[0] + [1.0])]
    assert report(spark, rows) == plain(rows)


def test_few_equal_and_no_vectors(spark):
    one = vectors(1, 1)[0]
    for rows in ([(1, one)], [(i, one) for i in range(50)], [(1, None)], []):
        assert report(spark, rows) == plain(rows)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 4)] + [0.0] * 63) for i in range(60)] + [(1000 + i, [(i % 7) / 2] + [0.0] * 63) for i in range(20)]
    assert report(spark, rows) == plain(rows)


def test_components_too_large_for_a_long(spark):
    rows = [(i, [(-1.0) ** i * 10.0 ** (i % 38)] * 64) for i in range(60)]
    assert report(spark, rows) == plain(rows)


def test_other_settings(spark):
    rows = [(i, vector[:5]) for i, vector in enumerate(vectors(200, 5))]
    assert report(spark, rows, width=5, clusters=4, rounds=1) == plain(rows, width=5, clusters=4, rounds=1)


def test_bounds_hold_and_leave_few_comparisons():
    points = np.floor(64 * np.array(vectors(500, 16, seed=2))).astype(np.int64)
    centroids = points[:16]
    simplex = Simplex(centroids)
    assert len(simplex.pivots) > 4
    apexes, others = simplex.apexes(points), simplex.apexes(centroids)
    low, high = bounds(apexes, others)
    exact = squares(points.astype(float), centroids.astype(float))
    room = simplex.room(apexes)[:, None] + simplex.room(others)
    assert (low - room <= exact).all() and (exact <= high + room).all()
    chosen, best, compared = nearest(simplex, points, apexes, centroids, others)
    assert (best == exact.min(axis=1)).all() and (chosen == exact.argmin(axis=1)).all()
    assert compared < 0.5 * exact.size


def test_a_simplex_of_pivots_in_one_line():
    points = np.outer(np.arange(10), np.ones(64, np.int64))
    simplex = Simplex(points)
    assert len(simplex.pivots) == 2
    low, high = bounds(simplex.apexes(points), simplex.apexes(points))
    exact = squares(points.astype(float), points.astype(float))
    assert (abs(low - exact) < 1e-3).all() and (abs(high - exact) < 1e-3).all()
