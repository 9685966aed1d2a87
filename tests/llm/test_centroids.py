import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from irspark.llm.centroids import History, centroid_clusters, reassign, squared_distances

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int"


def brute(rows, clusters, rounds, components, scale=64, seed=1):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    name = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, name(r[0]), np.array(r[1], "<i4").tobytes()))
    centroids = [q for _, q in order[:clusters]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for step in range(rounds + 1):
        at = [min((dist(q, c), j) for j, c in enumerate(centroids)) for _, q in kept]
        if step < rounds:
            for j in range(len(centroids)):
                mine = [q for (_, q), (_, a) in zip(kept, at) if a == j]
                if mine:
                    centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    total = [sum(d for d, a in at if a == j) for j in range(len(centroids))]
    return sorted(((i, a, d, total[a], sum(total), tuple(centroids[a])) for (i, _), (d, a) in zip(kept, at)), key=str)


def vectors(seed, n, components, spread=1.0, grid=None):
    rng = random.Random(seed)
    hubs = [[rng.gauss(0, spread) for _ in range(components)] for _ in range(5)]
    out = []
    for i in range(n):
        v = [x + rng.gauss(0, 0.4) for x in rng.choice(hubs)]
        out.append((i, [round(x * grid) / grid for x in v] if grid else v))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 0) for i, v in rows], SCHEMA).repartition(4)


def found(df):
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], tuple(r["centroid"]))
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("case", [
    (vectors(1, 300, 6), 7, 3),
    (vectors(2, 200, 3, grid=2), 9, 5),                      # a coarse grid: many ties
    (vectors(3, 150, 4, spread=1000.0), 5, 2),               # beyond the range of exact doubles
    ([(i, [1.0, 2.0]) for i in range(40)], 3, 2),            # all alike: clusters 1 and 2 stay empty
    (vectors(4, 4, 5), 16, 3),                               # fewer vectors than centroids
    (vectors(5, 30, 4), 4, 0),
])
def test_equals_brute_force(spark, case):
    rows, clusters, rounds = case
    rows = rows + rows[:5]                                   # repeated rows
    d = len(rows[0][1])
    rows += [(900, None), (901, [0.5] * (d - 1)), (902, [0.5] * (d - 1) + [None]), (903, [float("nan")] * d),
             (904, [float("-inf")] * d), (905, []), (None, [0.25] * d)]
    got = centroid_clusters(frame(spark, rows), clusters, rounds, d)
    assert found(got) == brute(rows, clusters, rounds, d)


def test_bounds_spare_evaluations_and_use_the_total_displacement(spark):
    rows = vectors(6, 600, 8, spread=2.0)
    got = centroid_clusters(frame(spark, rows), 12, 6, 8)
    assert found(got) == brute(rows, 12, 6, 8)
    evaluated = got.agg(F.avg("evaluated")).first()[0]
    assert 12 < evaluated < 0.6 * 12 * 7
    # a centroid that comes back has no displacement, whatever it drifted: nothing is evaluated
    a, b = np.array([[0, 0], [100, 0]]), np.array([[40, 0], [60, 0]])
    history = History(a)
    x = np.array([[10, 3], [80, -5]])
    d = np.sqrt(squared_distances(x, a).astype(float))
    history.add(b)
    history.add(a)
    state = reassign(x, np.array([0, 1]), d[[0, 1], [0, 1]], np.zeros(2, int), d, np.zeros((2, 2), int), np.full(2, 2), history)
    assert state[0].tolist() == [0, 1] and state[5].tolist() == [2, 2]


@pytest.mark.parametrize("top", [10, 1 << 22, 1 << 27])
def test_distances_are_exact(top):
    rng = np.random.default_rng(top)
    x, c = rng.integers(-top, top, (50, 64)), rng.integers(-top, top, (5, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]
    assert squared_distances(x, c).tolist() == want


def test_edges(spark):
    none = centroid_clusters(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and none.columns == centroid_clusters(frame(spark, [(1, [0.0] * 64)])).columns
    with pytest.raises(Exception, match="after scaling"):
        centroid_clusters(frame(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])).collect()
