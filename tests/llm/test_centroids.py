"""k-means rounds against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest

from lexiloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string"


def plain(rows, k, rounds, components, scale, salt="1:"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) and abs(scale * x) < 1 << 26 for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{salt}{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))[::-1]

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[0], []).append(x)
        for j, members in groups.items():
            centres[j] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *nearest(x)) for i, x in kept]
    per = {}
    for _, j, d in found:
        per[j] = per.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, per[j], sum(per.values()), digest[j]) for i, j, d in found), key=str)


def rows_of(seed, n, components, spread):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(components)] for _ in range(7)]
    rows = [(i, [float(np.float32(m + rng.gauss(0, spread))) for m in rng.choice(middles)]) for i in range(n)]
    one = rows[3][1]
    return [*rows, *((1000 + i, one) for i in range(n // 3)), rows[5], (5, rows[6][1]), (None, rows[7][1])]


@pytest.mark.parametrize("seed, spread, rounds", [(1, 0.05, 3), (2, 0.6, 6)])
def test_rounds(spark, seed, spread, rounds):
    odd = [(2001, None), (2002, []), (2003, [0.5] * 7), (2004, [0.5] * 7 + [None]), (2005, [math.nan] * 8),
           (2006, [math.inf] + [0.1] * 7), (2007, [3e38] * 8), (2008, [0.5] * 9)]
    rows = [*rows_of(seed, 150, 8, spread), *odd]
    df = spark.createDataFrame([(*r, "mine", "mine") for r in rows], SCHEMA).repartition(5)
    got = centroids.clustered(df, k=6, rounds=rounds, components=8, scale=64)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 6, rounds, 8, 64)


def test_bounds_spare_evaluations(spark):
    rows = rows_of(3, 400, 8, 0.02)
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    points = centroids.points(df, 8, 64).cache()
    start = centroids.seeds(points, 6, "1:")
    state, _ = centroids.cluster(points, start, rounds=8)
    assert state.groupBy().sum("evaluated").first()[0] < points.count() * 2  # of six in the last round


def test_total_displacement_loosens_less_than_drifts():
    """A centroid that comes back has moved by nothing."""
    history = np.array([[[0, 0]], [[10, 0]], [[0, 0]]])
    assert centroids.displacements(history, history[-1])[:, 0].tolist() == [0, 10, 0]


def test_ties_go_to_the_smaller_number():
    x = np.array([[0, 0], [4, 0]])
    history = np.array([[[2, 0], [-2, 0], [2, 0]], [[-2, 0], [2, 0], [2, 0]]])
    cluster, found, when = centroids._start(x, history[0])
    assert cluster.tolist() == [0, 0]
    centroids.assign(x, cluster, found, when, history)
    assert cluster.tolist() == [0, 1]


def test_few_and_none(spark):
    few = spark.createDataFrame([(1, [1.0, 2.0], "", ""), (2, [5.0, 6.0], "", "")], SCHEMA)
    assert sorted(r.cluster for r in centroids.clustered(few, k=16, components=2).collect()) == [0, 1]
    none = centroids.clustered(few.limit(0), components=2)
    assert none.count() == 0 and none.columns == centroids.clustered(few, components=2).columns
