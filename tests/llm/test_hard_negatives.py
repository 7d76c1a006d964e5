"""Hard negatives against plain Python."""

import math
import random

import numpy as np
import pytest

from lexiloom.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string"
LIMIT = 1 << hard_negatives.LIMIT_BITS


def plain(rows, every, k, n, least, most):
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v is not None
            and all(x is not None and math.isfinite(x) and abs(256 * x) < LIMIT for x in v)]
    out = []
    for i, label, x in kept:
        if i % every:
            continue
        scored = sorted(((sum(a * b for a, b in zip(x, y)), j, other == label) for j, other, y in kept if j != i),
                        key=lambda s: (-s[0], s[1]))
        for score, j, _ in [s for s in scored if s[2]][:k]:
            found = [s for s in scored if not s[2] and least * score <= 100 * s[0] <= most * score][:n]
            out += [(i, j, place, s[1], score, s[0]) for place, s in enumerate(found, 1)]
    return sorted(out)


def corpus(seed, n, spread):
    rng = random.Random(seed)
    middles = [[rng.uniform(-0.2, 0.3) for _ in range(20)] for _ in range(4)]
    rows = []
    for i in range(n):
        m = rng.randrange(4)
        rows.append((i, [float(np.float32(x + rng.gauss(0, spread))) for x in middles[m]], m if rng.random() < 0.7 else rng.randrange(4)))
    hot = rows[1][1]
    copies = [(1000 + i, hot, i % 3) for i in range(n // 3)]
    odd = [(None, hot, 1), (5000, None, 1), (5001, hot, None), (5002, [None] * 20, 1), (5003, [math.nan] * 20, 1), (5004, [math.inf] * 20, 1),
           (5005, [3e38] * 20, 2), (5006, [], 2), (5007, [0.5, -0.5, 0.25], 3), (5010, [-0.2] * 20, 1), (5020, hot + [1.0], 2)]
    return [*rows, *copies, *odd]


@pytest.mark.parametrize("seed, spread, sizes", [(1, 0.02, (4096, 4096, 64)), (2, 0.3, (37, 11, 5))])
def test_all_anchors(spark, monkeypatch, seed, spread, sizes):
    for name, size in zip(("PART", "STRIP", "CHUNK"), sizes):
        monkeypatch.setattr(hard_negatives, name, size)
    rows = corpus(seed, 150, spread)
    df = spark.createDataFrame([(*r, "mine", "mine") for r in rows], SCHEMA).repartition(4)
    got = hard_negatives.mine(hard_negatives.prepared(df, 256), "vec_id % 10 = 0")
    assert sorted(map(tuple, got.collect())) == plain(rows, 10, 5, 10, 30, 90)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(3)
    x = (rng.normal(0, 100, (40, 32)) + rng.normal(0, 200, 40)[:, None]).astype(np.int32)
    rows = object.__new__(hard_negatives.Rows)
    rows.x, rows.norm = x, np.sqrt((x.astype(float) ** 2).sum(1))
    rows.levels = {level: hard_negatives.summaries(x, level) for level in hard_negatives.LEVELS}
    exact, widths = hard_negatives.scores(rows, rows), []
    for level in hard_negatives.LEVELS:
        low, high = hard_negatives.bounds(rows, rows, level)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
    assert widths[1] < widths[0]


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2.0**18 - 1 - i)] * 3, i % 2) for i in range(0, 40, 5)] + [(3, [157286.0] * 3, 1)]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    got = hard_negatives.mine(hard_negatives.prepared(df, 256), "vec_id % 10 = 0")
    assert sorted(map(tuple, got.collect())) == plain(rows, 10, 5, 10, 30, 90) != []


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(hard_negatives.prepared(none, 256), "vec_id % 10 = 0").count() == 0
