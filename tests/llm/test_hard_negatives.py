import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int, part string, score double"


def by_brute_force(rows, positives=5, negatives=3, low=50, high=95):
    """rows: (vec_id, embedding, label), one per id; all anchors against all rows."""
    base = {}
    for d, v, y in rows:
        if d is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            base[d] = ((y + 1) % 10 if d % 7 == 0 else y, [math.floor(256 * float(np.float32(x))) for x in v])
    out = []
    for a, (label, q) in base.items():
        if a % 50:
            continue
        found = sorted((-sum(x * y for x, y in zip(q, v)), d, y == label) for d, (y, v) in base.items() if d != a)
        for p in [f for f in found if f[2]][:positives]:
            inside = [f for f in found if not f[2] and low * -p[0] <= 100 * -f[0] <= high * -p[0]]
            out += [(a, p[1], k + 1, f[1], -p[0], -f[0]) for k, f in enumerate(inside[:negatives])]
    return sorted(out)


def mined(spark, rows, parts=4):
    full = [(d, v, y, "p", 0.5) for d, v, y in rows]
    return sorted(tuple(r) for r in hard.mine_digest(spark.createDataFrame(full, SCHEMA).repartition(parts)).collect())


def clustered(n=900, dim=8, seed=1):
    """Near copies of a few directions, of very different norms, with ties and zero vectors."""
    rng = np.random.default_rng(seed)
    tops = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = tops[rng.integers(12)] * rng.choice([0.1, 1.0, 3.0]) + rng.normal(size=dim) * rng.choice([0.0, 0.05, 0.8])
        rows.append((i, [float(x) for x in (v if i % 97 else v * 0)], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("rows_of_a_tree", [64, 200, 4096])
def test_against_brute_force(spark, monkeypatch, rows_of_a_tree):
    monkeypatch.setattr(hard, "ROWS", rows_of_a_tree)
    monkeypatch.setattr(hard, "LEAF", 4)
    monkeypatch.setattr(hard, "BLOCK", 7)
    monkeypatch.setattr(hard, "BATCH", 3)
    rows = clustered()
    want = by_brute_force(rows)
    assert mined(spark, rows) == want and len(want) > 100


def test_a_third_of_the_rows_are_one_vector(spark, monkeypatch):
    monkeypatch.setattr(hard, "ROWS", 50)
    rows = clustered(400) + [(1000 + i, [1.0] * 8, i % 2) for i in range(250)]
    assert mined(spark, rows) == by_brute_force(rows)


def test_bounds_hold_and_skip_leaves():
    rng = np.random.default_rng(4)
    x = np.floor(256 * np.concatenate([t + 0.05 * rng.normal(size=(100, 16)) for t in rng.normal(size=(20, 16))]))
    most = float(np.linalg.norm(x, axis=1).max())
    tree = hard.CoverTree(np.arange(len(x)), np.zeros(len(x), np.int64), x, most)
    q = x[:50]
    scores = q @ tree.x.T
    upper = tree.bounds(q, np.full(50, -np.inf), np.full(50, np.inf))
    cuts = np.split(np.arange(len(x)), tree.ends[:-1])
    assert len(cuts) >= 20 and len(tree.levels) > 1
    assert all((scores[:, c].max(1) <= upper[:, k] + 1e-6).all() for k, c in enumerate(cuts))
    low, high = scores.max(1) * 0.5, scores.max(1) * 0.9
    within = tree.bounds(q, low, high) > -np.inf
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    for k, c in enumerate(cuts):
        assert (within[:, k] | ~inside[:, c].any(1)).all()
    assert within.mean() < 0.5  # most leaves lie wholly outside the windows


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5], 1), (50, [0.0, 0.0], 1), (100, None, 1), (150, [1.0, None], 1), (200, [float("nan"), 1.0], 2),
        (250, [float("inf"), 1.0], 2), (300, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (1, [1.0, 0.4], 2), (2, [0.5, 0.5], 2),
        (3, [0.5, 0.5], 3), (4, [0.4, 0.4], 3), (5, [-1.0, -1.0], 2), (-50, [0.3, 0.9], 1), (7, [0.9, 0.9], 1), (350, [], 0),
        (6, [0.7], 2),
    ]
    padded = [(d, v if v is None or len(v) == 2 else [*v, *[0.0] * (2 - len(v))], y) for d, v, y in rows]
    assert mined(spark, rows) == by_brute_force(padded)
    assert mined(spark, rows + rows) == by_brute_force(padded)  # repeated rows are one
    assert mined(spark, []) == [] and mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []  # no anchor


def test_other_numbers_of_positives_and_negatives(spark):
    rows = [(d, v, y) for d, v, y in clustered(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    base = hard.whole_numbers(df, "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")), "embedding")
    found = hard.mine(base, F.col("vec_id") % 50 == 0, positives=2, negatives=6, low=10, high=70)
    assert sorted(tuple(r) for r in found.collect()) == by_brute_force(rows, 2, 6, 10, 70)
