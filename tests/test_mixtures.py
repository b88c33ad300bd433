import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast.operators import mixtures


def by_hand(x, k, steps, floor=mixtures.FLOOR):
    """Plain EM over all rows, one by one: weights, means, covariances, log-likelihood."""
    low, high, d = x.min(0), x.max(0), x.shape[1]
    means = low + (np.arange(k)[:, None] + 0.5) / k * (high - low)
    covs = np.array([np.cov(x.T, bias=True).reshape(d, d) + floor * np.eye(d)] * k)
    weights = np.full(k, 1 / k)

    def shares():
        p = np.column_stack([
            w * np.exp(-0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)) / math.sqrt((2 * math.pi) ** d * np.linalg.det(c))
            for w, m, c in zip(weights, means, covs, strict=True)
        ])
        return p / p.sum(1, keepdims=True), float(np.log(p.sum(1)).sum())

    for _ in range(steps):
        r, _ = shares()
        mass = r.sum(0)
        weights, means = mass / len(x), r.T @ x / mass[:, None]
        covs = np.array([(r[:, j, None] * (x - means[j])).T @ (x - means[j]) / mass[j] + floor * np.eye(d) for j in range(k)])
    order = sorted(range(k), key=lambda j: list(means[j]))
    r, log = shares()
    return weights[order], means[order], covs[order], log, r[:, order]


def clouds(seed=4, d=2):
    rng = np.random.default_rng(seed)
    return np.round(np.vstack([rng.normal(m, 1 + m / 10, (150, d)) for m in (0, 5, 14)]), 1) + np.arange(d) * 100


def frame(spark, x, parts=3):
    return spark.createDataFrame([tuple(map(float, p)) for p in x], ", ".join(f"c{i} double" for i in range(x.shape[1]))).repartition(parts)


@pytest.mark.parametrize("d", [1, 2, 3])
def test_same_as_by_hand_for_all_k_side_by_side(spark, d):
    x = clouds(d=d)
    columns = [f"c{i}" for i in range(d)]
    found = mixtures.fit_mixtures(frame(spark, x), columns, [1, 2, 3], steps=7, gain=0)
    for k, model in found.items():
        weights, means, covs, log, _ = by_hand(x, k, 7)
        assert np.allclose(model.weights, weights) and np.allclose(model.means, means) and np.allclose(model.covariances, covs)
        assert model.log_likelihood == pytest.approx(log) and model.n == len(x)
        free = (k - 1) + k * d + k * d * (d + 1) / 2
        assert model.aic == pytest.approx(2 * free - 2 * log) and model.bic == pytest.approx(free * math.log(len(x)) - 2 * log)


def test_labels_and_probabilities(spark):
    x = clouds()
    df = frame(spark, x)
    model = mixtures.fit_mixtures(df, ["c0", "c1"], [3], steps=10, gain=0)[3]
    *_, shares = by_hand(x, 3, 10)
    want = {tuple(map(float, p)): (int(r.argmax()), r.max()) for p, r in zip(x, shares, strict=True)}
    got = mixtures.add_mixture(df, model, "c", "p").collect()
    assert len(got) == len(x)
    for r in got:
        c, p = want[r.c0, r.c1]
        assert r.c == c and r.p == pytest.approx(p)


def test_a_fit_does_not_depend_on_the_order_of_rows(spark):
    x = clouds(9)
    a = mixtures.fit_mixtures(frame(spark, x, 1), ["c0", "c1"], [3])[3]
    b = mixtures.fit_mixtures(frame(spark, x[::-1], 7), ["c0", "c1"], [3])[3]
    assert np.allclose(a.means, b.means, atol=1e-9) and a.log_likelihood == pytest.approx(b.log_likelihood)


def test_stops_by_gain_and_starts_where_told(spark):
    x = clouds()
    starts = {3: [[14, 114], [0, 100], [5, 105]]}
    model = mixtures.fit_mixtures(frame(spark, x), ["c0", "c1"], [3], starts=starts)[3]
    assert np.allclose(model.means[:, 0], [0, 5, 14], atol=0.5)
    scores = mixtures.mixture_table(mixtures.fit_mixtures(frame(spark, x), ["c0", "c1"], [1, 2, 3, 4]), frame(spark, x)).toPandas()
    assert list(scores.k) == [1, 2, 3, 4] and scores.bic.idxmin() == 2


def test_missing_values_constant_columns_and_no_points(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, 1.0), (float("nan"), 1.0), (1.0, 9.0)], "c0 double, c1 double")
    model = mixtures.fit_mixtures(df, ["c0", "c1"], [2], steps=3)[2]
    assert model.n == 3 and np.isfinite(model.log_likelihood)
    got = mixtures.add_mixture(df, model, "c", "p")
    assert got.columns == ["c0", "c1", "c", "p"]
    assert got.filter("c is null and p is null").count() == 2
    with pytest.raises(ValueError, match="needs points"):
        mixtures.fit_mixtures(df.filter(F.lit(False)), ["c0"], [1])
