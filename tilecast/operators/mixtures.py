"""Gaussian mixtures by expectation-maximisation over grouped points, from given starting centres.

Equal points are one row with a weight. An iteration is one aggregate of plain column arithmetic for
all wanted numbers of components side by side: densities, their sum by the log-sum-exp rule, and the
weighted sums of each component, combined before the shuffle. Only parameters live on the driver. The
start is fixed by the data, and sums do not care about the order of rows, so a fit is repeatable.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.session import delete_tables, materialize, recorded

#: Added to every variance, so that a component without spread keeps a density.
FLOOR = 1e-6
_TINY = 1e-300


@dataclass
class Mixture:
    """Weights, means and covariances of the components over ``columns``, smallest mean first."""

    columns: list[str]
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = math.nan
    n: float = 0.0

    @property
    def free(self) -> int:
        k, d = self.means.shape
        return (k - 1) + k * d + k * d * (d + 1) // 2

    @property
    def aic(self) -> float:
        return 2.0 * self.free - 2 * self.log_likelihood

    @property
    def bic(self) -> float:
        return self.free * math.log(self.n) - 2 * self.log_likelihood

    def in_order(self) -> Mixture:
        order = sorted(range(len(self.means)), key=lambda j: list(self.means[j]))
        return Mixture(
            self.columns, self.weights[order], self.means[order], self.covariances[order], self.log_likelihood, self.n
        )

    def log_densities(self) -> list[Column]:
        """Each component's log of weight times density at the row's point."""
        d = len(self.columns)
        out = []
        for weight, mean, covariance in zip(self.weights, self.means, self.covariances, strict=True):
            lower = np.linalg.cholesky(covariance)
            whiten = np.linalg.inv(lower)
            off = [F.col(c) - float(m) for c, m in zip(self.columns, mean, strict=True)]
            sides = [_sum([off[i] * float(whiten[r, i]) for i in range(r + 1)]) for r in range(d)]
            log_det = 2 * float(np.log(np.diag(lower)).sum())
            constant = math.log(max(weight, _TINY)) - 0.5 * (d * math.log(2 * math.pi) + log_det)
            out.append(F.lit(constant) - 0.5 * _sum([s * s for s in sides]))
        return out


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _log_sum(logs: Sequence[Column]) -> Column:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    return top + F.log(_sum([F.exp(x - top) for x in logs]))


def _present(columns: Sequence[str]) -> Column:
    each = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns]
    return reduce(lambda a, b: a & b, each)


def group_points(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct points that lack no column, and how many rows each stands for: ``weight``."""
    rows = points.filter(_present(columns)).select(*[F.col(c).cast("double").alias(c) for c in columns])
    return rows.groupBy(*columns).agg(F.count("*").cast("double").alias("weight"))


def _whole(cells: DataFrame, columns: Sequence[str]) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Count, smallest and largest values, means and covariances of all points, in two aggregates."""
    ends = cells.agg(
        F.sum("weight").alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("low", F.min), ("high", F.max))],
        *[(F.sum(F.col("weight") * F.col(c)) / F.sum("weight")).alias(f"mean_{c}") for c in columns],
    ).first()
    low, high, mean = (np.array([ends[f"{name}_{c}"] for c in columns]) for name in ("low", "high", "mean"))
    if not ends["n"]:
        raise ValueError("a mixture needs points")
    d = len(columns)
    off = [F.col(c) - float(m) for c, m in zip(columns, mean, strict=True)]
    products = cells.agg(*[F.sum(F.col("weight") * off[i] * off[l]).alias(f"{i}_{l}") for i in range(d) for l in range(i + 1)]).first()
    covariance = np.array([[products[f"{max(i, l)}_{min(i, l)}"] for l in range(d)] for i in range(d)]) / ends["n"]
    return ends["n"], low, high, mean, covariance


def fit_mixtures(
    points: DataFrame,
    columns: Sequence[str],
    ks: Sequence[int],
    steps: int = 100,
    gain: float = 1e-3,
    starts: dict[int, Sequence[Sequence[float]]] | None = None,
) -> dict[int, Mixture]:
    """A mixture for each number of components in ``ks``.

    A fit ends after ``steps`` iterations, or when one gains less than ``gain`` in log-likelihood per
    point (0: never). Its centres start at ``starts[k]``, or evenly along the diagonal between the
    smallest and the largest values, all components with the covariance of all points.
    """
    columns = list(columns)
    with recorded() as written:
        cells = materialize(group_points(points, columns), "points")
        found = _iterate(cells, columns, list(ks), steps, gain, starts or {})
        delete_tables(points.sparkSession, written)
    return {k: found[k].in_order() for k in ks}


def _iterate(cells, columns, ks, steps, gain, starts) -> dict[int, Mixture]:
    n, low, high, _, covariance = _whole(cells, columns)
    floor = FLOOR * np.eye(len(columns))
    models = {}
    for k in ks:
        along = (np.arange(k)[:, None] + 0.5) / k
        means = np.array(starts[k], float) if k in starts else low + along * (high - low)
        models[k] = Mixture(columns, np.full(k, 1 / k), means, np.array([covariance + floor] * k), n=n)
    going = list(ks)
    for step in range(steps + 1):
        if not going:
            break
        sums = _expectation(cells, {k: models[k] for k in going}, last=step == steps)
        for k in list(going):
            now = sums[f"log_{k}"]
            gained = now - models[k].log_likelihood
            models[k].log_likelihood = now
            if step == steps or gained < gain * n and gain > 0:
                going.remove(k)
            else:
                models[k] = _maximised(models[k], sums, k, floor)
    return models


def _expectation(cells: DataFrame, models: dict[int, Mixture], last: bool) -> dict[str, float]:
    """Log-likelihoods, and the sums that the next parameters are made of, relative to the means."""
    logs = {k: m.log_densities() for k, m in models.items()}
    names = {k: [f"lp_{k}_{j}" for j in range(k)] for k in models}
    rows = cells.withColumns({name: x for k in models for name, x in zip(names[k], logs[k], strict=True)})
    rows = rows.withColumns({f"lse_{k}": _log_sum([F.col(x) for x in names[k]]) for k in models})
    out = [F.sum(F.col("weight") * F.col(f"lse_{k}")).alias(f"log_{k}") for k in models]
    if not last:
        shares = {f"r_{k}_{j}": F.col("weight") * F.exp(F.col(x) - F.col(f"lse_{k}")) for k in models for j, x in enumerate(names[k])}
        rows = rows.withColumns(shares)
        for k, model in models.items():
            for j in range(k):
                r = F.col(f"r_{k}_{j}")
                off = [F.col(c) - float(m) for c, m in zip(model.columns, model.means[j], strict=True)]
                out.append(F.sum(r).alias(f"n_{k}_{j}"))
                out += [F.sum(r * x).alias(f"s_{k}_{j}_{i}") for i, x in enumerate(off)]
                out += [F.sum(r * off[i] * off[l]).alias(f"q_{k}_{j}_{i}_{l}") for i in range(len(off)) for l in range(i + 1)]
    return rows.agg(*out).first().asDict()


def _maximised(model: Mixture, sums: dict[str, float], k: int, floor: np.ndarray) -> Mixture:
    d = len(model.columns)
    weights, means, covariances = model.weights.copy(), model.means.copy(), model.covariances.copy()
    for j in range(k):
        mass = sums[f"n_{k}_{j}"]
        weights[j] = mass / model.n
        if mass <= _TINY:  # nothing belongs to it any more: it stays where it is, without weight
            continue
        moved = np.array([sums[f"s_{k}_{j}_{i}"] for i in range(d)]) / mass
        products = np.array([[sums[f"q_{k}_{j}_{max(i, l)}_{min(i, l)}"] for l in range(d)] for i in range(d)])
        means[j] += moved
        covariances[j] = products / mass - np.outer(moved, moved) + floor
    return Mixture(model.columns, weights, means, covariances, model.log_likelihood, model.n)


def add_mixture(df: DataFrame, model: Mixture, id_col: str, prob_col: str | None = None) -> DataFrame:
    """Add each row's most probable component, smallest centre first, and its probability.

    Plain columns: rows are scored where they lie. A row that lacks one of the columns gets NULL.
    """
    inputs = df.withColumns({f"_m_{c}": F.col(c).cast("double") for c in model.columns})
    named = Mixture([f"_m_{c}" for c in model.columns], model.weights, model.means, model.covariances)
    inputs = inputs.withColumn("_logs", F.when(_present(model.columns), F.array(*named.log_densities())))
    best = F.array_max("_logs")
    new = {id_col: (F.array_position("_logs", best) - 1).cast("int")}
    if prob_col:
        total = F.aggregate("_logs", F.lit(0.0), lambda s, x: s + F.exp(x - best))
        new[prob_col] = 1 / total
    return inputs.withColumns(new).drop("_logs", *named.columns)


def mixture_table(models: dict[int, Mixture], df: DataFrame) -> DataFrame:
    """``k``, ``aic`` and ``bic`` of fitted mixtures."""
    rows = [(k, float(m.aic), float(m.bic)) for k, m in sorted(models.items())]
    return df.sparkSession.createDataFrame(rows, "k int, aic double, bic double")
