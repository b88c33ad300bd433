"""Spark ML's Gaussian mixture, iterated over blocks of points.

Start, densities, updates and the end of a fit are those of Spark ML's GaussianMixture, from which the start
is taken. Only the way to the sums differs: points lie in blocks, one job per iteration sums the moments of
all components of all mixtures that are fitted side by side with numpy, and the driver sees one set of sums
per task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.stat import MultivariateGaussian
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.session import send_package

#: Points in a block, and points whose densities are held at once.
BLOCK, SLICE = 65_536, 2048
_EPSILON = 2.0**-52


@dataclass
class Components:
    """Weights, means and covariances, and the parts of the densities made of them."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    def __post_init__(self):
        found = [_root(c) for c in self.covariances]
        d = self.means.shape[1]
        self.roots = np.array([r for r, _ in found])
        self.constants = np.array([-0.5 * (d * math.log(2 * math.pi) + log_det) for _, log_det in found])

    def densities(self, x: np.ndarray) -> np.ndarray:
        """Weight times density at each point, one row per component; none is zero."""
        out = np.empty((len(self.weights), len(x)))
        for j, (mean, root) in enumerate(zip(self.means, self.roots)):
            z = (x - mean) @ root
            np.einsum("ij,ij->i", z, z, out=out[j])
        out *= -0.5
        out += self.constants[:, None]
        np.exp(out, out=out)
        out *= self.weights[:, None]
        out += _EPSILON
        return out


def _root(covariance: np.ndarray) -> tuple[np.ndarray, float]:
    """The root of the pseudo-inverse and the logarithm of the pseudo-determinant."""
    spectrum, vectors = np.linalg.eigh(covariance)
    kept = spectrum > _EPSILON * spectrum.max() * len(spectrum)
    if not kept.any():
        raise ValueError("a covariance has no direction with variance")
    return vectors * np.sqrt(np.divide(1.0, spectrum, out=np.zeros_like(spectrum), where=kept)), float(np.log(spectrum[kept]).sum())


def _to_blocks(d: int):
    """Points as blocks of whole rows."""

    def block(parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.concatenate(parts).tobytes()], pa.binary())], ["points"])

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            if len(x):
                parts.append(x)
                held += len(x) // d
            if held >= BLOCK:
                yield block(parts)
                parts, held = [], 0
        if parts:
            yield block(parts)

    return run


def _moments(mixtures: list[Components], d: int):
    """Per mixture: log-likelihood, and the sums of 1, x and the products of x that each component gets."""
    upper = np.triu_indices(d)

    def run(blocks):
        logs = np.zeros(len(mixtures))
        sums = [np.zeros((len(m.weights), 1 + d + len(upper[0]))) for m in mixtures]
        for block in blocks:
            points = np.frombuffer(block).reshape(-1, d)
            for begin in range(0, len(points), SLICE):
                x = points[begin : begin + SLICE]
                powers = np.concatenate([np.ones((len(x), 1)), x, x[:, upper[0]] * x[:, upper[1]]], axis=1)
                for i, m in enumerate(mixtures):
                    p = m.densities(x)
                    total = p.sum(axis=0)
                    logs[i] += np.log(total).sum()
                    p /= total
                    sums[i] += p @ powers
        yield logs, sums

    return run


def _updated(sums: np.ndarray, d: int) -> Components:
    mass, upper = sums[:, 0], np.triu_indices(d)
    means = sums[:, 1 : 1 + d] / mass[:, None]
    covariances = np.empty((len(mass), d, d))
    for j, (mean, products) in enumerate(zip(means, sums[:, 1 + d :])):
        covariances[j][upper] = (products - mass[j] * np.outer(mean, mean)[upper]) / mass[j]
        covariances[j].T[upper] = covariances[j][upper]
    return Components(mass / mass.sum(), means, covariances)


@dataclass
class Fitted:
    components: Components
    log_likelihood: float = -np.finfo(float).max
    before: float = 0.0
    steps: int = 0


class BlockMixture(Estimator):
    """``k`` components; ends after ``max_iter`` iterations or when one changes the log-likelihood by ``tol`` at most."""

    def __init__(self, k: int, seed: int, max_iter: int, tol: float, features: str = "features"):
        super().__init__()
        self.k, self.seed, self.max_iter, self.tol, self.features = k, seed, max_iter, tol, features

    def setFeaturesCol(self, value: str) -> BlockMixture:
        self.features = value
        return self

    def _fit(self, dataset: DataFrame) -> BlockMixtureModel:
        return fit_side_by_side([self], dataset)[0]

    def _start(self, dataset: DataFrame) -> Components:
        start = GaussianMixture(k=self.k, seed=self.seed, maxIter=0, tol=self.tol, featuresCol=self.features).fit(dataset)
        gaussians = start.gaussians
        means, covariances = ([f(g) for g in gaussians] for f in (lambda g: g.mean.toArray(), lambda g: g.cov.toArray()))
        return Components(np.array(start.weights), np.array(means), np.array(covariances))


def fit_side_by_side(estimators: Sequence[BlockMixture], dataset: DataFrame) -> list[BlockMixtureModel]:
    """The models of several estimators over the same column, in as many passes as the longest fit takes."""
    send_package(dataset.sparkSession)
    column = estimators[0].features
    found = [Fitted(e._start(dataset)) for e in estimators]
    d = found[0].components.means.shape[1]
    blocks = dataset.select(vector_to_array(column).alias("x")).mapInArrow(_to_blocks(d), "points binary")
    # pickled blocks go to the Python workers as they are held, without a turn through rows and Arrow
    blocks = blocks.rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
    while going := [
        f for e, f in zip(estimators, found) if f.steps < e.max_iter and abs(f.log_likelihood - f.before) > e.tol
    ]:
        parts = blocks.mapPartitions(_moments([f.components for f in going], d)).collect()
        for i, fit in enumerate(going):
            fit.components = _updated(sum(sums[i] for _, sums in parts), d)
            fit.before, fit.log_likelihood = fit.log_likelihood, float(sum(logs[i] for logs, _ in parts))
            fit.steps += 1
    blocks.unpersist()
    return [BlockMixtureModel(f, column) for f in found]


class BlockMixtureModel(Model):
    """A fitted mixture; rows are scored where they lie."""

    def __init__(self, fitted: Fitted, features: str):
        super().__init__()
        self.components, self.features = fitted.components, features
        self.log_likelihood, self.steps = fitted.log_likelihood, fitted.steps

    @property
    def gaussians(self) -> list[MultivariateGaussian]:
        c, d = self.components, self.components.means.shape[1]
        return [MultivariateGaussian(DenseVector(m), DenseMatrix(d, d, s.ravel())) for m, s in zip(c.means, c.covariances)]

    def getPredictionCol(self) -> str:
        return "prediction"

    def getProbabilityCol(self) -> str:
        return "probability"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Adds the probability of each component, an array, and the number of the most probable one."""
        components, d = self.components, self.components.means.shape[1]

        def score(x: pa.Array) -> pa.Array:
            points = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            p = np.empty((len(points), len(components.weights)))
            for begin in range(0, len(points), SLICE):
                found = components.densities(points[begin : begin + SLICE])
                p[begin : begin + SLICE] = (found / found.sum(axis=0)).T
            ends = pa.array(np.arange(len(points) + 1) * p.shape[1], pa.int32())
            return pa.ListArray.from_arrays(ends, pa.array(p.ravel()))

        score.__annotations__ = {"x": pa.Array, "return": pa.Array}
        p = F.col(self.getProbabilityCol())
        scored = dataset.withColumn(self.getProbabilityCol(), F.arrow_udf(score, "array<double>")(vector_to_array(self.features)))
        return scored.withColumn(self.getPredictionCol(), (F.array_position(p, F.array_max(p)) - 1).cast("int"))
