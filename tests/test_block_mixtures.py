import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tilecast.operators import block_mixtures
from tilecast.operators.block_mixtures import BlockMixture, fit_side_by_side


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(m, s, (400, 3)) for m, s in ((0, 1), (6, 2), (15, 1))])
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(3)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows).cache()


@pytest.mark.parametrize("k", [2, 3, 5])
def test_fits_are_those_of_spark_ml(points, k):
    want = GaussianMixture(k=k, seed=1, maxIter=40, tol=0.5).fit(points)
    got = BlockMixture(k, 1, 40, 0.5).fit(points)
    assert got.steps == want.summary.numIter
    assert got.log_likelihood == pytest.approx(want.summary.logLikelihood, rel=1e-9)
    assert got.components.weights == pytest.approx(np.array(want.weights), rel=1e-6)
    for a, b in zip(got.gaussians, want.gaussians):
        assert a.mean.toArray() == pytest.approx(b.mean.toArray(), rel=1e-6)
        assert a.cov.toArray() == pytest.approx(b.cov.toArray(), abs=1e-6)
    names = [F.col("prediction").alias("n"), F.col("probability").alias("p")]
    mine = got.transform(points).select("features", *names)
    theirs = want.transform(points).select("features", names[0], vector_to_array("probability").alias("q"))
    both = mine.withColumnRenamed("n", "m").join(theirs, "features")
    off = F.aggregate(F.zip_with("p", "q", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, v: s + v)
    assert both.agg(F.max(off), F.sum((F.col("n") != F.col("m")).cast("int"))).first() == (pytest.approx(0, abs=1e-6), 0)


def test_fits_side_by_side_share_their_passes(points, monkeypatch):
    passes = []
    moments = block_mixtures._moments
    monkeypatch.setattr(block_mixtures, "_moments", lambda mixtures, d: passes.append(len(mixtures)) or moments(mixtures, d))
    many = [BlockMixture(k, 1, 30, 0.5) for k in (2, 3, 4)]
    together = fit_side_by_side(many, points)
    assert len(passes) == max(m.steps for m in together) and passes[0] == 3
    for estimator, model in zip(many, together):
        alone = estimator.fit(points)
        assert (alone.steps, alone.log_likelihood) == (model.steps, pytest.approx(model.log_likelihood))
