import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from tilecast.plans import block_forest
from tilecast.plans import estimators as est
from tilecast.plans.block_forest import BlockForest, BlockForestModel, poisson_weights


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    level, a, b = rng.integers(0, 6, 3000), rng.random(3000), rng.integers(0, 4, 3000) * 1.0
    y = np.array([3.0, -1.0, 4.0, 0.5, -2.0, 1.0])[level] + 5 * a * (b > 1) + rng.random(3000)
    y[b == 1] = 0.0
    table = [(i, "abcdef"[v], float(p), float(q), float(w)) for i, (v, p, q, w) in enumerate(zip(level, a, b, y))]
    raw = spark.createDataFrame(table, "id int, level string, a double, b double, label double").repartition(3)
    stages = [StringIndexer(inputCol="level", outputCol="n"), VectorAssembler(inputCols=["n", "a", "b"], outputCol="features")]
    return Pipeline(stages=stages).fit(raw).transform(raw).cache()


def root_mean_square(scored, column):
    return scored.agg(F.sqrt(F.avg((F.col("label") - F.col(column)) ** 2))).first()[0]


@pytest.mark.parametrize("depth", [1, 4, 9])
def test_without_draws_the_trees_are_those_of_spark_ml(rows, depth):
    want = RandomForestRegressor(
        numTrees=2, maxDepth=depth, seed=1, bootstrap=False, featureSubsetStrategy="all", predictionCol="want"
    ).fit(rows)
    got = BlockForest(2, depth, 1, "label", "got", share=1.0, bootstrap=False).fit(rows)
    both = want.transform(got.transform(rows))
    assert both.agg(F.max(F.abs(F.col("want") - F.col("got")))).first()[0] < 1e-9
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray())


def test_with_draws_the_forest_explains_as_much_as_spark_mls(rows):
    want = RandomForestRegressor(numTrees=40, maxDepth=6, seed=1, predictionCol="want").fit(rows)
    got = BlockForest(40, 6, -1, "label", "got").fit(rows)
    both = want.transform(got.transform(rows))
    assert root_mean_square(both, "got") == pytest.approx(root_mean_square(both, "want"), rel=0.1)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=0.1)


def test_weights_are_poisson_and_fixed_by_their_key():
    weights = poisson_weights([1, 2, 3], 400_000)
    assert (weights == poisson_weights([1, 2, 3], 400_000)).all()
    assert (weights[:1000] != poisson_weights([1, 2, 4], 1000)).any()
    assert weights.mean() == pytest.approx(1, abs=0.01) and weights.var() == pytest.approx(1, abs=0.02)
    assert (weights == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)


def test_passes_over_parts_of_the_nodes_grow_the_same_trees(rows, monkeypatch):
    whole = BlockForest(3, 5, 1, "label", "whole").fit(rows)
    monkeypatch.setattr(block_forest, "CELLS", 600)
    parts = BlockForest(3, 5, 1, "label", "parts").fit(rows)
    both = parts.transform(whole.transform(rows))
    assert both.filter("whole != parts").count() == 0


def test_a_pass_holds_a_byte_per_feature_and_eight_for_the_label(rows):
    held = []

    class Watched(BlockForest):
        def _grow(self, blocks, *args):
            held.extend((len(r.bins), len(r.rest)) for r in blocks.collect())
            return super()._grow(blocks, *args)

    Watched(5, 2, 1, "label", "got").fit(rows)
    assert sum(a for a, _ in held) == 3 * 3000 and sum(b for _, b in held) == 8 * 3000


def test_levels_never_seen_go_right(rows, spark):
    model = BlockForest(2, 3, 1, "label", "got", share=1.0, bootstrap=False).fit(rows)
    odd = spark.createDataFrame([(99.0, 0.5, 2.0)], "n double, a double, b double")
    odd = VectorAssembler(inputCols=["n", "a", "b"], outputCol="features").transform(odd)
    assert model.transform(odd).filter("got is not null and not isnan(got)").count() == 1


def test_large_tables_are_grown_over_blocks_small_ones_by_spark_ml(rows, monkeypatch):
    plain = rows.select("a", "b", "label")

    def fitted():
        return Pipeline(stages=est.forest([], ["a", "b"], n_trees=2, depth=2)).fit(plain).stages[-1]

    assert isinstance(fitted(), RandomForestRegressionModel)
    monkeypatch.setattr(block_forest, "SPARK_ML_ROWS", 2999)
    assert isinstance(fitted(), BlockForestModel)
