import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tilecast.plans.boosting import BoostedTrees, thresholds_of


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    level, a, b = rng.integers(0, 6, 3000), rng.random(3000), rng.integers(0, 4, 3000) * 1.0
    y = np.array([3.0, -1.0, 4.0, 0.5, -2.0, 1.0])[level] + 5 * a * (b > 1) + rng.random(3000)
    table = [(i, "abcdef"[v], float(p), float(q), float(w)) for i, (v, p, q, w) in enumerate(zip(level, a, b, y))]
    raw = spark.createDataFrame(table, "id int, level string, a double, b double, label double").repartition(3)
    stages = [StringIndexer(inputCol="level", outputCol="n"), VectorAssembler(inputCols=["n", "a", "b"], outputCol="features")]
    return Pipeline(stages=stages).fit(raw).transform(raw).cache()


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_trees_are_those_of_spark_ml(rows, depth):
    want = GBTRegressor(maxIter=12, maxDepth=depth, stepSize=0.3, seed=1, predictionCol="want").fit(rows)
    got = BoostedTrees(12, depth, 0.3, 1, "label", "got").fit(rows)
    both = want.transform(got.transform(rows))
    assert both.agg(F.max(F.abs(F.col("want") - F.col("got")))).first()[0] < 1e-9
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray())


def test_a_pass_holds_a_byte_per_feature_and_eight_for_the_rest(rows):
    held = []

    class Watched(BoostedTrees):
        def _grow(self, blocks, *args):
            held.extend((len(r.bins), len(r.rest)) for r in blocks.collect())
            return super()._grow(blocks, *args)

    Watched(2, 2, 0.1, 1, "label", "got").fit(rows)
    assert sum(a for a, _ in held) == 3 * 3000 and sum(b for _, b in held) == 8 * 3000


def test_borders_lie_between_values_of_about_equal_counts():
    assert list(thresholds_of(np.array([1.0, 3.0, 3.0, 7.0]), 31)) == [2.0, 5.0]
    assert len(thresholds_of(np.arange(1000.0), 31)) == 31


def test_too_many_levels_and_no_rows_are_refused(rows):
    with pytest.raises(ValueError, match="levels"):
        BoostedTrees(1, 1, 0.1, 1, "label", "got", max_bins=4).fit(rows)
    with pytest.raises(ValueError, match="rows"):
        BoostedTrees(1, 1, 0.1, 1, "label", "got").fit(rows.filter("id < 0"))
