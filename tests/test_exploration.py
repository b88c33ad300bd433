import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast.operators import exploration, selection
from tilecast.schema import KEYS


def test_automatic_bins(spark):
    rng = np.random.default_rng(2)
    for values in (rng.lognormal(size=500), rng.normal(size=40), np.r_[np.zeros(80), 1.0, 5.0], np.full(9, 3.0)):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
        got = exploration.auto_histogram(df, "x").orderBy("bin").collect()
        q1, q3 = np.quantile(values, [0.25, 0.75])
        spread = values.max() - values.min()
        bins = math.ceil(spread / (2 * (q3 - q1) / len(values) ** (1 / 3))) if q3 > q1 else int(math.sqrt(len(values)))
        bins = max(min(bins, 50), 1)
        assert [r.bin for r in got] == list(range(1, bins + 1))
        assert sum(r.n for r in got) == len(values)
        if spread:
            assert [r.n for r in got] == np.histogram(values, bins)[0].tolist()
            assert got[0].low == values.min() and got[-1].high == pytest.approx(values.max())
    assert exploration.auto_histogram(spark.createDataFrame([], "x double"), "x").count() == 0


def test_kernel_density_against_the_formula(spark):
    rng = np.random.default_rng(5)
    x = rng.normal([10, -3], [1, 4], (200, 2))
    df = spark.createDataFrame([tuple(map(float, p)) for p in x], "lat double, long double").repartition(3)
    got = exploration.kernel_density(df).collect()
    assert sum(r.mass for r in got) == pytest.approx(1)
    width = x.std(0, ddof=1) * len(x) ** (-1 / 6)
    true = lambda p: np.exp(-0.5 * (((x - p) / width) ** 2).sum(1)).sum() / (len(x) * 2 * math.pi * width.prod())
    high = [r for r in got if r.density > 0.3 * max(g.density for g in got)]
    assert len(high) > 20
    for r in high:
        assert r.density == pytest.approx(true([r.lat, r["long"]]), rel=0.05)
        assert r.density == pytest.approx(r.mass / (width.prod() / 16))


def test_kernel_density_of_few_points(spark):
    one = exploration.kernel_density(spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "lat double, long double")).collect()
    assert [(r.lat_cell, r.long_cell, r.mass, r.density) for r in one] == [(0, 0, 1.0, None)]
    line = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "lat double, long double")
    assert sum(r.mass for r in exploration.kernel_density(line).collect()) == pytest.approx(1)
    assert exploration.kernel_density(line.filter(F.lit(False))).count() == 0


def test_bootstrap_bands(spark):
    rng = np.random.default_rng(7)
    rows = [(i, int(i % 3), float(v)) for i, v in enumerate(rng.normal(5, 2, 900))] + [(900, 1, None), (901, 9, 4.0)]
    df = spark.createDataFrame(rows, "id int, x int, v double")
    got = {r.x: r for r in exploration.bootstrap_bands(df, "x", "v", keys=["id"], replicates=80).collect()}
    again = exploration.bootstrap_bands(df.repartition(7).orderBy(F.desc("id")), "x", "v", keys=["id"], replicates=80)
    for r in again.collect():
        assert [r.n, r["mean"], r.low, r.high] == pytest.approx([got[r.x].n, got[r.x]["mean"], got[r.x].low, got[r.x].high])
    for x in range(3):
        values = np.array([v for _, k, v in rows if k == x and v is not None])
        half = 1.96 * values.std(ddof=1) / math.sqrt(len(values))
        assert got[x]["mean"] == pytest.approx(values.mean())
        assert got[x].low == pytest.approx(values.mean() - half, abs=0.12)
        assert got[x].high == pytest.approx(values.mean() + half, abs=0.12)
    assert got[9].low == got[9].high == 4.0


def test_poisson_weights_have_mean_and_variance_one(spark):
    df = spark.range(20_000).withColumn("one", F.lit(1.0)).withColumn("g", F.lit(0))
    sums = exploration.bootstrap_bands(df.withColumn("v", F.col("id") % 2 * 1.0), "g", "v", keys=["id"], replicates=80).first()
    assert sums.high - sums.low == pytest.approx(2 * 1.96 * 0.5 / math.sqrt(20_000), rel=0.35)


@pytest.mark.parametrize("share", [0.0, 0.2, 0.37, 1.0])
def test_exact_sizes(demand, share):
    from tilecast.functions.calendar import with_clock

    rows = with_clock(demand)
    n = rows.count()
    train, test = selection.exact_split(rows, share)
    assert test.count() == int(share * n) and train.count() == n - int(share * n)
    assert train.columns == test.columns == rows.columns
    assert train.join(test, KEYS).count() == 0
    again = selection.exact_sample(rows.repartition(7).orderBy(F.desc("demand")), share)
    assert test.exceptAll(again).count() == 0


def test_exact_size_with_one_key_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, float(i % 4)) for i in range(100)], "k int, v double").repartition(5)
    train, test = selection.exact_split(df, 0.33, keys=["k"])
    assert (test.count(), train.count()) == (33, 67)
    assert test.unionByName(train).exceptAll(df).count() == 0
