from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tilecast.operators import encoding, selection
from tilecast.operators.selection import hash_rank
from tilecast.plans import estimators
from tilecast.plans.forecasters import EncodedForecaster


def by_hand(rows, prior):
    """rows: (hash, level, y), any order: the drawn mean over earlier rows of the level, by hash."""
    known = [y for *_, y in rows if y is not None]
    overall, out = sum(known) / len(known), {}
    groups = defaultdict(list)
    for h, level, y in rows:
        groups[level].append((h, y))
    for members in groups.values():
        total = n = 0
        for h, y in sorted(members):
            out[h] = (total + prior * overall) / (n + prior)
            total, n = total + (y or 0), n + (y is not None)
    return out


@pytest.mark.parametrize(("blocks", "prior"), [(1, 1.0), (7, 2.5), (256, 1.0)])
def test_ordered_means_by_hand(spark, blocks, prior):
    data = [(i, None if i % 11 == 0 else f"l{i % 4 if i % 3 else 0}", None if i % 13 == 0 else float(i % 7)) for i in range(600)]
    df = spark.createDataFrame(data, "id int, level string, y double").repartition(5)
    got = encoding.ordered_target_mean(df, "level", "y", "enc", ["id"], prior=prior, blocks=blocks)
    assert got.columns == ["id", "level", "y", "enc"]
    hashed = {r.id: r.h for r in df.select("id", hash_rank(["id"], 1).alias("h")).collect()}
    want = by_hand([(hashed[i], level, y) for i, level, y in data], prior)
    found = {r.id: r.enc for r in got.collect()}
    assert len(found) == 600 and all(found[i] == pytest.approx(want[hashed[i]]) for i in found)


def test_level_means_and_unseen_levels(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "level string, y double")
    means = encoding.level_target_means(df, "level", "y", "enc")
    assert {r.level: r.enc for r in means.collect()} == {"a": (4 + 3) / 3, None: (5 + 3) / 2, "b": 3.0}
    rows = spark.createDataFrame([("a",), (None,), ("new",)], "level string")
    got = {r.level: r.enc for r in encoding.with_level_means(rows, means, "level", "enc", 3.0).collect()}
    assert got == {"a": 7 / 3, None: 4.0, "new": 3.0}


def test_fifty_thousand_levels_fit(spark):
    """Levels with effects of their own: their statistics explain what a plain number can't."""
    effect = F.pmod(F.xxhash64("level"), F.lit(100)) / 10.0
    df = spark.range(200_000).select(
        F.concat(F.lit("g"), (F.col("id") % 50_000).cast("string")).alias("level"), F.col("id").alias("k")
    ).withColumn("demand", effect + F.pmod(F.xxhash64("k"), F.lit(10)) / 10.0)
    df = df.select(F.col("level").alias("geohash6"), F.lit(1).alias("day"), F.floor(F.col("k") / 50_000).cast("int").alias("hour"), F.lit(0).alias("minute"), "demand")
    model = EncodedForecaster(lambda c, n: estimators.boosted_trees(c, n, n_trees=5, depth=4, rate=0.5), [], [], encoded=["geohash6"])
    model.fit_prepared(df.cache())
    scored = model.score_training().agg(F.var_pop(F.col("demand") - F.col("y_hat")) / F.var_pop("demand")).first()[0]
    assert scored < 0.35
    unseen = model.predict(df.limit(1).withColumn("geohash6", F.lit("new"))).first()
    assert unseen.y_hat == pytest.approx(model.unseen, abs=1.0)
    model.close()


def test_join_with_suffix(spark):
    left = spark.createDataFrame([(1, 2.0, "x"), (2, 3.0, "y")], "k int, v double, w string")
    right = spark.createDataFrame([(1, 9.0, True)], "k int, v double, z boolean")
    got = selection.join_suffixed(left, right, ["k"])
    assert got.columns == ["k", "v", "w", "v_r", "z"]
    assert sorted(map(tuple, got.collect())) == [(1, 2.0, "x", 9.0, True), (2, 3.0, "y", None, None)]
    with pytest.raises(ValueError, match="v_r"):
        selection.join_suffixed(left.withColumnRenamed("w", "v_r"), right, ["k"])
