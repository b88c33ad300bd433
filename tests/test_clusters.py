import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from tilecast.operators import clusters, scaling

PLACES = [(f"p{i}", -5.4 + 0.01 * (i % 5) + 0.2 * (i % 2), 90.6 + 0.6 * (i % 2)) for i in range(20)]


@pytest.fixture(scope="module")
def places(spark):
    cached = spark.createDataFrame(PLACES, "geohash6 string, lat double, long double").cache()
    yield cached
    cached.unpersist()


def test_two_areas_get_their_means_as_centres(places):
    centres = clusters.fit_geo_centres(places)
    for side, centre in enumerate(centres):
        members = [(p[1], p[2]) for i, p in enumerate(PLACES) if i % 2 == side]
        assert centre == pytest.approx(list(np.mean(members, axis=0)))


def test_busy_places_do_not_pull_the_centre(spark, places):
    copies = F.when(F.col("geohash6") == "p0", 500).otherwise(1)
    busy = places.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    got, want = clusters.fit_geo_centres(busy), clusters.fit_geo_centres(places)
    assert np.allclose(got, want, atol=1e-12)


def test_ids_do_not_depend_on_the_seed(places):
    first, second = (
        {
            r.geohash6: r.cluster_geo
            for r in clusters.add_geo_cluster(
                places, clusters.fit_geo_centres(places, seed=s)
            ).collect()
        }
        for s in (1, 77)
    )
    assert first == second
    assert first["p0"] == 0 and first["p1"] == 1


def test_distance_is_to_the_own_centre(places):
    row = clusters.add_geo_cluster(places, [[-5.4, 90.6], [-5.2, 91.2]]).filter("geohash6 = 'p0'")
    got = row.first()
    assert got.cluster_geo == 0 and got.cluster_geo_mid_long == 90.6
    assert got.dist_to_center_km == pytest.approx(0, abs=1e-6)


def test_add_cluster_labels_rows_by_their_group(spark, places):
    rows = places.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    got = clusters.add_cluster(KMeans(k=2, seed=1), places, rows, ["lat", "long"], "c")
    assert got.columns == [*rows.columns, "c"]
    assert got.count() == 40
    assert got.groupBy("geohash6").agg(F.countDistinct("c").alias("n")).filter("n > 1").count() == 0


def mixture_rows(spark):
    rng = np.random.default_rng(4)
    points = np.vstack([rng.normal(m, 1, (150, 2)) for m in (0, 8, 20)])
    return spark.createDataFrame([tuple(map(float, p)) for p in points], "x double, y double")


def test_mixture_probability_and_ordered_ids(spark):
    rows = mixture_rows(spark)
    model = clusters.mixture(3, 450)
    got = clusters.add_cluster(model, rows, rows, ["x", "y"], "c", "p").toPandas()
    assert ((got.p > 0) & (got.p <= 1)).all()
    assert list(got.groupby("c").x.mean().round(-1)) == [0, 10, 20]


def test_rows_with_missing_values_get_no_cluster(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (9.0, 9.0), (None, 1.0)], "x double, y double")
    got = clusters.add_cluster(KMeans(k=2, seed=1), rows, rows, ["x", "y"], "c")
    assert got.count() == 3
    assert got.filter("x is null and c is null").count() == 1
    assert got.filter("c is not null").count() == 2


def test_scores_fall_to_the_true_number_of_components(spark):
    rows = mixture_rows(spark)
    scores = clusters.mixture_scores(rows, ["x", "y"], 5).toPandas()
    assert list(scores.k) == [1, 2, 3, 4]
    assert scores.bic.idxmin() == 2
    x = np.array(rows.collect())
    cov = np.cov(x.T, bias=True)
    log_likelihood = -len(x) / 2 * (2 * np.log(2 * np.pi) + np.log(np.linalg.det(cov)) + 2)
    assert scores.aic[0] == pytest.approx(2 * 5 - 2 * log_likelihood)
    assert scores.bic[0] == pytest.approx(5 * np.log(len(x)) - 2 * log_likelihood)


def test_scalers_invert(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 9.0)], "x double")
    standard = scaling.fit_standard_scaler(df, "x")
    assert (standard.centre, standard.scale) == pytest.approx((4, np.std([1, 2, 4, 9])))
    robust = scaling.fit_robust_scaler(df, "x")
    assert (robust.centre, robust.scale) == pytest.approx((3, 5.25 - 1.75))
    for scaler in (standard, robust):
        back = df.select("x", scaler.invert(scaler.apply(F.col("x"))).alias("y")).collect()
        assert all(r.x == pytest.approx(r.y) for r in back)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    scaler = scaling.fit_standard_scaler(df, "x")
    assert [r[0] for r in df.select(scaler.apply(F.col("x"))).collect()] == [0, 0]


def test_rows_that_lack_a_column_stay_without_a_cluster(spark, places):
    rows = places.unionByName(spark.createDataFrame([("bad", None, 91.0)], places.schema))
    got = {r.geohash6: r.c for r in clusters.add_cluster(KMeans(k=2, seed=1), rows, rows, ["lat", "long"], "c").collect()}
    assert len(got) == len(PLACES) + 1 and got["bad"] is None
    assert sum(c is None for c in got.values()) == 1
    near = clusters.add_geo_cluster(rows, [[-5.4, 90.6], [-5.2, 91.2]]).filter("geohash6 = 'bad'").first()
    assert near.cluster_geo is None and near.dist_to_center_km is None
