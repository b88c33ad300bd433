import os
from functools import partial
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tilecast.functions.calendar import add_calendar_geo
from tilecast.operators.completion import complete_ticks
from tilecast.operators.evaluation import add_difference_errors, global_metrics
from tilecast.operators.scaling import fit_robust_scaler, fit_standard_scaler
from tilecast.operators.selection import holdout_days, train_window
from tilecast.plans import estimators as est
from tilecast.plans.features import build_features
from tilecast.plans.forecasters import (
    FORECAST,
    DemandForecaster,
    MeanForecaster,
    TwoLevelForecaster,
)
from tilecast.plans.job import evaluate, forecast_job
from tilecast.schema import CATEGORICAL, KEYS, NUMERICAL
from tilecast.session import materialize, scratch_dir

FEW = 4
# Enough to forecast with, and no mixture to fit.
PLAIN = {
    "categorical": ["is_weekend", "dow", "hour"],
    "numerical": ["lat", "long", "minute", "mean_demand_per_geo", "demand_rolling_4"],
}


@pytest.fixture(scope="module")
def full(demand):
    cached = complete_ticks(demand).cache()
    yield cached
    cached.unpersist()


@pytest.fixture(scope="module")
def prepared(full):
    return materialize(build_features(train_window(full, 11)), "test-prepared")


def forecaster(stages, prepared, **options):
    return DemandForecaster(stages, **options).fit_prepared(prepared)


def test_mean_forecast_is_the_group_mean(full):
    model = MeanForecaster().fit(full)
    forecast = model.predict_futures(3)
    assert forecast.columns == FORECAST
    want = (
        add_calendar_geo(full)
        .groupBy("geohash6", "dow", "hour", "minute")
        .agg(F.avg("demand").alias("want"))
    )
    joined = forecast.join(want, ["geohash6", "dow", "hour", "minute"])
    assert joined.count() == 6
    assert joined.filter(F.abs(F.col("y_hat") - F.col("want")) > 1e-9).count() == 0
    assert {r.day for r in forecast.collect()} == {16}


def test_unseen_key_has_no_forecast(full):
    forecast = MeanForecaster().fit(full.filter("day <= 3")).predict_futures(2)
    assert [r.y_hat for r in forecast.collect()] == [None] * 4


def test_mean_forecast_starts_at_each_places_own_end(full):
    ragged = full.filter("geohash6 = 'qp02yc' or (day = 9 and hour < 5) or day < 9")
    first = MeanForecaster().fit(ragged).predict_futures(1)
    assert {(r.geohash6, r.day, r.hour, r.minute) for r in first.collect()} == {
        ("qp02yc", 16, 0, 0),
        ("qp0dnh", 9, 5, 0),
    }


def test_features_carry_every_model_column(prepared):
    assert set(CATEGORICAL + NUMERICAL) <= set(prepared.columns)
    assert prepared.count() == 2 * 12 * 96
    row = prepared.agg(
        F.min("cluster_prob_gdowh").alias("p"),
        F.countDistinct("cluster_geo").alias("areas"),
        F.max("dist_to_center_km").alias("far"),
    ).first()
    assert 0 < row.p <= 1 and row.areas == 2 and row.far < 1e-6


def test_features_without_the_mixture(full):
    columns = build_features(full.filter("day < 4"), use_clustering=False).columns
    assert "cluster_geo" in columns and "cluster_gdowh" not in columns


@pytest.mark.parametrize(
    "stages",
    [
        partial(est.boosted_trees, n_trees=FEW),
        partial(est.boosted_trees_categorical, n_trees=FEW),
        partial(est.boosted_trees_one_hot, n_trees=FEW),
        partial(est.forest, n_trees=FEW, depth=5),
        est.elastic_net,
    ],
    ids=["trees", "categorical", "one-hot", "forest", "linear"],
)
def test_every_regressor_beats_the_overall_mean_in_sample(prepared, stages):
    model = forecaster(stages, prepared)
    scored = model.score_training()
    assert scored.columns == [*prepared.columns, "y_hat"]
    spread = prepared.agg(F.stddev_pop("demand")).first()[0]
    assert global_metrics(scored).first().rmse < spread
    future = model.predict_futures(5)
    assert future.columns == FORECAST
    assert future.count() == 10 and future.filter("y_hat is null").count() == 0
    assert {r.day for r in future.collect()} == {13}


def test_unseen_hours_are_imputed_not_dropped(prepared):
    """Forecasting into a day of week and hour training never had still gives a row."""
    short = prepared.filter("day = 5 or (day = 6 and hour < 2)")
    for stages in (partial(est.boosted_trees, n_trees=2), est.elastic_net):
        future = forecaster(stages, short).predict_futures(8)
        assert future.count() == 16 and future.filter("y_hat is null").count() == 0


def test_importances_name_every_feature_and_sum_to_one(prepared):
    for stages in (est.boosted_trees_categorical, est.boosted_trees_one_hot):
        model = forecaster(partial(stages, n_trees=FEW), prepared)
        table = model.feature_importances().toPandas()
        assert sorted(table.feature) == sorted(CATEGORICAL + NUMERICAL)
        assert table.importances.sum() == pytest.approx(1)
        assert table.importances.is_monotonic_decreasing


@pytest.mark.parametrize("scaler", [fit_standard_scaler, fit_robust_scaler])
def test_scaled_target_comes_back_in_its_own_unit(prepared, scaler):
    stages = partial(est.elastic_net, penalty=0.0)
    plain = forecaster(stages, prepared).score_training().select(*KEYS, "y_hat")
    scaled = forecaster(stages, prepared, scaler=scaler).score_training()
    both = plain.join(scaled.select(*KEYS, F.col("y_hat").alias("z")), KEYS)
    assert both.agg(F.max(F.abs(F.col("y_hat") - F.col("z")))).first()[0] < 0.05


def test_two_levels_add_up(full):
    few = partial(est.boosted_trees, n_trees=2)
    second = DemandForecaster(partial(est.boosted_trees_one_hot, n_trees=2), **PLAIN)
    first = DemandForecaster(few, **PLAIN)
    model = TwoLevelForecaster(first, second).fit(train_window(full, 7))
    future = model.predict_futures(4)
    assert future.count() == 8
    assert {"lv1_yhat", "lv2_yhat", "y_hat"} <= set(future.columns)
    off = F.abs(F.col("y_hat") - F.col("lv1_yhat") - F.col("lv2_yhat"))
    assert future.agg(F.max(off)).first()[0] < 1e-9
    judged = add_difference_errors(future.withColumn("demand", F.lit(1.0)))
    off = F.abs(F.col("err2") - (1 - F.col("lv1_yhat") + F.col("lv2_yhat")))
    assert judged.agg(F.max(off)).first()[0] < 1e-9
    scored = model.score_training()
    residual = F.abs(F.col("demand") - (F.col("y_true") - F.col("y_hat")))
    assert scored.count() == 2 * 8 * 96
    assert scored.agg(F.max(residual)).first()[0] < 1e-9
    one, two = (
        scored.agg(F.avg((F.col("y_true") - F.col(c)) ** 2)).first()[0]
        for c in ("y_hat", "ensemble_y_hat")
    )
    assert two < one


def test_job_reads_fits_writes(spark, demand, tmp_path):
    path, out = str(tmp_path / "in.csv"), str(tmp_path / "out")
    demand.toPandas().to_csv(path, index=False)
    trees = DemandForecaster(partial(est.boosted_trees, n_trees=2), **PLAIN)
    forecast = forecast_job(spark, path, ticks=3, n_days=9, out=out, forecaster=trees)
    assert forecast.columns == FORECAST
    back = spark.read.option("header", True).csv(out)
    assert back.columns == FORECAST and back.count() == 6
    assert {r.day for r in back.collect()} == {"11"}


def test_evaluation_report(full):
    forecast = MeanForecaster().fit(train_window(full, 12)).predict_futures(96)
    report = evaluate(forecast, holdout_days(full, 12), places=["qp02yc"])
    assert report["pred_vs_act"].count() == 2 * 96
    assert report["per_place"].count() == 2
    assert report["mean"].first().rmse > 0
    assert report["rmse_histogram"].agg(F.sum("n")).first()[0] == 2
    assert report["mape_histogram"].agg(F.sum("n")).first()[0] == 2
    assert report["series"].count() == 96


TEXT = {"categorical": ["geohash6"], "numerical": ["minute"]}


@pytest.mark.parametrize("stages", [est.boosted_trees_one_hot, est.boosted_trees_categorical])
def test_text_categories_and_unseen_levels(spark, prepared, stages):
    model = forecaster(partial(stages, n_trees=2, depth=2), prepared, **TEXT)
    unseen = prepared.limit(3).withColumn("geohash6", F.lit("zzzzzz"))
    missing = prepared.limit(3).withColumn("geohash6", F.lit(None).cast("string"))
    for rows in (unseen, missing):
        assert model.predict(rows).filter("y_hat is not null").count() == 3


def test_too_many_levels_fail_and_are_not_taken_for_a_number(spark):
    rows = spark.range(200).select((F.col("id") % 50).alias("level"), F.col("id").cast("double").alias("demand"))
    few = partial(est.boosted_trees_categorical, n_trees=1)
    options = {"categorical": ["level"], "numerical": []}
    with pytest.raises(Exception, match="maxBins"):
        forecaster(few, rows, **options)
    assert forecaster(partial(few, max_levels=60), rows, **options).model


def test_a_malformed_place_keeps_its_rows(spark, full):
    odd = full.filter("day <= 2").unionByName(full.filter("day = 1").limit(3).withColumn("geohash6", F.lit("bad!")))
    for clustering in (True, False):
        got = build_features(odd, use_clustering=clustering)
        assert got.count() == odd.count()
        assert got.filter("geohash6 = 'bad!' and cluster_geo is null").count() == 3


def test_close_removes_what_fit_wrote(full):
    model = MeanForecaster().fit(full)
    (path,) = model.written
    assert os.path.isdir(path.removeprefix("file:"))
    model.close()
    assert not os.path.exists(path.removeprefix("file:")) and model.written == []


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="yarn")
    remote = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(remote)


def test_both_levels_take_places_without_the_grid(demand, full, monkeypatch):
    from tilecast.plans import forecasters

    seen = []
    build = forecasters.build_features
    monkeypatch.setattr(forecasters, "build_features", lambda df, mixture, seed, places: seen.append(places) or build(df, mixture, seed, places))
    levels = [DemandForecaster(est.stump, categorical=[], numerical=["is_weekend"]) for _ in range(2)]
    TwoLevelForecaster(*levels).fit(full, demand)
    assert seen == [demand, None]
