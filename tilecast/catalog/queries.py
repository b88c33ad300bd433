"""One named query per operator. Each takes (spark, sf_dir) and returns a DataFrame.

All of them read the whole demand table derived from ``events``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilecast.functions.calendar import (
    add_calendar_geo,
    day_of_week,
    day_tick_label,
    drop_day,
    is_weekend,
    shifted_hour,
)
from tilecast.functions.geo import add_lat_long
from tilecast.operators import clusters, encoding, evaluation, exploration, mixtures, scaling, selection, series
from tilecast.operators import statistics as stats
from tilecast.operators.completion import complete_ticks, complete_ticks_in_blocks
from tilecast.operators.futures import future_rows
from tilecast.plans import estimators
from tilecast.plans.features import add_demand_features, add_demand_statistics, build_features
from tilecast.plans.forecasters import DemandForecaster, EncodedForecaster, MeanForecaster, TwoLevelForecaster
from tilecast.plans.job import forecast_job
from tilecast.schema import KEYS, LAGS, NUMERICAL
from tilecast.session import materialize, scratch_dir
from tilecast.sources.demand import read_demand, read_table, write_table, write_zip_csv
from tilecast.sources.events import demand_from_events, event_days

TRAIN_DAYS = 14
DAY_AHEAD = 96
EAST_OF = 90.73
EM_STEPS = 5
WITHOUT_MIXTURE = {
    "categorical": ["is_weekend", "dow", "hour"],
    "numerical": [c for c in NUMERICAL if c not in ("cluster_prob_gdowh", "dist_to_center_km")],
}

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Integers as BIGINT and doubles rounded, so that two engines can be compared by value.

    The small offset keeps exact ties off the rounding border; adding 0 turns -0 into 0.
    """
    digits = digits or {}
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c + 1e-9, digits.get(field.name, 6)) + 0.0
        elif isinstance(field.dataType, T.IntegerType):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def _demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_calendar_geo(demand_from_events(spark, sf_dir))


def _completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_ticks(demand_from_events(spark, sf_dir), days=event_days(spark, sf_dir))


def _full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_calendar_geo(_completed(spark, sf_dir))


def _completed_days(spark: SparkSession, sf_dir: str, first: int, last: int) -> DataFrame:
    """The grid of a few days, of every place in the whole table."""
    demand, days = demand_from_events(spark, sf_dir), event_days(spark, sf_dir)
    return complete_ticks(demand, days=days, within=(first, last))


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.train_window(_completed_days(spark, sf_dir, 1, 1 + TRAIN_DAYS), TRAIN_DAYS)


def _held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day that a day-ahead forecast is about."""
    day = 2 + TRAIN_DAYS
    return selection.holdout_days(_completed_days(spark, sf_dir, day, day), TRAIN_DAYS)


def _add_dow(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"dow": day_of_week(F.col("day")), "is_weekend": is_weekend(F.col("day"))}
    )


def demand_table(spark, sf_dir):
    return comparable(demand_from_events(spark, sf_dir))


def complete_grid(spark, sf_dir):
    return comparable(_completed(spark, sf_dir))


def calendar_geo(spark, sf_dir):
    return comparable(_demand(spark, sf_dir))


def train_window(spark, sf_dir):
    return comparable(selection.train_window(demand_from_events(spark, sf_dir), TRAIN_DAYS))


def train_quantile_days(spark, sf_dir):
    demand = demand_from_events(spark, sf_dir)
    return comparable(selection.train_quantile_days(demand, 0.3, days=event_days(spark, sf_dir)))


def holdout(spark, sf_dir):
    demand = demand_from_events(spark, sf_dir)
    return comparable(selection.holdout(demand, selection.train_window(demand, TRAIN_DAYS)))


def hash_sample(spark, sf_dir):
    return comparable(selection.frac_sample(_demand(spark, sf_dir), 0.2))


def train_test_split(spark, sf_dir):
    train, test = selection.train_test_split(_demand(spark, sf_dir), 0.3)
    return comparable(
        train.withColumn("part", F.lit("train")).unionByName(
            test.withColumn("part", F.lit("test"))
        )
    )


def exact_sample(spark, sf_dir):
    return comparable(selection.exact_sample(_demand(spark, sf_dir), 0.2))


def exact_split(spark, sf_dir):
    train, test = selection.exact_split(_demand(spark, sf_dir), 0.3)
    return comparable(
        train.withColumn("part", F.lit("train")).unionByName(
            test.withColumn("part", F.lit("test"))
        )
    )


def geo_stats(spark, sf_dir):
    return comparable(stats.geo_stats(_full(spark, sf_dir)))


def gdow_stats(spark, sf_dir):
    return comparable(stats.gdow_stats(_full(spark, sf_dir)))


def gdowh_stats(spark, sf_dir):
    return comparable(stats.gdowh_stats(_full(spark, sf_dir)))


def place_points(spark, sf_dir):
    return comparable(stats.place_points(_demand(spark, sf_dir)))


def level_counts(spark, sf_dir):
    columns = ["geohash6", "is_weekend", "dow", "hour", "minute"]
    return comparable(stats.level_counts(_demand(spark, sf_dir), columns))


def row_counts(spark, sf_dir):
    demand = _demand(spark, sf_dir)
    parts = [
        stats.row_counts(demand, c).select(
            F.lit(c).alias("column"), F.col(c).alias("level"), "n"
        )
        for c in ("day", "hour", "minute")
    ]
    return comparable(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def lag_features(spark, sf_dir):
    lagged = series.add_lags(_full(spark, sf_dir))
    return comparable(lagged.select(*KEYS, "demand_tmin1", "demand_tmin4", "demand_tmin672"))


def series_in_blocks(spark, sf_dir):
    """Lags and rolling means in blocks of 700 rows, numbered by blocks of three days."""
    rows = series.add_series_in_blocks(_full(spark, sf_dir), LAGS, [4], 3, 700)
    return comparable(rows.select(*KEYS, "demand_tmin1", "demand_tmin4", "demand_tmin672", "demand_rolling_4"))


def grid_in_blocks(spark, sf_dir):
    demand, days = demand_from_events(spark, sf_dir), event_days(spark, sf_dir)
    return comparable(complete_ticks_in_blocks(demand, 3, days=days))


def target_encoding(spark, sf_dir):
    rows = encoding.ordered_target_mean(_demand(spark, sf_dir), "geohash6", "demand", "enc")
    return comparable(rows.select(*KEYS, "enc"))


def day_labels(spark, sf_dir):
    rows = demand_from_events(spark, sf_dir).withColumn("day_timestamp", day_tick_label(F.col("day"), F.col("timestamp")))
    return comparable(rows.select("geohash6", "day_timestamp", drop_day(F.col("day_timestamp")).alias("timestamp"), "demand"))


def demand_preview(spark, sf_dir):
    """The first rows by key, and the shape of the whole table."""
    demand = _demand(spark, sf_dir).select(*KEYS, "demand")
    n = demand.agg(F.count("*").alias("n")).scalar()
    head = demand.orderBy(*KEYS).limit(5)
    return comparable(head.withColumns({"n_rows": n, "n_columns": F.lit(len(demand.columns))}))


def suffixed_join(spark, sf_dir):
    """Each row's demand next to its place's daily mean of the same name."""
    rows = _demand(spark, sf_dir).select(*KEYS, "demand")
    daily = rows.groupBy("geohash6", "day").agg(F.avg("demand").alias("demand"))
    return comparable(selection.join_suffixed(rows, daily, ["geohash6", "day"]))


def place_scatter(spark, sf_dir):
    """Points of the scatter plot: a place's coordinates, median demand and cluster."""
    rows = materialize(_demand(spark, sf_dir).select("geohash6", "lat", "long", "demand"), "rows")
    places = stats.place_points(rows).join(stats.place_profile(rows).select("geohash6", "demand_median"), "geohash6")
    clustered = clusters.add_geo_cluster(places, clusters.fit_geo_centres(stats.place_points(rows)))
    return comparable(clustered.select("lat", "long", "demand_median", "cluster_geo"))


def lag_mean_encoding(spark, sf_dir):
    return comparable(stats.lag_means(series.add_lags(_full(spark, sf_dir))))


def rolling_mean_4(spark, sf_dir):
    rolled = series.add_rolling_mean(_full(spark, sf_dir), 4)
    return comparable(rolled.select(*KEYS, "demand_rolling_4"))


def quantile_diffs(spark, sf_dir):
    return comparable(
        add_demand_statistics(_full(spark, sf_dir)).select(
            *KEYS,
            "demand_gdow_q95",
            "demand_gdow_q10",
            "demand_diff_wt_gdow_q95",
            "demand_diff_wt_gdow_q10",
            "mean_demand_diff_wt_gdow_q95",
            "mean_demand_diff_wt_gdow_q10",
        )
    )


def feature_lookup(spark, sf_dir):
    train = add_demand_features(add_calendar_geo(_train(spark, sf_dir)))
    columns = ["is_weekend", "is_working_hour", "minute", "demand_rolling_4", "demand_gdow_q95"]
    return comparable(stats.feature_lookup(train, columns))


def baseline_model(spark, sf_dir):
    return comparable(MeanForecaster().fit(_train(spark, sf_dir)).table.drop("last_day"))


def baseline_median_model(spark, sf_dir):
    model = MeanForecaster("median").fit(_train(spark, sf_dir))
    return comparable(model.table.drop("last_day"))


def future_ticks(spark, sf_dir):
    return comparable(future_rows(_demand(spark, sf_dir), 5))


def _baseline(spark: SparkSession, sf_dir: str, n_ticks: int = DAY_AHEAD) -> DataFrame:
    return MeanForecaster().fit(_train(spark, sf_dir)).predict_futures(n_ticks)


def baseline_forecast(spark, sf_dir):
    return comparable(_baseline(spark, sf_dir, 5))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline's day-ahead forecast next to what was seen."""
    joined = evaluation.join_actuals(_baseline(spark, sf_dir), _held_out(spark, sf_dir))
    return evaluation.add_errors(joined)


def error_per_place(spark, sf_dir):
    return comparable(
        evaluation.place_errors(_judged(spark, sf_dir)), {"mse": 4, "MAPE": 4}
    )


def error_per_point(spark, sf_dir):
    per_point = evaluation.place_errors(_judged(spark, sf_dir), keys=["lat", "long"])
    return comparable(per_point, {"mse": 4, "MAPE": 4})


def global_metrics(spark, sf_dir):
    metrics = evaluation.global_metrics(_judged(spark, sf_dir))
    return comparable(metrics, {"mape": 4, "mape1": 4})


def error_summary(spark, sf_dir):
    per_place = materialize(evaluation.place_errors(_judged(spark, sf_dir)), "errors")
    summary = evaluation.describe(per_place, ["mse", "y_true", "rmse", "MAPE"])
    doubles = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    return comparable(summary, dict.fromkeys(doubles, 3))


def forecast_summary(spark, sf_dir):
    judged = materialize(_judged(spark, sf_dir), "judged")
    large = judged.filter(F.col("abs_err") > 0.2)
    summary = evaluation.describe(large, ["demand", "y_hat", "err", "abs_err"])
    return comparable(summary)


def mean_place_error(spark, sf_dir):
    per_place = evaluation.place_errors(_judged(spark, sf_dir))
    return comparable(evaluation.mean_place_error(per_place), {"MAPE": 4})


def two_stage_error(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return comparable(evaluation.mean_error_over_places(judged, ["err", "abs_err"]))


def worst_places(spark, sf_dir):
    return comparable(evaluation.worst_places(_judged(spark, sf_dir)))


def top_rmse(spark, sf_dir):
    per_place = evaluation.place_errors(_judged(spark, sf_dir))
    return comparable(evaluation.top_by(per_place, "rmse", 5), {"mse": 4, "MAPE": 4})


def place_profile(spark, sf_dir):
    return comparable(stats.place_profile(_demand(spark, sf_dir), ["day", "demand", "hour"]))


def top30_median(spark, sf_dir):
    profile = stats.place_profile(_demand(spark, sf_dir))
    return comparable(evaluation.top_by(profile, "demand_median", 30))


def daily_mean_of_means(spark, sf_dir):
    return comparable(exploration.daily_mean(_demand(spark, sf_dir)))


def daily_rolling(spark, sf_dir):
    daily = exploration.daily_mean(_demand(spark, sf_dir))
    parts = [
        series.rolling_days(daily, n, ["demand"]).select(
            "day", F.lit(n).alias("window"), F.col(f"demand_rolling_{n}").alias("demand")
        )
        for n in (7, 14, 30)
    ]
    return comparable(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def _at_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploration.rows_at_median(_demand(spark, sf_dir))


def rows_at_median(spark, sf_dir):
    return comparable(_at_median(spark, sf_dir).select(*KEYS, "demand", "demand_median"))


def count_by_hour(spark, sf_dir):
    return comparable(stats.row_counts(_at_median(spark, sf_dir), "hour"))


def pivot_day_hour(spark, sf_dir):
    sums = exploration.sum_by_day_hour(_demand(spark, sf_dir))
    return comparable(exploration.pivot_hours(sums, "day"))


def pivot_day_hour_east(spark, sf_dir):
    east = _demand(spark, sf_dir).filter(F.col("long") > EAST_OF)
    return comparable(exploration.pivot_hours(exploration.sum_by_day_hour(east), "day"))


def pivot_day_hour_median(spark, sf_dir):
    medians = exploration.median_by_day_hour(_demand(spark, sf_dir))
    return comparable(exploration.pivot_hours(medians, "day"))


def pivot_dow_hour(spark, sf_dir):
    west = _demand(spark, sf_dir).filter(F.col("long") < EAST_OF)
    sums = _add_dow(exploration.sum_by_day_hour(west))
    return comparable(exploration.pivot_hours(sums, "dow"))


def demand_histogram(spark, sf_dir):
    return comparable(exploration.histogram(_demand(spark, sf_dir), "demand", 20))


def weekend_histogram(spark, sf_dir):
    sums = _add_dow(exploration.sum_by_day_hour(_demand(spark, sf_dir)))
    return comparable(exploration.histogram(sums, "demand", 10, ["is_weekend"]))


def demand_auto_histogram(spark, sf_dir):
    return comparable(exploration.auto_histogram(_demand(spark, sf_dir), "demand"))


def place_density(spark, sf_dir):
    points = stats.place_points(_demand(spark, sf_dir))
    density = exploration.kernel_density(points)
    return comparable(density.select("lat_cell", "long_cell", "lat", "long", "mass", "density"), {"density": 4})


def demand_bands(spark, sf_dir):
    rows = _demand(spark, sf_dir).withColumn("hour_p7", shifted_hour(F.col("hour"), 7))
    return comparable(exploration.bootstrap_bands(rows, "hour_p7", by=["is_weekend"], replicates=40))


def box_by_hour(spark, sf_dir):
    return comparable(exploration.box_by(_demand(spark, sf_dir), "hour"))


def line_by_day(spark, sf_dir):
    return comparable(exploration.line_by(_demand(spark, sf_dir), "day"))


def line_by_hour(spark, sf_dir):
    rows = _demand(spark, sf_dir).withColumn("hour_p7", shifted_hour(F.col("hour"), 7))
    return comparable(exploration.line_by(rows, "hour_p7", by=["geohash6", "is_weekend"]))


def geo_density(spark, sf_dir):
    return comparable(exploration.grid_density(stats.place_points(_demand(spark, sf_dir)), 0.05))


def place_series(spark, sf_dir):
    return comparable(exploration.place_series(_judged(spark, sf_dir)))


def geo_clusters(spark, sf_dir):
    places = materialize(stats.place_points(_demand(spark, sf_dir)), "places")
    return comparable(clusters.add_geo_cluster(places, clusters.fit_geo_centres(places)))


def full_features(spark, sf_dir):
    places = demand_from_events(spark, sf_dir)
    full = build_features(_completed(spark, sf_dir), use_clustering=False, places=places)
    return comparable(full)


def scaled_target(spark, sf_dir):
    full = _full(spark, sf_dir)
    scaler = scaling.fit_standard_scaler(full, "demand")
    scaled = full.withColumn("scaled", scaler.apply(F.col("demand")))
    return comparable(
        scaled.select(*KEYS, "scaled", scaler.invert(F.col("scaled")).alias("restored"))
    )


def robust_scaled_target(spark, sf_dir):
    observed = _demand(spark, sf_dir)
    scaler = scaling.fit_robust_scaler(observed, "demand")
    scaled = observed.withColumn("scaled", scaler.apply(F.col("demand")))
    return comparable(
        scaled.select(*KEYS, "scaled", scaler.invert(F.col("scaled")).alias("restored"))
    )


def _pattern_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = materialize(stats.gdowh_stats(_full(spark, sf_dir)), "patterns")
    return add_lat_long(table)


def gdowh_clusters(spark, sf_dir):
    patterns = _pattern_table(spark, sf_dir)
    model = clusters.fit_pattern_mixture(patterns)
    return clusters.label_rows(
        model, patterns, clusters.PATTERN, "cluster_gdowh", "cluster_prob_gdowh"
    )


def row_clusters(spark, sf_dir):
    rows = materialize(
        _demand(spark, sf_dir).select("geohash6", "lat", "long", "demand"), "rows"
    )
    mixture = clusters.mixture(3, rows.count())
    columns = ["lat", "long", "demand"]
    labelled = clusters.add_cluster(mixture, rows, rows, columns, "cluster", "cluster_prob")
    return labelled.groupBy("geohash6", "lat", "long", "cluster").agg(
        F.median("demand").alias("demand"), F.median("cluster_prob").alias("cluster_prob")
    )


def gmm_scores(spark, sf_dir):
    return clusters.mixture_scores(_pattern_table(spark, sf_dir), clusters.PATTERN, 10)


def gmm_score_one(spark, sf_dir):
    """One Gaussian over one column, whose likelihood has a closed form."""
    scores = clusters.mixture_scores(_pattern_table(spark, sf_dir), ["median_demand_per_gdowh"], 2)
    return comparable(scores, {"aic": 3, "bic": 3})


def mixture_places(spark, sf_dir):
    """Two components over the places, each place's component and its probability."""
    points = materialize(stats.place_points(_demand(spark, sf_dir)), "places")
    model = mixtures.fit_mixtures(points, ["lat", "long"], [2], EM_STEPS, 0)[2]
    return comparable(mixtures.add_mixture(points, model, "cluster", "cluster_prob"))


def _row_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["lat", "long", "demand"]
    rows = materialize(_demand(spark, sf_dir).select(*KEYS, *columns), "rows")
    model = mixtures.fit_mixtures(rows, columns, [3], EM_STEPS, 0)[3]
    return mixtures.add_mixture(rows, model, "cluster", "cluster_prob")


def mixture_rows(spark, sf_dir):
    return comparable(_row_mixture(spark, sf_dir))


def mixture_medians(spark, sf_dir):
    rows = _row_mixture(spark, sf_dir).groupBy("lat", "long", "cluster")
    return comparable(rows.agg(F.median("demand").alias("demand"), F.count("*").alias("n")))


def mixture_scores(spark, sf_dir):
    """AIC and BIC of one to three components over place and demand, fitted side by side."""
    rows = _demand(spark, sf_dir)
    models = mixtures.fit_mixtures(rows, ["long", "demand"], [1, 2, 3], EM_STEPS, 0)
    return comparable(mixtures.mixture_table(models, rows), {"aic": 3, "bic": 3})


def at_place(spark, sf_dir):
    """The rows of the place whose geohash comes first."""
    demand = demand_from_events(spark, sf_dir)
    first = demand.agg(F.min("geohash6").alias("geohash6")).scalar()
    return comparable(selection.at_place(demand, first))


def on_days(spark, sf_dir):
    return comparable(selection.on_days(demand_from_events(spark, sf_dir), [2, 3, 29, 77]))


def distinct_hours(spark, sf_dir):
    return comparable(selection.distinct_sorted(_demand(spark, sf_dir), "hour"))


def _written(spark: SparkSession, sf_dir: str, name: str, **options) -> str:
    """The demand table in the run's scratch folder, in another format."""
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = demand_from_events(spark, sf_dir).write
    writer.options(**options).format("parquet" if name == "parquet" else "csv").save(path)
    return path


def source_csv(spark, sf_dir):
    path = _written(spark, sf_dir, "csv", header=True)
    return comparable(read_demand(spark, path, format="csv"))


def source_gzip(spark, sf_dir):
    path = _written(spark, sf_dir, "gzip", header=True, compression="gzip")
    return comparable(read_demand(spark, path, format="csv"))


def source_parquet(spark, sf_dir):
    path = _written(spark, sf_dir, "parquet")
    return comparable(read_demand(spark, path, format="parquet"))


def source_zip(spark, sf_dir):
    """One archive per task, one partition per member."""
    path = f"{scratch_dir(spark).rstrip('/')}/zip-{uuid.uuid4().hex}"
    write_zip_csv(demand_from_events(spark, sf_dir), path)
    return comparable(read_demand(spark, path, format="zip"))


def mean_job(spark, sf_dir):
    """The whole batch job from a file to written forecasts, read back."""
    path, out = _written(spark, sf_dir, "parquet"), f"{scratch_dir(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    forecast_job(spark, path, 5, 1, TRAIN_DAYS, out, MeanForecaster(), "parquet", "parquet")
    return comparable(spark.read.parquet(out))


def _simple(stages: Callable, *numerical: str) -> DemandForecaster:
    return DemandForecaster(stages, categorical=[], numerical=list(numerical))


def forecast_stump(spark, sf_dir):
    model = _simple(estimators.stump, "is_weekend").fit(_train(spark, sf_dir))
    return comparable(model.predict_futures(5))


def forecast_linear(spark, sf_dir):
    model = _simple(estimators.least_squares, "mean_demand_per_gdowh").fit(_train(spark, sf_dir))
    return comparable(model.predict_futures(5))


def _with_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training days with ``shift``, a category that is missing at night."""
    train = materialize(add_calendar_geo(_train(spark, sf_dir)), "train")
    return train.withColumn("shift", F.when(F.col("hour_p8") >= 8, F.col("is_working_hour").cast("double")))


def forecast_category(spark, sf_dir):
    """Least squares on a category with missing values, which get its mean."""
    model = DemandForecaster(estimators.least_squares, categorical=["shift"], numerical=[])
    return comparable(model.fit_prepared(_with_shift(spark, sf_dir)).predict_futures(5))


def forecast_one_hot(spark, sf_dir):
    """Least squares on one-hot days of the week: their means."""
    model = DemandForecaster(estimators.least_squares_one_hot, categorical=["dow"], numerical=[])
    return comparable(model.fit(_train(spark, sf_dir)).predict_futures(5), {"y_hat": 4})


def forecast_category_stump(spark, sf_dir):
    """One split of the days of the week into two sets."""
    model = DemandForecaster(estimators.categorical_stump, categorical=["dow"], numerical=[])
    return comparable(model.fit(_train(spark, sf_dir)).predict_futures(5))


def forecast_shrunk_line(spark, sf_dir):
    """An elastic net on one number, whose slope has a closed form."""
    model = _simple(lambda c, n: estimators.elastic_net(c, n, penalty=0.5), "mean_demand_per_gdowh").fit(_train(spark, sf_dir))
    return comparable(model.predict_futures(5), {"y_hat": 3})


def forecast_encoded(spark, sf_dir):
    """A line on the target statistic of the place, however many places there are."""
    model = EncodedForecaster(estimators.least_squares, [], [], encoded=["geohash6"])
    return comparable(model.fit_prepared(materialize(add_calendar_geo(_train(spark, sf_dir)), "train")).predict_futures(5))


def two_level_scores(spark, sf_dir):
    """In-sample forecasts of both levels, the second one on a one-hot category."""
    second = DemandForecaster(estimators.one_hot_stump, categorical=["is_working_hour"], numerical=[])
    model = TwoLevelForecaster(_simple(estimators.stump, "is_weekend"), second)
    model.fit(_train(spark, sf_dir), demand_from_events(spark, sf_dir))
    scores = model.score_training().select(*KEYS, "y_true", "y_hat", "lv2_y_hat", "ensemble_y_hat")
    return comparable(scores)


def two_level_stump(spark, sf_dir):
    first, second = (_simple(estimators.stump, c) for c in ("is_weekend", "is_working_hour"))
    model = TwoLevelForecaster(first, second).fit(_train(spark, sf_dir))
    return comparable(model.predict_futures(5))


def stump_scores(spark, sf_dir):
    """In-sample forecasts, saved by day and read back."""
    model = _simple(estimators.stump, "is_weekend").fit(_train(spark, sf_dir))
    path = f"{scratch_dir(spark).rstrip('/')}/scores-{uuid.uuid4().hex}"
    write_table(model.score_training().select(*KEYS, "demand", "y_hat"), path)
    return comparable(read_table(spark, path))


def stump_importance(spark, sf_dir):
    model = _simple(estimators.stump, "is_weekend", "minute").fit(_train(spark, sf_dir))
    importances = model.feature_importances()
    return comparable(importances.filter("importances > 0"))


def _fitted(spark: SparkSession, sf_dir: str, stages: Callable) -> DemandForecaster:
    return DemandForecaster(stages).fit(_train(spark, sf_dir))


def forecast_gbt(spark, sf_dir):
    return _fitted(spark, sf_dir, estimators.boosted_trees).predict_futures(5)


def forecast_gbt_cat(spark, sf_dir):
    return _fitted(spark, sf_dir, estimators.boosted_trees_categorical).predict_futures(5)


def forecast_forest(spark, sf_dir):
    return _fitted(spark, sf_dir, estimators.forest).predict_futures(5)


def forecast_elastic_net(spark, sf_dir):
    return _fitted(spark, sf_dir, estimators.elastic_net).predict_futures(5)


def forecast_error_gbt(spark, sf_dir):
    forecast = _fitted(spark, sf_dir, estimators.boosted_trees).predict_futures(DAY_AHEAD)
    joined = evaluation.join_actuals(forecast, _held_out(spark, sf_dir))
    return evaluation.place_errors(joined)


def feature_importance(spark, sf_dir):
    return _fitted(spark, sf_dir, estimators.boosted_trees_categorical).feature_importances()


def training_scores(spark, sf_dir):
    scored = _fitted(spark, sf_dir, estimators.boosted_trees).score_training()
    return scored.select(*KEYS, "demand", "y_hat")


def forecast_two_level(spark, sf_dir):
    model = TwoLevelForecaster(DemandForecaster(), DemandForecaster())
    return model.fit(_train(spark, sf_dir)).predict_futures(5)


def forecast_two_level_nocluster(spark, sf_dir):
    second = DemandForecaster(estimators.boosted_trees_one_hot, **WITHOUT_MIXTURE)
    model = TwoLevelForecaster(DemandForecaster(), second)
    return model.fit(_train(spark, sf_dir)).score_training()


QUERIES: dict[str, Query] = {
    "demand_table": demand_table,
    "complete_ticks": complete_grid,
    "calendar_geo": calendar_geo,
    "train_window": train_window,
    "train_quantile_days": train_quantile_days,
    "holdout": holdout,
    "hash_sample": hash_sample,
    "train_test_split": train_test_split,
    "exact_sample": exact_sample,
    "exact_split": exact_split,
    "geo_stats": geo_stats,
    "gdow_stats": gdow_stats,
    "gdowh_stats": gdowh_stats,
    "place_points": place_points,
    "level_counts": level_counts,
    "row_counts": row_counts,
    "lag_features": lag_features,
    "series_in_blocks": series_in_blocks,
    "grid_in_blocks": grid_in_blocks,
    "target_encoding": target_encoding,
    "day_labels": day_labels,
    "demand_preview": demand_preview,
    "suffixed_join": suffixed_join,
    "place_scatter": place_scatter,
    "lag_mean_encoding": lag_mean_encoding,
    "rolling_mean_4": rolling_mean_4,
    "quantile_diffs": quantile_diffs,
    "feature_lookup": feature_lookup,
    "baseline_model": baseline_model,
    "baseline_median_model": baseline_median_model,
    "future_ticks": future_ticks,
    "baseline_forecast": baseline_forecast,
    "error_per_place": error_per_place,
    "error_per_point": error_per_point,
    "global_metrics": global_metrics,
    "error_summary": error_summary,
    "forecast_summary": forecast_summary,
    "mean_place_error": mean_place_error,
    "two_stage_error": two_stage_error,
    "worst_places": worst_places,
    "top_rmse": top_rmse,
    "place_profile": place_profile,
    "top30_median": top30_median,
    "daily_mean_of_means": daily_mean_of_means,
    "daily_rolling": daily_rolling,
    "rows_at_median": rows_at_median,
    "count_by_hour": count_by_hour,
    "pivot_day_hour": pivot_day_hour,
    "pivot_day_hour_east": pivot_day_hour_east,
    "pivot_day_hour_median": pivot_day_hour_median,
    "pivot_dow_hour": pivot_dow_hour,
    "demand_histogram": demand_histogram,
    "weekend_histogram": weekend_histogram,
    "demand_auto_histogram": demand_auto_histogram,
    "place_density": place_density,
    "demand_bands": demand_bands,
    "box_by_hour": box_by_hour,
    "line_by_day": line_by_day,
    "line_by_hour": line_by_hour,
    "geo_density": geo_density,
    "place_series": place_series,
    "geo_clusters": geo_clusters,
    "full_features": full_features,
    "scaled_target": scaled_target,
    "robust_scaled_target": robust_scaled_target,
    "gdowh_clusters": gdowh_clusters,
    "row_clusters": row_clusters,
    "gmm_scores": gmm_scores,
    "gmm_score_one": gmm_score_one,
    "mixture_places": mixture_places,
    "mixture_rows": mixture_rows,
    "mixture_medians": mixture_medians,
    "mixture_scores": mixture_scores,
    "at_place": at_place,
    "on_days": on_days,
    "distinct_hours": distinct_hours,
    "source_csv": source_csv,
    "source_gzip": source_gzip,
    "source_parquet": source_parquet,
    "source_zip": source_zip,
    "mean_job": mean_job,
    "forecast_stump": forecast_stump,
    "forecast_linear": forecast_linear,
    "forecast_category": forecast_category,
    "forecast_one_hot": forecast_one_hot,
    "forecast_category_stump": forecast_category_stump,
    "forecast_shrunk_line": forecast_shrunk_line,
    "forecast_encoded": forecast_encoded,
    "two_level_scores": two_level_scores,
    "two_level_stump": two_level_stump,
    "stump_scores": stump_scores,
    "stump_importance": stump_importance,
    "forecast_gbt": forecast_gbt,
    "forecast_gbt_cat": forecast_gbt_cat,
    "forecast_forest": forecast_forest,
    "forecast_elastic_net": forecast_elastic_net,
    "forecast_error_gbt": forecast_error_gbt,
    "feature_importance": feature_importance,
    "training_scores": training_scores,
    "forecast_two_level": forecast_two_level,
    "forecast_two_level_nocluster": forecast_two_level_nocluster,
}
