"""Forecasters: a plain mean per tick, a fitted regressor, and a second level on its residuals."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.functions.calendar import add_calendar_geo
from tilecast.operators.clusters import SEED
from tilecast.operators.encoding import level_target_means, ordered_target_mean, with_level_means
from tilecast.operators.futures import future_rows
from tilecast.operators.statistics import feature_lookup, tick_means
from tilecast.plans.estimators import LABEL, PREDICTION, boosted_trees
from tilecast.plans.features import build_features
from tilecast.schema import (
    CALENDAR_GEO,
    CATEGORICAL,
    GDOWH,
    GDOWHM,
    KEYS,
    NUMERICAL,
    TICK_MINUTES,
)
from tilecast.session import delete_tables, materialize, recorded, scratch_dir

FORECAST = [*KEYS, *CALENDAR_GEO, PREDICTION]
_RAW = ["geohash6", "day", "timestamp", "demand"]


class MeanForecaster:
    """Predicts a tick by the mean (or median) demand of its place, day of week and time of day."""

    def __init__(self, strategy: str = "mean"):
        self.strategy = strategy
        self.table: DataFrame | None = None
        self.written: list[str] = []

    def fit(self, df: DataFrame) -> MeanForecaster:
        """One pass over ``df``; what is kept is one row per place, day of week and tick."""
        table = tick_means(add_calendar_geo(df), self.strategy)
        with recorded() as self.written:
            self.table = materialize(table, "tick-means")
        return self

    def close(self) -> None:
        """Remove the table written by ``fit``. Forecasts not yet written can't be computed any more."""
        if self.table is not None:
            delete_tables(self.table.sparkSession, self.written)

    def predict(self, df: DataFrame) -> DataFrame:
        """``y_hat`` for rows with calendar columns; NULL where training never saw the key."""
        table = self.table.select(*GDOWHM, F.col("y_true").alias(PREDICTION))
        return df.join(table, GDOWHM, "left")

    def predict_futures(self, n_ticks: int = 5, tick_minutes: int = TICK_MINUTES) -> DataFrame:
        """The coming ticks after each place's last one, which the table remembers."""
        ends = self.table.select("geohash6", F.col("last_day").alias("day"), "hour", "minute")
        return self.predict(future_rows(ends, n_ticks, tick_minutes)).select(*FORECAST)


class DemandForecaster:
    """A regressor over the feature table.

    ``stages`` makes the Spark ML stages from the feature lists; swap it for any other regressor.
    Every ``fit`` prepares the frame it is given.
    """

    def __init__(
        self,
        stages: Callable[[Sequence[str], Sequence[str]], list] = boosted_trees,
        categorical: Sequence[str] = CATEGORICAL,
        numerical: Sequence[str] = NUMERICAL,
        keys: Sequence[str] = GDOWH,
        target: str = "demand",
        scaler: Callable | None = None,
        seed: int = SEED,
    ):
        self.stages = stages
        self.categorical = list(categorical)
        self.numerical = list(numerical)
        self.keys = list(keys)
        self.target = target
        self.fit_scaler = scaler
        self.seed = seed
        self.prepared: DataFrame | None = None
        self.model: PipelineModel | None = None
        self.scaler = None
        self.written: list[str] = []

    @property
    def features(self) -> list[str]:
        return self.categorical + self.numerical

    def fit(self, df: DataFrame, places: DataFrame | None = None) -> DemandForecaster:
        """Fit on a completed demand table (geohash6, day, timestamp, demand).

        ``places`` may be the rows before completion, see ``build_features``.
        """
        mixture = {"cluster_gdowh", "cluster_prob_gdowh"} & set(self.features)
        with recorded() as self.written:
            prepared = build_features(df, bool(mixture), self.seed, places)
            prepared = materialize(prepared, "prepared")
        return self.fit_prepared(prepared)

    def close(self) -> None:
        """Remove the tables written by ``fit``. Forecasts not yet written can't be computed any more."""
        if self.prepared is not None:
            delete_tables(self.prepared.sparkSession, self.written)

    def fit_prepared(self, prepared: DataFrame) -> DemandForecaster:
        """Fit on a feature table that is cheap to read again."""
        scratch_dir(prepared.sparkSession)
        self.prepared = prepared
        label = F.col(self.target)
        if self.fit_scaler:
            self.scaler = self.fit_scaler(prepared, self.target)
            label = self.scaler.apply(label)
        rows = prepared.select(*self.features, label.cast("double").alias(LABEL))
        stages = self.stages(self.categorical, self.numerical)
        self.model = Pipeline(stages=stages).fit(rows.filter(F.col(LABEL).isNotNull()))
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """``y_hat`` for rows that carry the features."""
        scored = self.model.transform(df)
        y_hat = F.col(PREDICTION)
        return scored.select(
            *df.columns, (self.scaler.invert(y_hat) if self.scaler else y_hat).alias(PREDICTION)
        )

    def score_training(self) -> DataFrame:
        """The training table with its in-sample ``y_hat``."""
        return self.predict(self.prepared)

    def predict_futures(self, n_ticks: int = 5, tick_minutes: int = TICK_MINUTES) -> DataFrame:
        """The coming ticks of every place.

        What a coming tick cannot know (statistics, clusters, rolling mean) is looked up as the
        training mean of its place, day of week and hour.
        """
        future = future_rows(self.prepared, n_ticks, tick_minutes)
        looked_up = [c for c in self.features if c not in future.columns]
        if looked_up:
            lookup = feature_lookup(self.prepared, looked_up, self.keys)
            future = future.join(lookup, self.keys, "left")
        return self.predict(future).select(*FORECAST)

    def feature_importances(self) -> DataFrame:
        """``feature`` and ``importances``, largest first. Levels of one column are summed."""
        vector = self.model.stages[-1].featureImportances.toArray()
        names = _vector_names(self.model, self.features)
        total: dict[str, float] = {}
        for name, value in zip(names, vector, strict=True):
            total[name] = total.get(name, 0.0) + float(value)
        rows = sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))
        return self.prepared.sparkSession.createDataFrame(
            rows, "feature string, importances double"
        )


class EncodedForecaster(DemandForecaster):
    """A regressor that sees columns with any number of levels as target statistics, ``enc_{column}``.

    Training rows take the mean of the target over earlier rows of their level, in a random order; rows
    to predict that over all rows of their level, levels never seen the overall mean.
    """

    def __init__(self, *args, encoded: Sequence[str], prior: float = 1.0, **options):
        super().__init__(*args, **options)
        self.encoded = list(encoded)
        self.prior = prior
        self.means: dict[str, DataFrame] = {}
        self.unseen = 0.0

    def fit_prepared(self, prepared: DataFrame) -> EncodedForecaster:
        """Fit on a feature table that is cheap to read again; the encoded one is written."""
        rows = prepared.filter(F.col(self.target).isNotNull())
        self.unseen = rows.agg(F.avg(self.target)).first()[0] or 0.0
        encoded = prepared
        with recorded() as written:
            for c in self.encoded:
                means = level_target_means(rows, c, self.target, f"enc_{c}", self.prior)
                self.means[c] = materialize(means, "level-means")
                encoded = ordered_target_mean(encoded, c, self.target, f"enc_{c}", KEYS, self.seed, self.prior)
            encoded = materialize(encoded, "encoded")
        self.written.extend(written)
        own = [f"enc_{c}" for c in self.encoded]
        self.numerical = [c for c in self.numerical if c not in own] + own
        super().fit_prepared(encoded)
        self.prepared = prepared
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        """``y_hat`` for rows that carry the features and the encoded columns."""
        rows = df
        for c in self.encoded:
            rows = with_level_means(rows, self.means[c], c, f"enc_{c}", self.unseen)
        return super().predict(rows).select(*df.columns, PREDICTION)

    def predict_futures(self, n_ticks: int = 5, tick_minutes: int = TICK_MINUTES) -> DataFrame:
        """As the plain regressor; encoded columns must be among what a coming tick knows."""
        own = [f"enc_{c}" for c in self.encoded]
        plain, self.numerical = self.numerical, [c for c in self.numerical if c not in own]
        try:
            return super().predict_futures(n_ticks, tick_minutes)
        finally:
            self.numerical = plain


def _vector_names(model: PipelineModel, features: Sequence[str]) -> list[str]:
    """The feature behind each slot of the model's vector."""
    sizes = {}
    for stage in model.stages:
        if hasattr(stage, "categorySizes"):
            # One slot per level and one for unseen levels.
            outputs = stage.getOutputCols()
            sizes = {c.removeprefix("hot_"): n + 1 for c, n in zip(outputs, stage.categorySizes)}
    return [name for name in features for _ in range(sizes.get(name, 1))]


class TwoLevelForecaster:
    """A forecaster, and a second one fitted on what the first leaves over. Their sum is forecast.

    The second level rebuilds all features from the residuals, as if they were demand.
    """

    def __init__(self, first: DemandForecaster, second: DemandForecaster):
        self.first = first
        self.second = second
        self.written: list[str] = []

    def fit(self, df: DataFrame, places: DataFrame | None = None) -> TwoLevelForecaster:
        """Fit both levels. ``places`` may be the rows before completion, see ``build_features``."""
        self.first.fit(df, places)
        scored = self.first.score_training()
        residual = scored.withColumn("demand", F.col(self.first.target) - F.col(PREDICTION))
        with recorded() as self.written:
            residual = materialize(residual.select(*_RAW), "residuals")
        self.second.fit(residual)
        return self

    def close(self) -> None:
        """Remove the tables written by ``fit``."""
        delete_tables(self.first.prepared.sparkSession, self.written)
        self.first.close()
        self.second.close()

    def score_training(self) -> DataFrame:
        """In-sample: ``y_true``, ``y_hat`` of the first level, ``lv2_y_hat``, and their sum."""
        first = self.first.score_training().select(
            *KEYS, F.col(self.first.target).alias("y_true"), PREDICTION
        )
        second = self.second.score_training().select(
            *KEYS, "demand", F.col(PREDICTION).alias("lv2_y_hat")
        )
        both = first.join(second, KEYS, "inner")
        return both.withColumn("ensemble_y_hat", F.col(PREDICTION) + F.col("lv2_y_hat"))

    def predict_futures(self, n_ticks: int = 5, tick_minutes: int = TICK_MINUTES) -> DataFrame:
        """``lv1_yhat``, ``lv2_yhat`` and their sum ``y_hat``.

        Both forecasts are of the same rows, so the four keys identify one and carry the rest.
        """
        first = self.first.predict_futures(n_ticks, tick_minutes)
        second = self.second.predict_futures(n_ticks, tick_minutes)
        first = first.withColumnRenamed(PREDICTION, "lv1_yhat")
        second = second.select(*KEYS, F.col(PREDICTION).alias("lv2_yhat"))
        return (
            first.join(second, KEYS, "inner")
            .withColumn(PREDICTION, F.col("lv1_yhat") + F.col("lv2_yhat"))
            .select(*KEYS, *CALENDAR_GEO, "lv1_yhat", "lv2_yhat", PREDICTION)
        )
