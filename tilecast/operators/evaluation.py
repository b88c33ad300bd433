"""Forecast errors: per place, overall, and drill-downs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.functions import errors
from tilecast.functions.calendar import with_clock
from tilecast.operators.percentiles import exact_percentiles, percentile_at
from tilecast.operators.statistics import mean_of_means
from tilecast.schema import GEO, KEYS


def join_actuals(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Predictions next to the demand seen at the same place and tick; unmatched rows drop out."""
    seen = with_clock(actuals).select(*KEYS, "demand")
    return with_clock(predictions).join(seen, KEYS, "inner")


def add_errors(df: DataFrame, y: str = "demand", y_hat: str = "y_hat") -> DataFrame:
    """``err`` (predicted minus seen) and ``abs_err``."""
    err = F.col(y_hat) - F.col(y)
    return df.withColumns({"err": err, "abs_err": F.abs(err)})


def add_difference_errors(df: DataFrame) -> DataFrame:
    """``err2`` and ``abs_err2``: seen minus the difference of two levels of a forecast."""
    err = F.col("demand") - (F.col("lv1_yhat") - F.col("lv2_yhat"))
    return df.withColumns({"err2": err, "abs_err2": F.abs(err)})


def place_errors(
    df: DataFrame, keys: Sequence[str] = GEO, y: str = "demand", y_hat: str = "y_hat"
) -> DataFrame:
    """``mse``, mean ``y_true``, ``rmse`` and ``MAPE`` per place (or per any other key)."""
    scored = df.groupBy(*keys).agg(
        F.avg(F.pow(F.col(y) - F.col(y_hat), F.lit(2.0))).alias("mse"),
        F.avg(y).alias("y_true"),
    )
    return scored.withColumns(
        {
            "rmse": F.sqrt("mse"),
            "MAPE": errors.place_mape(F.col("mse"), F.col("y_true")),
        }
    )


def mean_place_error(per_place: DataFrame) -> DataFrame:
    """Mean over places of ``rmse`` and ``MAPE``: the score models are compared by."""
    return per_place.agg(F.avg("rmse").alias("rmse"), F.avg("MAPE").alias("MAPE"))


def global_metrics(
    df: DataFrame, y: str = "demand", y_hat: str = "y_hat", inf_on_zero: bool = False
) -> DataFrame:
    """mape, mape1, rmse, mae, r2 and explained variance over all rows, in one aggregate.

    A row without a prediction or without a true value takes part in none of them.
    """
    both = df.filter(F.col(y).isNotNull() & F.col(y_hat).isNotNull())
    a, b = F.col(y), F.col(y_hat)
    return both.agg(
        errors.mape(a, b, inf_on_zero).alias("mape"),
        errors.mape1(a, b).alias("mape1"),
        errors.rmse(a, b).alias("rmse"),
        errors.mae(a, b).alias("mae"),
        errors.r2(a, b).alias("r2"),
        errors.explained_variance(a, b).alias("explained_variance"),
    )


def mean_error_over_places(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean over places of each column's mean in the place."""
    return mean_of_means(df, GEO, [], columns)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column; quartiles are exact.

    The columns are stacked once, so all of them share the same passes.
    """
    stacked = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                    for c in columns
                ]
            )
        ).alias("s")
    ).select("s.*")
    basic = stacked.groupBy("column").agg(
        F.count("v").alias("count"),
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    )
    quartiles = exact_percentiles(stacked, ["column"], "v", [0.25, 0.5, 0.75])
    return basic.join(F.broadcast(quartiles), "column", "left").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        percentile_at(0).alias("q25"),
        percentile_at(1).alias("q50"),
        percentile_at(2).alias("q75"),
        "max",
    )


def worst_places(
    df: DataFrame, threshold: float = 0.2, n: int = 10, error: str = "err"
) -> DataFrame:
    """The places with the largest mean error among rows above ``threshold``."""
    return (
        df.filter(F.col(error) > threshold)
        .groupBy(*GEO)
        .agg(F.avg(error).alias(error), F.avg("demand").alias("demand"))
        .orderBy(F.desc(error), *GEO)
        .limit(n)
    )


def top_by(df: DataFrame, column: str, n: int, tie_break: Sequence[str] = GEO) -> DataFrame:
    """The ``n`` rows with the largest ``column``; ties go by key."""
    return df.orderBy(F.desc(column), *tie_break).limit(n)
