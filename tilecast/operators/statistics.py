"""Keyed demand statistics as aggregate tables.

Means combine map-side. Exact medians and quantiles keep one counter per distinct value of a group;
all groups here start with the place, so a group is at most one place's series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.schema import GDOW, GDOWH, GDOWHM, GEO, LAGS


def _mean_and_median(suffix: str, value: str = "demand") -> list[Column]:
    return [
        F.avg(value).alias(f"mean_{value}_per_{suffix}"),
        F.median(value).alias(f"median_{value}_per_{suffix}"),
    ]


def geo_stats(df: DataFrame) -> DataFrame:
    """Mean and median demand per place."""
    return df.groupBy(*GEO).agg(*_mean_and_median("geo"))


def gdow_stats(df: DataFrame) -> DataFrame:
    """Mean, median, 95 % and 10 % quantile per place and day of week, and mean distances to both.

    The mean of ``demand - q`` is the mean minus q, so it needs no second pass.
    """
    stats = df.groupBy(*GDOW).agg(
        F.avg("demand").alias("mean_demand_per_gdow"),
        F.percentile("demand", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.1))).alias("q"),
    )
    return stats.select(
        *GDOW,
        "mean_demand_per_gdow",
        F.get("q", F.lit(0)).alias("median_demand_per_gdow"),
        F.get("q", F.lit(1)).alias("demand_gdow_q95"),
        F.get("q", F.lit(2)).alias("demand_gdow_q10"),
        (F.col("mean_demand_per_gdow") - F.get("q", F.lit(1))).alias(
            "mean_demand_diff_wt_gdow_q95"
        ),
        (F.col("mean_demand_per_gdow") - F.get("q", F.lit(2))).alias(
            "mean_demand_diff_wt_gdow_q10"
        ),
    )


def gdowh_stats(df: DataFrame) -> DataFrame:
    """Mean and median demand per place, day of week and hour; a group without demand counts 0."""
    stats = df.groupBy(*GDOWH).agg(*_mean_and_median("gdowh"))
    return stats.fillna(0, ["mean_demand_per_gdowh", "median_demand_per_gdowh"])


def lag_means(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Mean of each lag column per place, day of week and hour, nulls skipped."""
    return df.groupBy(*GDOWH).agg(
        *[F.avg(f"demand_tmin{n}").alias(f"mean_enc_demand_tmin{n}") for n in lags]
    )


def tick_means(df: DataFrame, strategy: str = "mean") -> DataFrame:
    """``y_true``: mean or median demand per place, day of week and tick of the day.

    ``last_day`` is the last day of such a tick, from which the end of a place's series follows.
    """
    pick = {"mean": F.avg, "median": F.median}[strategy]
    return df.groupBy(*GDOWHM).agg(
        pick("demand").alias("y_true"), F.max("day").alias("last_day")
    )


def feature_lookup(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = GDOWH) -> DataFrame:
    """Mean of every feature per key, the table future rows are looked up in.

    Booleans are averaged as 0 and 1.
    """
    return df.groupBy(*keys).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])


def place_profile(df: DataFrame, columns: Sequence[str] = ("demand",)) -> DataFrame:
    """Sum, mean and median of each column per place, named ``{column}_{statistic}``."""
    return df.groupBy(*GEO).agg(
        *[
            how(c).alias(f"{c}_{name}")
            for c in columns
            for name, how in (("sum", F.sum), ("mean", F.avg), ("median", F.median))
        ]
    )


def place_points(df: DataFrame) -> DataFrame:
    """The distinct places with their coordinates."""
    return df.groupBy(*GEO).agg(F.max("lat").alias("lat"), F.max("long").alias("long"))


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values of each column, one row per column.

    Every column is reduced to its distinct values across the cluster before anything is counted.
    """
    values = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("v")
    ).select("v.*")
    return values.distinct().groupBy("column").agg(F.count("value").alias("levels"))


def row_counts(df: DataFrame, column: str, of: str = "demand") -> DataFrame:
    """Number of rows with a value of ``of``, per value of ``column``."""
    return df.groupBy(column).agg(F.count(of).alias("n"))


def mean_of_means(df: DataFrame, inner: Sequence[str], outer: Sequence[str], columns) -> DataFrame:
    """Mean per ``inner`` key, then mean of those per ``outer`` key; not one overall mean."""
    first = df.groupBy(*inner).agg(*[F.avg(c).alias(c) for c in columns])
    return first.groupBy(*outer).agg(*[F.avg(c).alias(c) for c in columns])
