"""Assembly of the feature table.

All statistics, lags and rolling means of a place are windows that start with the place, so one
exchange on ``geohash6`` serves them all (and is shared with the grid completion before it). What
follows that exchange is sorting within a partition only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilecast.functions.calendar import add_calendar_geo
from tilecast.functions.geo import add_lat_long
from tilecast.operators.clusters import (
    PATTERN,
    SEED,
    add_geo_cluster,
    fit_geo_centres,
    fit_pattern_mixture,
    label_rows,
)
from tilecast.operators.series import add_lag_means, add_lags, add_rolling_mean
from tilecast.operators.statistics import gdowh_stats
from tilecast.schema import GDOW, GDOWH, GEO, LAGS
from tilecast.session import materialize

ROLLING = 4


def add_demand_statistics(df: DataFrame) -> DataFrame:
    """Mean, median and quantile columns over place, place × day of week, and × hour."""
    gdowh, gdow, geo = (Window.partitionBy(*k) for k in (GDOWH, GDOW, GEO))
    wanted = F.array(F.lit(0.5), F.lit(0.95), F.lit(0.1))
    df = df.withColumns(
        {
            "mean_demand_per_gdowh": F.coalesce(F.avg("demand").over(gdowh), F.lit(0.0)),
            "median_demand_per_gdowh": F.coalesce(F.median("demand").over(gdowh), F.lit(0.0)),
        }
    )
    # One counter of distinct values yields the three quantiles of a group.
    df = df.withColumns(
        {
            "mean_demand_per_gdow": F.avg("demand").over(gdow),
            "_q": F.percentile("demand", wanted).over(gdow),
        }
    )
    df = df.withColumns(
        {
            "mean_demand_per_geo": F.avg("demand").over(geo),
            "median_demand_per_geo": F.median("demand").over(geo),
            "median_demand_per_gdow": F.get("_q", F.lit(0)),
            "demand_gdow_q95": F.get("_q", F.lit(1)),
            "demand_gdow_q10": F.get("_q", F.lit(2)),
        }
    ).drop("_q")
    # The mean of demand - q over a group is the group's mean minus q.
    return df.withColumns(
        {
            column: change
            for q in ("q95", "q10")
            for column, change in (
                (f"demand_diff_wt_gdow_{q}", F.col("demand") - F.col(f"demand_gdow_{q}")),
                (
                    f"mean_demand_diff_wt_gdow_{q}",
                    F.col("mean_demand_per_gdow") - F.col(f"demand_gdow_{q}"),
                ),
            )
        }
    )


def add_demand_features(df: DataFrame) -> DataFrame:
    """Every feature that needs no fitted model, in one exchange on the place."""
    df = add_rolling_mean(add_lags(df, LAGS), ROLLING)
    return add_demand_statistics(add_lag_means(df, LAGS))


def build_features(
    df: DataFrame,
    use_clustering: bool = True,
    seed: int = SEED,
    places: DataFrame | None = None,
) -> DataFrame:
    """Calendar, place, demand and cluster features of a completed demand table.

    The cluster models need no more than small aggregates of the table, which are written out for
    their many passes: the distinct places, and the patterns where ``use_clustering`` asks for their
    mixture. ``places`` may name the rows before completion, which hold the same places; then nothing
    but the features themselves expands the grid. The wide feature rows are made in one go.
    """
    base = add_calendar_geo(df)
    if use_clustering:
        patterns = add_lat_long(materialize(gdowh_stats(base), "patterns"))
        points = patterns
    else:
        points = (df if places is None else places).select("geohash6").distinct()
        points = add_lat_long(materialize(points, "places"))
    centres = fit_geo_centres(points, seed=seed)
    prepared = add_geo_cluster(add_demand_features(base), centres)
    if use_clustering:
        mixture = fit_pattern_mixture(patterns, seed=seed)
        prepared = label_rows(mixture, prepared, PATTERN, "cluster_gdowh", "cluster_prob_gdowh")
    return prepared
