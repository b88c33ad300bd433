import pandas as pd
import pytest
from pyspark.sql import functions as F

from tilecast.functions.calendar import add_calendar_geo
from tilecast.operators import statistics as stats
from tilecast.operators.completion import complete_ticks
from tilecast.plans.features import add_demand_statistics


@pytest.fixture(scope="module")
def full(demand):
    cached = add_calendar_geo(complete_ticks(demand)).cache()
    yield cached
    cached.unpersist()


def test_keyed_tables_equal_the_window_columns(full):
    """The aggregate tables and the per-row columns are two routes to the same numbers."""
    rows = add_demand_statistics(full)
    for table in (stats.geo_stats(full), stats.gdow_stats(full), stats.gdowh_stats(full)):
        keys = [c for c in table.columns if c in ("geohash6", "dow", "hour")]
        values = [c for c in table.columns if c not in keys]
        joined = rows.alias("r").join(table.alias("t"), keys)
        assert joined.count() == rows.count()
        worst = joined.agg(
            *[F.max(F.abs(F.col(f"r.{v}") - F.col(f"t.{v}"))).alias(v) for v in values]
        ).first()
        assert all(w < 1e-9 for w in worst)


def test_quantiles_interpolate(spark):
    rows = [("a", 1, v) for v in (1.0, 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "geohash6 string, dow int, demand double")
    row = stats.gdow_stats(df).first()
    assert row.demand_gdow_q95 == pytest.approx(3.85)
    assert row.demand_gdow_q10 == pytest.approx(1.3)
    assert row.mean_demand_diff_wt_gdow_q95 == pytest.approx(2.5 - 3.85)


def test_empty_group_counts_as_zero(spark):
    df = spark.createDataFrame([("a", 1, 2, None)], "geohash6 string, dow int, hour int, demand double")
    row = stats.gdowh_stats(df).first()
    assert (row.mean_demand_per_gdowh, row.median_demand_per_gdowh) == (0, 0)


def test_tick_means_by_strategy(spark):
    rows = [("a", 0, 1, 15, 1, v) for v in (1.0, 2.0, 9.0)]
    df = spark.createDataFrame(
        rows, "geohash6 string, dow int, hour int, minute int, day int, demand double"
    )
    assert stats.tick_means(df).first().y_true == 4
    assert stats.tick_means(df, "median").first().y_true == 2
    with pytest.raises(KeyError):
        stats.tick_means(df, "mode")


def test_lookup_averages_booleans(full):
    row = (
        stats.feature_lookup(full, ["is_weekend", "is_working_hour", "demand"])
        .filter("dow = 0 and hour = 1")
        .first()
    )
    assert row.is_weekend == 1.0 and row.is_working_hour == 1.0


def test_profile_levels_and_counts(full):
    pdf = full.toPandas()
    profile = stats.place_profile(full, ["demand", "hour"]).toPandas().set_index("geohash6")
    want = pdf.groupby("geohash6")[["demand", "hour"]].agg(["sum", "mean", "median"])
    want.columns = [f"{a}_{b}" for a, b in want.columns]
    pd.testing.assert_frame_equal(
        profile.sort_index()[want.columns], want, check_dtype=False, check_exact=False
    )
    levels = {r.column: r.levels for r in stats.level_counts(full, ["hour", "dow"]).collect()}
    assert levels == {"hour": 24, "dow": 7}
    assert stats.row_counts(full, "minute").filter("n = 720").count() == 4


def test_mean_of_means_is_not_the_overall_mean(spark):
    rows = [("a", 1, 0.0), ("a", 1, 0.0), ("a", 1, 0.0), ("b", 1, 8.0)]
    df = spark.createDataFrame(rows, "geohash6 string, day int, demand double")
    got = stats.mean_of_means(df, ["geohash6", "day"], ["day"], ["demand"]).first()
    assert got.demand == 4.0


def test_places_are_distinct_points(full):
    assert stats.place_points(full).count() == 2
