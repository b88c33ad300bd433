import pandas as pd
import pytest
from pyspark.sql import functions as F

from tilecast.functions.calendar import add_calendar_geo
from tilecast.operators import series
from tilecast.operators.completion import complete_ticks
from tilecast.operators.futures import future_rows, next_ticks
from tilecast.plans.features import add_demand_features
from tilecast.schema import KEYS

SCHEMA = "geohash6 string, day int, hour int, minute int, demand double"


@pytest.fixture
def small(spark):
    rows = [
        ("a", 1, 0, 30, 3.0), ("b", 1, 0, 0, 10.0), ("a", 1, 0, 0, 1.0),
        ("b", 1, 10, 0, 30.0), ("b", 1, 9, 45, 20.0), ("a", 1, 0, 15, 2.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def column(df, name):
    return [r[name] for r in df.orderBy(*KEYS).collect()]


def test_lag_follows_time_and_stays_in_the_place(small):
    got = series.add_lags(small, [1, 2])
    assert column(got, "demand_tmin1") == [None, 1, 2, None, 10, 20]
    assert column(got, "demand_tmin2") == [None, None, 1, None, None, 10]


def test_rolling_mean_waits_for_a_full_window(small):
    got = series.add_rolling_mean(small, 2)
    assert column(got, "demand_rolling_2") == [None, 1.5, 2.5, None, 15, 25]
    assert column(series.add_rolling_mean(small, 4), "demand_rolling_4") == [None] * 6


def test_rolling_mean_needs_values_not_rows(spark):
    rows = [("a", 1, 0, 0, 1.0), ("a", 1, 0, 15, None), ("a", 1, 0, 30, 3.0), ("a", 1, 1, 0, 5.0)]
    got = series.add_rolling_mean(spark.createDataFrame(rows, SCHEMA), 2)
    assert column(got, "demand_rolling_2") == [None, None, None, 4.0]


def test_sequence_and_latest(small):
    assert column(series.add_sequence(small), "x") == [0, 1, 2, 0, 1, 2]
    last = {r.geohash6: (r.day, r.hour, r.minute) for r in series.latest_ticks(small).collect()}
    assert last == {"a": (1, 0, 30), "b": (1, 10, 0)}


def test_rolling_days(spark):
    daily = spark.createDataFrame([(d, float(d * d)) for d in range(1, 11)], "day int, demand double")
    got = series.rolling_days(daily, 7, ["demand", "day"]).orderBy("day").toPandas()
    want = daily.toPandas().sort_values("day").rolling(7).mean()
    pd.testing.assert_series_equal(
        got["demand_rolling_7"], want["demand"], check_names=False, check_exact=False
    )
    pd.testing.assert_series_equal(got["day_rolling_7"], want["day"], check_names=False)


def test_next_ticks(spark):
    last = spark.createDataFrame([("qp02yc", 14, 23, 30)], "geohash6 string, day int, hour int, minute int")
    got = [tuple(r)[1:] for r in next_ticks(last, 3).collect()]
    assert got == [(14, 23, 45), (15, 0, 0), (15, 0, 15)]


def test_future_rows_start_after_each_place_ends(spark, demand):
    early = demand.filter("geohash6 = 'qp02yc' or day < 9")
    got = future_rows(add_calendar_geo(early), 4)
    assert got.count() == 8
    first = {r.geohash6: r.d for r in got.groupBy("geohash6").agg(F.min("day").alias("d")).collect()}
    assert first["qp0dnh"] < first["qp02yc"]
    assert {"lat", "dow", "hour_p8", "is_weekend"} <= set(got.columns)


def pandas_features(pdf):
    """The feature definitions in pandas, on rows sorted by place and time."""
    pdf = pdf.sort_values(KEYS, ignore_index=True)
    place = pdf.groupby("geohash6")["demand"]
    for n in (1, 4, 672):
        pdf[f"demand_tmin{n}"] = place.shift(n)
    pdf["demand_rolling_4"] = place.transform(lambda s: s.rolling(4).mean())
    for name, keys in (
        ("geo", ["geohash6"]),
        ("gdow", ["geohash6", "dow"]),
        ("gdowh", ["geohash6", "dow", "hour"]),
    ):
        group = pdf.groupby(keys)["demand"]
        pdf[f"mean_demand_per_{name}"] = group.transform("mean")
        pdf[f"median_demand_per_{name}"] = group.transform("median")
    for n in (1, 4, 672):
        pdf[f"mean_enc_demand_tmin{n}"] = pdf.groupby(["geohash6", "dow", "hour"])[
            f"demand_tmin{n}"
        ].transform("mean")
    gdow = ["geohash6", "dow"]
    for q, p in (("q95", 0.95), ("q10", 0.1)):
        level = pdf.groupby(gdow)["demand"].transform(lambda s, p=p: s.quantile(p))
        pdf[f"demand_gdow_{q}"] = level
        pdf[f"demand_diff_wt_gdow_{q}"] = pdf["demand"] - level
        pdf[f"mean_demand_diff_wt_gdow_{q}"] = pdf.groupby(gdow)[
            f"demand_diff_wt_gdow_{q}"
        ].transform("mean")
    return pdf


@pytest.mark.parametrize("shuffled", [False, True])
def test_all_demand_features_match_pandas(demand, shuffled):
    base = add_calendar_geo(complete_ticks(demand))
    rows = base.repartition(7).orderBy(F.rand(3)) if shuffled else base
    got = add_demand_features(rows).toPandas().sort_values(KEYS, ignore_index=True)
    want = pandas_features(base.toPandas())
    pd.testing.assert_frame_equal(got[want.columns], want, check_exact=False, rtol=1e-9, atol=1e-9)


def test_features_take_one_exchange_after_completion(demand):
    df = add_demand_features(add_calendar_geo(complete_ticks(demand)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
    assert "Python" not in plan
