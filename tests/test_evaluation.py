import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tilecast.operators import evaluation as ev
from tilecast.operators import exploration as ex

SCHEMA = "geohash6 string, day int, hour int, minute int, demand double, y_hat double"


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(2)
    rows = [
        (p, 1 + i // 96, i % 96 // 4, 15 * (i % 4), float(rng.gamma(2)), float(rng.gamma(2)))
        for p in ("a", "b", "c")
        for i in range(300)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def test_place_error_example(spark):
    rows = [("a", 1, 0, 0, 0.0, 1.0), ("a", 1, 0, 15, 2.0, 2.0)]
    row = ev.place_errors(spark.createDataFrame(rows, SCHEMA)).first()
    assert row.mse == 0.5 and row.y_true == 1 and row.MAPE == pytest.approx(-25)
    assert row.rmse == pytest.approx(0.70710678)


def test_mean_place_error_is_a_mean_of_places(scored):
    pdf = scored.toPandas()
    rmse = pdf.groupby("geohash6").apply(
        lambda g: np.sqrt(np.mean((g.demand - g.y_hat) ** 2)), include_groups=False
    )
    got = ev.mean_place_error(ev.place_errors(scored)).first()
    assert got.rmse == pytest.approx(rmse.mean())


def test_global_metrics_match_numpy(scored):
    pdf = scored.toPandas()
    y, e = pdf.demand, pdf.demand - pdf.y_hat
    got = ev.global_metrics(scored).first()
    assert got.mape == pytest.approx((abs(e) / y).mean() * 100)
    assert got.mape1 == pytest.approx(((abs(e) + 1) / (y + 1)).mean() * 100)
    assert got.rmse == pytest.approx(np.sqrt((e**2).mean()))
    assert got.mae == pytest.approx(abs(e).mean())
    assert got.r2 == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    assert got.explained_variance == pytest.approx(1 - e.var(ddof=0) / y.var(ddof=0))


def test_join_is_by_key_whatever_the_label_form(spark):
    actual = spark.createDataFrame(
        [("a", 1, "09:00", 2.0), ("a", 1, "9:15", 3.0)],
        "geohash6 string, day int, timestamp string, demand double",
    )
    predicted = spark.createDataFrame(
        [("a", 1, 9, 0, 1.0), ("a", 2, 9, 15, 1.0)],
        "geohash6 string, day int, hour int, minute int, y_hat double",
    )
    rows = ev.join_actuals(predicted, actual).collect()
    assert [(r.demand, r.y_hat) for r in rows] == [(2.0, 1.0)]


def test_describe_matches_pandas(scored):
    got = ev.describe(scored, ["demand", "y_hat"]).toPandas().set_index("column")
    want = scored.toPandas()[["demand", "y_hat"]].describe().T
    want.columns = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    pd.testing.assert_frame_equal(
        got.sort_index()[want.columns], want, check_dtype=False, check_names=False,
        check_exact=False,
    )


def test_describe_of_an_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    rows = {r["column"]: r for r in ev.describe(df, ["a", "b"]).collect()}
    assert rows["b"]["count"] == 0 and rows["b"]["q50"] is None
    assert rows["a"]["q50"] == 1.5


def test_drill_downs_break_ties_by_place(spark):
    rows = [(p, 1, 0, 0, 0.0, 1.0) for p in "dcba"] + [("e", 1, 0, 0, 0.0, 0.1)]
    judged = ev.add_errors(spark.createDataFrame(rows, SCHEMA))
    worst = ev.worst_places(judged, 0.2, 3).collect()
    assert [r.geohash6 for r in worst] == ["a", "b", "c"]
    top = ev.top_by(ev.place_errors(judged), "rmse", 2).collect()
    assert [r.geohash6 for r in top] == ["a", "b"]


def test_two_stage_error(scored):
    pdf = scored.toPandas()
    want = (pdf.y_hat - pdf.demand).abs().groupby(pdf.geohash6).mean().mean()
    got = ev.mean_error_over_places(ev.add_errors(scored), ["abs_err"]).first()
    assert got.abs_err == pytest.approx(want)


def test_rows_at_median_may_be_none_or_many(spark):
    rows = [("a", 1, 0, 0, v, 0.0) for v in (1.0, 2.0)] + [
        ("b", 1, 0, m, v, 0.0) for m, v in ((0, 1.0), (15, 2.0), (30, 2.0), (45, 3.0))
    ]
    got = ex.rows_at_median(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.geohash6, r.minute) for r in got] == [("b", 15), ("b", 30)]


def test_pivot_has_every_hour(scored):
    sums = ex.sum_by_day_hour(scored)
    wide = ex.pivot_hours(sums, "day").toPandas().set_index("day").sort_index()
    pdf = scored.toPandas()
    want = pdf.groupby(["day", (pdf.hour + 8) % 24])["demand"].sum().unstack().fillna(0)
    want = want.reindex(columns=range(24), fill_value=0)
    np.testing.assert_allclose(wide.to_numpy(), want.to_numpy())


def test_histogram_keeps_every_row(spark, scored):
    bins = ex.histogram(scored, "demand", 7).toPandas()
    want, _ = np.histogram(scored.toPandas().demand, 7)
    assert list(bins.sort_values("bin").n) == list(want)
    flat = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    assert [tuple(r) for r in ex.histogram(flat, "x", 5).collect()] == [(1, 2)]
    fixed = ex.histogram(scored, "demand", 4, limits=(0, 1)).agg(F.sum("n")).first()[0]
    assert fixed == scored.count()


def test_box_matches_numpy(scored):
    got = {r.hour: r for r in ex.box_by(scored, "hour").collect()}
    for hour, g in scored.toPandas().groupby("hour"):
        q25, q50, q75 = np.quantile(g.demand, [0.25, 0.5, 0.75])
        row = got[hour]
        assert (row.q25, row.q50, row.q75) == pytest.approx((q25, q50, q75))
        inside = g.demand[g.demand.between(2.5 * q25 - 1.5 * q75, 2.5 * q75 - 1.5 * q25)]
        assert (row.whisker_low, row.whisker_high) == (inside.min(), inside.max())


def test_line_density_and_series(scored):
    line = ex.line_by(scored, "day").toPandas().set_index("day").sort_index()
    want = scored.toPandas().groupby("day").demand
    np.testing.assert_allclose(line["mean"], want.mean())
    np.testing.assert_allclose(line.stderr, want.sem())
    points = scored.sparkSession.createDataFrame(
        [(0.01, 0.01), (0.04, 0.02), (-0.01, 0.01)], "lat double, long double"
    )
    cells = {(r.lat_cell, r.long_cell): r.n for r in ex.grid_density(points).collect()}
    assert cells == {(0, 0): 2, (-1, 0): 1}
    chosen = ex.place_series(scored, ["a", "b"])
    assert chosen.columns == ["geohash6", "x", "demand", "y_hat"]
    assert chosen.count() == 600 and chosen.agg(F.max("x")).first()[0] == 299
    assert ex.place_series(scored).count() == 900
