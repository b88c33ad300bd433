import math

import pytest
from pyspark.sql import functions as F

from tilecast.functions import calendar as cal
from tilecast.functions import errors, geo
from tilecast.functions.geo import ALPHABET


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_day_of_week_and_weekend(spark):
    days = [-3, 0, 1, 5, 6, 7, 12, 13]
    df = spark.createDataFrame([(d,) for d in days], "day int")
    got = df.select("day", cal.day_of_week(F.col("day")), cal.is_weekend(F.col("day"))).collect()
    assert [r[1] for r in got] == [1, 1, 2, 6, 0, 1, 6, 0]
    assert [r[2] for r in got] == [False, False, False, True, True, False, True, True]


def test_working_hour_follows_local_hour_and_day(spark):
    cases = [(1, 5), (10, 5), (11, 5), (1, 6), (1, 0), (0, 3)]
    df = spark.createDataFrame(cases, "hour int, dow int")
    local = cal.shifted_hour(F.col("hour"))
    got = df.select(local, cal.is_working_hour(local, F.col("dow"))).collect()
    assert [tuple(r) for r in got] == [
        (9, True), (18, True), (19, False), (9, False), (9, True), (8, False),
    ]


def test_hour_offset_wraps_both_ways(spark):
    row = one(
        spark, east=cal.shifted_hour(F.lit(20), 8), west=cal.shifted_hour(F.lit(2), -5)
    )
    assert (row.east, row.west) == (4, 21)


def test_clock_parses_padded_and_unpadded_labels(spark):
    df = spark.createDataFrame([("9:0",), ("09:00",), ("23:45",)], "timestamp string")
    got = cal.with_clock(df).select("hour", "minute").collect()
    assert [tuple(r) for r in got] == [(9, 0), (9, 0), (23, 45)]


def test_labels(spark):
    row = one(
        spark,
        tick=cal.tick_label(F.lit(9), F.lit(0)),
        full=cal.day_tick_label(F.lit(3), F.lit("9:0")),
        back=cal.drop_day(F.lit("3:9:0")),
    )
    assert tuple(row) == ("9:0", "3:9:0", "9:0")


@pytest.mark.parametrize(
    ("step", "expected"),
    [(1, (14, 23, 45)), (2, (15, 0, 0)), (3, (15, 0, 15)), (200, (17, 1, 30))],
)
def test_advance_carries_hours_and_days(spark, step, expected):
    moved = cal.advance(F.lit(14), F.lit(23), F.lit(30), F.lit(step))
    assert tuple(one(spark, **moved)) == expected


def test_advance_by_more_than_an_hour(spark):
    moved = cal.advance(F.lit(1), F.lit(22), F.lit(0), F.lit(1), tick_minutes=150)
    assert tuple(one(spark, **moved)) == (2, 0, 30)


def decode(geohash):
    """Bit by bit, the textbook way."""
    bounds = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}
    turn = 0
    for char in geohash:
        for shift in range(4, -1, -1):
            low, high = bounds[turn]
            bit = (ALPHABET.index(char) >> shift) & 1
            bounds[turn] = [(low + high) / 2, high] if bit else [low, (low + high) / 2]
            turn = 1 - turn
    return sum(bounds[1]) / 2, sum(bounds[0]) / 2


@pytest.mark.parametrize("precision", [1, 2, 5, 6, 7, 11, 12])
def test_geohash_centre_at_any_precision(spark, precision):
    base = "qp02yczu7b9d"
    hashes = [base[:precision], ("z" * 12)[:precision], ("0" * 12)[:precision]]
    df = spark.createDataFrame([(h,) for h in hashes], "g string")
    got = df.select(
        geo.geohash_lat(F.col("g"), precision), geo.geohash_long(F.col("g"), precision)
    ).collect()
    for row, h in zip(got, hashes):
        assert tuple(row) == pytest.approx(decode(h), abs=1e-12)


def test_geohash_round_trip(spark):
    cells = spark.range(0, 2**15, 97).select(
        F.col("id").alias("la"), ((F.col("id") * 7919) % 2**15).alias("lo")
    )
    coded = cells.withColumn("g", geo.geohash_of_cell(F.col("la"), F.col("lo")))
    back = coded.filter(
        (geo.cell_number(F.col("g"), False) != F.col("la"))
        | (geo.cell_number(F.col("g"), True) != F.col("lo"))
        | (F.length("g") != 6)
    )
    assert back.count() == 0
    odd = cells.withColumn("g", geo.geohash_of_cell(F.col("la") % 2**12, F.col("lo") % 2**13, 5))
    bad = odd.filter(
        (geo.cell_number(F.col("g"), False, 5) != F.col("la") % 2**12)
        | (geo.cell_number(F.col("g"), True, 5) != F.col("lo") % 2**13)
    )
    assert bad.count() == 0


def test_malformed_geohash_is_null(spark):
    df = spark.createDataFrame([("qp02y",), ("qp02ya",), ("qp02ycc",), (None,)], "geohash6 string")
    assert all(r.lat is None and r.long is None for r in geo.add_lat_long(df).collect())


def test_haversine(spark):
    row = one(
        spark,
        km=geo.haversine_km(
            F.lit(-5.484924), F.lit(90.653687), F.lit(-5.356486), F.lit(90.691755)
        ),
        zero=geo.haversine_km(F.lit(1.0), F.lit(2.0), F.lit(1.0), F.lit(2.0)),
    )
    assert row.km == pytest.approx(14.890391221558906, abs=1e-9)
    assert row.zero == 0


def test_error_formulas(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0)], "y double, p double")
    y, p = F.col("y"), F.col("p")
    row = df.agg(
        errors.mape(y, p).alias("mape"),
        errors.mape(y, p, inf_on_zero=True).alias("inf"),
        errors.mape1(y, p).alias("mape1"),
        errors.rmse(y, p).alias("rmse"),
        errors.mae(y, p).alias("mae"),
    ).first()
    assert row.mape == 0
    assert row.inf == math.inf
    assert row.mape1 == pytest.approx(350 / 3)
    assert row.rmse == pytest.approx(math.sqrt(0.5))
    assert row.mae == 0.5


def test_zero_over_zero_is_skipped_even_with_inf(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 1.0)], "y double, p double")
    assert df.agg(errors.mape(F.col("y"), F.col("p"), True)).first()[0] == 50


def test_r2_and_explained_variance(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (4.0, 4.0)], "y double, p double")
    row = df.agg(
        errors.r2(F.col("y"), F.col("p")).alias("r2"),
        errors.explained_variance(F.col("y"), F.col("p")).alias("ev"),
    ).first()
    assert row.r2 == pytest.approx(0.5714285714)
    assert row.ev == pytest.approx(0.8571428571)


def test_a_cell_that_does_not_fit_has_no_geohash(spark):
    cells = [(0, 0), (32767, 32767), (32768, 0), (0, 32768), (-1, 0)]
    df = spark.createDataFrame(cells, "la long, lo long")
    got = [r[0] for r in df.select(geo.geohash_of_cell(F.col("la"), F.col("lo"))).collect()]
    assert got == ["000000", "zzzzzz", None, None, None]
