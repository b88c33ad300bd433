import pytest
from pyspark.sql import functions as F

from tilecast.functions.calendar import with_clock
from tilecast.operators import series
from tilecast.operators.completion import complete_ticks, complete_ticks_in_blocks
from tilecast.schema import KEYS


def rows(df, *columns):
    return sorted(map(tuple, df.select(*KEYS, *columns).collect()), key=str)


@pytest.fixture(scope="module")
def sparse(demand):
    """Ticks of two places, many days without any of one of them."""
    clocked = with_clock(demand)
    return clocked.filter((F.col("geohash6") == "qp02yc") | (F.col("day") % 5 == 1)).cache()


@pytest.mark.parametrize(("block_days", "block_rows"), [(3, 50), (1, 700), (100, 100_000)])
def test_lags_and_rolling_means_in_blocks(sparse, block_days, block_rows):
    lags = [1, 4, 40]
    want = series.add_rolling_mean(series.add_rolling_mean(series.add_lags(sparse, lags), 4), 30)
    got = series.add_series_in_blocks(sparse, lags, [4, 30], block_days, block_rows)
    columns = [*[f"demand_tmin{n}" for n in lags], "demand_rolling_4", "demand_rolling_30"]
    assert got.columns == [*sparse.columns, *columns]
    assert rows(got, *columns[:3]) == rows(want, *columns[:3])
    for a, b in zip(rows(got, *columns[3:]), rows(want, *columns[3:]), strict=True):
        assert a[:4] == b[:4] and [x is None for x in a[4:]] == [x is None for x in b[4:]]
        assert all(x == pytest.approx(y) for x, y in zip(a[4:], b[4:]) if x is not None)


def test_a_lag_longer_than_a_block(sparse):
    want = series.add_lags(sparse, [672])
    assert rows(series.add_series_in_blocks(sparse, [672], block_days=2, block_rows=10), "demand_tmin672") == rows(want, "demand_tmin672")


@pytest.mark.parametrize("block_days", [1, 3, 1000])
def test_sequence_in_blocks(sparse, block_days):
    assert rows(series.add_sequence_in_blocks(sparse, block_days), "x") == rows(series.add_sequence(sparse), "x")


def test_no_task_holds_a_whole_place(spark):
    """A hundred thousand rows of one place: no window group is larger than a block and its halo."""
    df = spark.range(100_000).select(
        F.lit("a").alias("geohash6"), F.floor(F.col("id") / 96).cast("int").alias("day"), F.floor(F.col("id") % 96 / 4).cast("int").alias("hour"),
        (F.col("id") % 4 * 15).cast("int").alias("minute"), F.col("id").cast("double").alias("demand"),
    )
    got = series.add_series_in_blocks(df, [672], [4], block_days=30, block_rows=5000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan and got.filter("demand >= 672 and demand_tmin672 != demand - 672").count() == 0
    assert got.filter("demand_rolling_4 != demand - 1.5").count() == 0 and got.count() == 100_000


@pytest.mark.parametrize("block_days", [1, 2, 3, 100])
def test_completion_in_blocks(sparse, block_days):
    raw = sparse.select("geohash6", "day", "timestamp", "demand").filter("day != 4")
    want = complete_ticks(raw)
    got = complete_ticks_in_blocks(raw, block_days)
    assert rows(got, "timestamp", "demand") == rows(want, "timestamp", "demand")


def test_completion_in_blocks_of_odd_rows(spark):
    data = [("a", 1, "0:0", 1.0), ("a", 1, "0:0", 2.0), ("a", 9, "23:45", 3.0), ("b", 5, "12:7", 4.0), ("b", None, "1:0", 5.0), (None, 5, "3:0", 6.0)]
    raw = spark.createDataFrame(data, "geohash6 string, day int, timestamp string, demand double")
    got = complete_ticks_in_blocks(raw, 2)
    assert got.filter("day is null").count() == 1
    clean = raw.filter("day is not null and geohash6 is not null")
    # the third place, without a name, adds the grid of the three days and its own row stays
    assert rows(got.filter("day is not null and geohash6 is not null"), "demand") == rows(complete_ticks(clean), "demand")
    assert got.filter("geohash6 is null").count() == 3 * 96
    assert complete_ticks_in_blocks(raw.filter("demand > 99"), 2).count() == 0
