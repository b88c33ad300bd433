import pytest
from pyspark.sql import functions as F

from tilecast.functions.calendar import with_clock
from tilecast.operators import selection as sel
from tilecast.schema import KEYS


def days(df):
    return sorted({r.day for r in df.select("day").distinct().collect()})


def test_train_window_has_both_ends(demand):
    assert days(sel.train_window(demand, 3)) == [1, 2, 3, 4]
    assert days(sel.train_window(demand, 2, start_day=5)) == [5, 6, 7]


def test_quantile_of_distinct_days(spark):
    df = spark.createDataFrame([(d,) for d in range(1, 31)] + [(30,)] * 100, "day int")
    assert days(sel.train_quantile_days(df, 0.3)) == list(range(1, 10))
    bound = df.limit(1).select(sel.day_quantile(df, 0.3)).first()[0]
    assert bound == pytest.approx(9.7)


def test_train_and_holdout_make_the_whole(demand):
    train = sel.train_window(demand, 4)
    rest = sel.holdout(demand, train)
    assert train.count() + rest.count() == demand.count()
    assert days(rest) == list(range(6, 16))
    assert rest.count() == sel.holdout_days(demand, 4).count()


def test_place_and_day_filters(demand):
    assert sel.at_place(demand, "qp02yc").select("geohash6").distinct().count() == 1
    assert days(sel.on_days(demand, [10, 11, 99])) == [10, 11]
    assert [r.day for r in sel.distinct_sorted(demand, "day").collect()] == list(range(1, 16))


def test_sample_is_repeatable_under_any_partitioning(demand):
    rows = with_clock(demand)
    first = sel.frac_sample(rows, 0.2)
    again = sel.frac_sample(rows.repartition(7).orderBy(F.desc("demand")), 0.2)
    assert first.exceptAll(again).count() == 0 and again.exceptAll(first).count() == 0
    assert 0.15 < first.count() / rows.count() < 0.25
    other = sel.frac_sample(rows, 0.2, seed=2)
    assert other.exceptAll(first).count() > 0


def test_split_is_a_partition(demand):
    rows = with_clock(demand)
    train, test = sel.train_test_split(rows, 0.3)
    assert train.count() + test.count() == rows.count()
    assert train.join(test, KEYS).count() == 0
    assert 0.25 < test.count() / rows.count() < 0.35


def test_day_filter_reaches_the_scan(spark, demand, tmp_path):
    demand.write.parquet(str(tmp_path / "d"))
    plan = sel.train_window(spark.read.parquet(str(tmp_path / "d")), 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day,1)" in text and "LessThanOrEqual(day,4)" in text
