import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_oracle import connect, difference
from tilecast.operators.completion import complete_ticks
from tilecast.sources.events import demand_from_events, event_days

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, engine, name):
    got = queries()[name](spark, SF).toPandas()
    assert difference(got, engine.execute(oracle_sql()[name]).df()) is None
    assert len(got) > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_sampling_queries(spark):
    whole = demand_from_events(spark, SF).count()
    assert queries()["train_test_split"](spark, SF).count() == whole
    assert 0 < queries()["hash_sample"](spark, SF).count() < whole / 2


def test_entry(spark):
    df = entry(spark)
    assert df.columns[-1] == "y_hat" and df.count() == 10


def test_a_place_with_most_events_stays_as_small_as_the_others(spark, tmp_path):
    """Nine of ten events from one user: after the first aggregate all places are alike."""
    events = spark.range(30_000).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 61).cast("decimal(18,6)"))
        ).alias("ts"),
        F.when(F.col("id") % 10 > 0, 5).otherwise(F.col("id") % 60).alias("user_id"),
        (F.col("id") % 100 / 4).alias("value"),
    )
    folder = str(tmp_path)
    events.write.parquet(f"{folder}/events.parquet")
    demand = demand_from_events(spark, folder)
    full = complete_ticks(demand, days=event_days(spark, folder))
    sizes = {r["count"] for r in full.groupBy("geohash6").count().collect()}
    days = event_days(spark, folder).distinct().count()
    assert sizes == {days * 96}
    total = full.agg(F.round(F.sum("demand"), 2)).first()[0]
    assert total == events.agg(F.round(F.sum("value"), 2)).first()[0]
