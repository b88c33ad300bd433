import itertools

import pytest
from pyspark.sql import functions as F

from tilecast.operators.completion import complete_ticks

SCHEMA = "geohash6 string, day int, timestamp string, demand double"


def tuples(df):
    return sorted(
        tuple(r) for r in df.select("geohash6", "day", "hour", "minute", "demand").collect()
    )


def brute_force(rows, fill=0.0, tick=15):
    """The grid, spelled out."""
    places = {r[0] for r in rows}
    days = {r[1] for r in rows}
    out = [(p, d, *map(int, t.split(":")), v) for p, d, t, v in rows]
    seen = {r[:4] for r in out}
    for p, d, m in itertools.product(places, days, range(0, 1440, tick)):
        key = (p, d, m // 60, m % 60)
        if key not in seen:
            out.append((*key, fill))
    return sorted(out)


CASES = {
    "first and last tick": [("a", 1, "0:0", 1.0), ("b", 3, "23:45", 2.0)],
    "a place on one day only": [("a", 1, "5:0", 1.0), ("a", 4, "5:15", 1.5), ("b", 2, "0:15", 2.0)],
    "off the grid": [("a", 1, "9:07", 1.0), ("a", 1, "9:15", 2.0), ("a", 2, "0:01", 3.0)],
    "repeated rows": [("a", 1, "9:0", 1.0), ("a", 1, "9:0", 2.0), ("b", 1, "9:0", 2.0)],
    "padded labels": [("a", 1, "09:00", 1.0), ("a", 1, "9:15", 2.0)],
    "day gaps and day 0": [("a", 0, "1:0", 1.0), ("b", 90, "2:0", 2.0), ("a", 7, "3:30", 3.0)],
}


@pytest.mark.parametrize("rows", CASES.values(), ids=CASES)
@pytest.mark.parametrize("partitions", [None, 3])
def test_equals_brute_force(spark, rows, partitions):
    df = spark.createDataFrame(rows, SCHEMA)
    assert tuples(complete_ticks(df, partitions=partitions)) == brute_force(rows)


def test_fill_and_tick_length(spark):
    rows = [("a", 1, "1:0", 5.0), ("b", 2, "2:0", 6.0)]
    got = complete_ticks(spark.createDataFrame(rows, SCHEMA), fill=-1.0, tick_minutes=60)
    assert tuples(got) == brute_force(rows, -1.0, 60)


def test_keeps_demand_and_is_idempotent(spark, demand):
    full = complete_ticks(demand)
    assert full.count() == 2 * 15 * 96
    total = F.round(F.sum("demand"), 6)
    assert full.agg(total).first() == demand.agg(total).first()
    assert tuples(complete_ticks(full)) == tuples(full)


def test_only_observed_rows_are_shuffled_once_on_the_place(spark, demand):
    plan = complete_ticks(demand)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_empty_table(spark):
    assert complete_ticks(spark.createDataFrame([], SCHEMA)).count() == 0


def test_null_demand_stays(spark):
    rows = [("a", 1, "0:0", None)]
    got = complete_ticks(spark.createDataFrame(rows, SCHEMA))
    assert got.filter("demand is null").count() == 1
    assert got.count() == 96


def test_a_range_of_days_is_the_filtered_grid(spark):
    rows = CASES["day gaps and day 0"] + CASES["off the grid"]
    df = spark.createDataFrame(rows, SCHEMA)
    full = tuples(complete_ticks(df))
    for within in [(2, 7), (0, 90), (100, 200)]:
        part = tuples(complete_ticks(df, within=within))
        assert part == [t for t in full if within[0] <= t[1] <= within[1]]


def test_a_day_missing_from_days_fails_and_is_not_lost(spark):
    df = spark.createDataFrame([("a", 1, "0:0", 1.0), ("a", 2, "0:0", 1.0)], SCHEMA)
    days = spark.createDataFrame([(1,), (3,)], "day int")
    with pytest.raises(Exception, match="day not among days"):
        complete_ticks(df, days=days).collect()
