import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast.operators.percentiles import double_of, exact_percentiles, ordered_long, values_at_ranks
from tilecast.session import materialize

PROBS = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]


def check(df, keys, bits=14):
    got = exact_percentiles(df, keys, "v", PROBS, bits).collect()
    pdf = df.dropna(subset=["v"]).toPandas()
    groups = pdf.groupby(keys, dropna=False) if keys else [((), pdf)]
    want = {k: np.quantile(g["v"], PROBS) for k, g in groups}
    assert len(got) == len(want)
    for row in got:
        key = tuple(row[k] for k in keys)
        assert row.percentiles == pytest.approx(list(want[key]), abs=1e-9)


@pytest.mark.parametrize("bits", [3, 8, 14])
def test_exact_at_any_number_of_bits(spark, bits):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(size=3000), np.zeros(1500), [1e12, -1e9]])
    rows = [(int(i % 3), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    check(df, ["k"], bits)
    check(df, [], bits)


def test_one_group_holds_most_rows(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 7).cast("int").alias("k"),
        ((F.col("id") * 7919) % 1000 / 8).alias("v"),
    )
    check(df, ["k"])


def test_small_groups_ties_and_nulls(spark):
    rows = [(1, 5.0), (2, 1.0), (2, 2.0), (3, None), (4, 7.0), (4, 7.0), (4, 7.0), (4, None)]
    check(spark.createDataFrame(rows, "k int, v double"), ["k"])
    assert exact_percentiles(spark.createDataFrame([], "k int, v double"), ["k"], "v", [0.5]).count() == 0


def test_a_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, 5.0)], "k int, v double")
    got = {r.k: r.percentiles for r in exact_percentiles(df, ["k"], "v", [0.5]).collect()}
    assert got == {None: [1.5], 1: [5.0]}


NUMBERS = [
    0.0, -0.0, 1.0, -1.0, 0.1, 2.0**-1022, 2.0**-1074, -(2.0**-1074), 2.0**-1022 * (1 - 2.0**-52), 1.7976931348623157e308,
    -1.7976931348623157e308, math.inf, -math.inf, 1 + 2.0**-52, 1 - 2.0**-53, 8.0, 8 - 2.0**-50, 1e-300, 3e300, 0.3, 1023.999999,
]


def test_longs_keep_the_bits_and_the_order(spark):
    rng = np.random.default_rng(1)
    random = rng.integers(0, 2**64, 4000, dtype=np.uint64).view(np.float64)
    values = [*NUMBERS, *(2.0 ** np.arange(-1074, 1024)).tolist(), *random[~np.isnan(random)].tolist()]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    df = df.select("i", ordered_long(F.col("v")).alias("k")).withColumn("back", double_of(F.col("k")))
    for r in df.collect():
        (bits,) = struct.unpack("<q", struct.pack("<d", abs(values[r.i])))
        assert r.k == (-bits if values[r.i] < 0 else bits) and r.back == values[r.i]


def test_nan_is_the_largest(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (math.inf,), (-math.inf,)], "v double")
    low, mid, high = exact_percentiles(df, [], "v", [0.0, 1 / 3, 1.0]).first().percentiles
    assert low == -math.inf and mid == 1.0 and math.isnan(high)


def test_ranks_over_the_whole_range_of_64_bits(spark):
    rng = np.random.default_rng(3)
    values = sorted(int(v) for v in rng.integers(-(2**63), 2**63 - 1, 500)) + [2**63 - 1]
    rows = materialize(spark.createDataFrame([(0, v) for v in values], "k int, _v bigint").repartition(4), "longs")
    ranks = {str(i): F.lit(i) for i in (0, 1, 77, 499, 500, 501)}
    got = {r["name"]: r["value"] for r in values_at_ranks(rows, ["k"], ranks).collect()}
    assert got == {str(i): values[i] for i in (0, 1, 77, 499, 500)}


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_no_exchange_of_raw_values(spark, monkeypatch, keys):
    """Three million rows in 24 keys and in one: every table that a round shuffles is one of counts."""
    from tilecast.operators import percentiles

    plans, one_round = [], percentiles._one_round
    monkeypatch.setattr(percentiles, "_one_round", lambda *a: plans.append(one_round(*a)) or plans[-1])
    df = spark.range(3_000_000).select((F.col("id") % 24).alias("k"), F.rand(3).alias("v"))
    df = materialize(df, "rows")
    got = {r[0] if keys else None: r.percentiles[0] for r in exact_percentiles(df, keys, "v", [0.5]).collect()}
    want = df.groupBy(*keys).agg(F.percentile("v", F.lit(0.5)).alias("p")).collect()
    assert got == {(r.k if keys else None): r.p for r in want}
    assert 1 < len(plans) < 6
    for plan in plans:
        lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
        assert any("BroadcastHashJoin" in x for x in lines)
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                assert "HashAggregate" in lines[i + 1], line  # partial counts, never rows
