"""Exact percentiles of groups that may be as large as the whole table, by rank descent.

``percentile`` keeps every distinct value of a group in one task. That is right for one place's
series, not for all places together. Here doubles become 64-bit integers of the same order. A round
counts, per key and wanted rank, the leading bits that are still open, takes the bucket that holds the
rank, and goes on inside that bucket between its smallest and largest value, until those are one.
Only counts are shuffled, combined before the shuffle, so a hot group costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.session import delete_tables, materialize, recorded

#: Leading bits counted in a round: a key's ranks are sought among so many buckets, twice as many at most.
BITS = 14
_MANTISSA = 2.0**52
_SMALLEST_NORMAL = 2.0**-1022
_INFINITE = 0x7FF << 52


def ordered_long(x: Column) -> Column:
    """A double as a BIGINT of the same order: its bits, negated for negative numbers. NaN is the largest.

    Both zeros are 0. Only powers of two are multiplied and divided by, so nothing is rounded.
    """
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")
    ratio = size / F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(ratio >= 2, 1).when(ratio < 1, -1).otherwise(0)
    rest = ((size / F.pow(F.lit(2.0), exponent) - 1) * _MANTISSA).cast("bigint")
    bits = (
        F.when(size == 0, F.lit(0).cast("bigint"))
        .when(size == float("inf"), F.lit(_INFINITE))
        .when(size < _SMALLEST_NORMAL, (size * 2.0**537 * 2.0**537).cast("bigint"))
        .otherwise(F.shiftleft((exponent + 1023).cast("bigint"), 52) + rest)
    )
    return F.when(F.isnan(x), F.lit(_INFINITE + 1)).when(x < 0, -bits).otherwise(bits)


def double_of(k: Column) -> Column:
    """The double that ``ordered_long`` made ``k`` of."""
    size = F.abs(k)
    exponent = F.shiftright(size, 52).cast("int")
    rest = size.bitwiseAND(F.lit((1 << 52) - 1)).cast("double")
    value = F.when(exponent == 0, rest * 2.0**-1074).otherwise(
        (rest / _MANTISSA + 1) * F.pow(F.lit(2.0), exponent - 1023)
    )
    value = F.when(size == _INFINITE, float("inf")).when(size > _INFINITE, float("nan")).otherwise(value)
    return F.when(k < 0, -value).otherwise(value)


def values_at_ranks(
    rows: DataFrame, keys: Sequence[str], ranks: dict[str, Column], bits: int = BITS
) -> DataFrame:
    """Keys, ``name``, ``n`` and ``value``: the BIGINT ``_v`` at a rank, and how many rows its key has.

    ``ranks`` names 0-based ranks, as columns of the count ``n``; those outside 0 to n - 1 are left out.
    ``rows`` is read once per round: hand in a written table of few columns, without null values.
    """
    spark, keys = rows.sparkSession, list(keys)
    whole = rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    wanted = [
        F.struct(F.lit(name).alias("name"), r.cast("bigint").alias("_rank")) for name, r in ranks.items()
    ]
    state = whole.select(*keys, "n", F.inline(F.array(*wanted)), "_low", "_high")
    with recorded() as written:
        state = materialize(state.filter(F.col("_rank").between(0, F.col("n") - 1)), "ranks")
        while not state.filter("_low < _high").isEmpty():
            state = materialize(_one_round(rows, keys, state, bits), "ranks")
        last = written.pop()
        delete_tables(spark, written)
        written.append(last)
    return state.select(*keys, "name", "n", F.col("_low").alias("value"))


def _one_round(rows: DataFrame, keys: list[str], state: DataFrame, bits: int) -> DataFrame:
    """Every open rank counted from the start of the bucket that holds it, and that bucket's ends."""
    open_ = state.filter("_low < _high")

    def renamed(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
        return df.withColumnsRenamed({c: prefix + c for c in columns})

    def same(prefix: str, columns: Sequence[str]) -> Column:
        each = [F.col(c).eqNullSafe(F.col(prefix + c)) for c in columns]
        return reduce(lambda a, b: a & b, each, F.lit(True))

    # The shift leaves ``bits`` bits of the range; halves keep the difference of far ends in 64 bits.
    shift = F.expr(f"greatest(length(bin(shiftright(_high, 1) - shiftright(_low, 1))) + 1 - {bits}, 0)")
    ranges = open_.select(*keys, "_low", "_high", shift.alias("_shift")).distinct()
    bucket = F.expr("shiftright(_v, _shift) - shiftright(_low, _shift)")
    at = [f"_of_{k}" for k in keys] + ["_low"]
    counts = (
        rows.join(renamed(ranges, "_of_", keys), same("_of_", keys) & F.col("_v").between(F.col("_low"), F.col("_high")))
        .groupBy(*at, bucket.alias("_bucket"))
        .agg(F.count("*").alias("_c"), F.min("_v").alias("_first"), F.max("_v").alias("_last"))
    )
    before = Window.partitionBy(*at).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_start", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    counts = counts.withColumnRenamed("_low", "_of__low")
    holds = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_c"))
    narrowed = open_.join(counts, same("_of_", [*keys, "_low"]) & holds).select(
        *keys,
        "n",
        "name",
        (F.col("_rank") - F.col("_start")).alias("_rank"),
        F.col("_first").alias("_low"),
        F.col("_last").alias("_high"),
    )
    return narrowed.unionByName(state.filter("_low = _high"))


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], bits: int = BITS
) -> DataFrame:
    """Linearly interpolated percentiles per key: the keys and an array ``percentiles``.

    Meant for keys with few levels (hours, days, column names): the open ranges are then a small
    written table, which the optimizer broadcasts. For groups keyed by place use ``percentile``.
    """
    keys, x = list(keys), F.col(value).cast("double")
    rows = df.filter(x.isNotNull()).select(*(keys or [F.lit(0).alias("_all")]), ordered_long(x).alias("_v"))
    keys = keys or ["_all"]
    n = F.col("n")
    # For each fraction the rank below it, the next one, and how far past the first it lies.
    at = [F.lit(float(p)) * (n - 1) for p in probs]
    ranks = {
        f"{i}_{step}": F.least(F.floor(a) + step, n - 1) for i, a in enumerate(at) for step in (0, 1)
    }
    with recorded() as written:
        ordered = materialize(rows, "ordered")
        (path,) = written
        found = values_at_ranks(ordered, keys, ranks, bits)
        delete_tables(df.sparkSession, [path])
        written.remove(path)

    def of(i: int, step: int) -> Column:
        return double_of(F.max(F.when(F.col("name") == f"{i}_{step}", F.col("value"))))

    one = found.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[of(i, step).alias(f"_p{i}_{step}") for i in range(len(at)) for step in (0, 1)],
    )
    between = []
    for i, a in enumerate(at):
        low, high, past = F.col(f"_p{i}_0"), F.col(f"_p{i}_1"), a - F.floor(a)
        between.append(F.when(past == 0, low).otherwise(low + (high - low) * past))
    return one.select(*keys, F.array(*between).alias("percentiles")).drop("_all")


def percentile_at(i: int) -> Column:
    return F.get("percentiles", F.lit(i))
