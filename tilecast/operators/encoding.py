"""Columns with very many levels as numbers: target statistics.

A level's number is the mean of the target over its rows, drawn to the overall mean by a prior of
some rows. Training rows must not see their own target, so each one takes the mean of the rows of its
level that come before it in a random order, fixed by a hash of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.operators.selection import hash_rank
from tilecast.schema import KEYS

#: Rows that the prior counts for, and parts that the rows of a level are ordered in, by their hash.
PRIOR, BLOCKS = 1.0, 256
_HASH_BITS = 60


def _drawn(total: Column, n: Column, overall: Column, prior: float) -> Column:
    """The mean of ``n`` values and ``prior`` times the overall mean."""
    return (total + prior * overall) / (n + prior)


def overall_mean(df: DataFrame, target: str) -> Column:
    return df.agg(F.avg(F.col(target).cast("double")).alias("m")).scalar()


def ordered_target_mean(
    df: DataFrame,
    column: str,
    target: str,
    name: str,
    keys: Sequence[str] = KEYS,
    seed: int = 1,
    prior: float = PRIOR,
    blocks: int = BLOCKS,
) -> DataFrame:
    """``df`` with ``name``: for each row the drawn mean of the target over earlier rows of its level.

    Rows of a level are ordered by a hash of ``keys`` in ``blocks`` parts. Only sums per level and part
    know of each other, so the level of a third of all rows is as many groups as there are parts. A
    missing level is a level; a missing target adds nothing. ``keys`` should tell rows apart.
    """
    y = F.col(target).cast("double")
    part = F.least(F.floor(F.col("_h").cast("double") * (blocks / float(1 << _HASH_BITS))), F.lit(blocks - 1)).cast("int")
    rows = df.withColumn("_h", hash_rank(keys, seed)).withColumn("_part", part)
    sums = rows.groupBy(F.col(column).alias("_level"), F.col("_part").alias("_of")).agg(
        F.coalesce(F.sum(y), F.lit(0.0)).alias("_sum"), F.count(y).alias("_count")
    )
    earlier = Window.partitionBy("_level").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "_level",
        "_of",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0.0)).alias("_sum"),
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_count"),
    )
    before = Window.partitionBy(column, "_part").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(carried, F.col(column).eqNullSafe(F.col("_level")) & (F.col("_part") == F.col("_of")))
    total = F.col("_sum") + F.coalesce(F.sum(y).over(before), F.lit(0.0))
    n = F.col("_count") + F.coalesce(F.count(y).over(before), F.lit(0))
    return rows.withColumn(name, _drawn(total, n, overall_mean(df, target), prior)).select(*df.columns, name)


def level_target_means(df: DataFrame, column: str, target: str, name: str, prior: float = PRIOR) -> DataFrame:
    """``column`` and ``name``: the drawn mean of the target over all rows of each level."""
    y = F.col(target).cast("double")
    sums = df.groupBy(column).agg(F.coalesce(F.sum(y), F.lit(0.0)).alias("_s"), F.count(y).alias("_n"))
    return sums.select(column, _drawn(F.col("_s"), F.col("_n"), overall_mean(df, target), prior).alias(name))


def with_level_means(df: DataFrame, means: DataFrame, column: str, name: str, unseen: float) -> DataFrame:
    """``df`` with the mean of each row's level, ``unseen`` for levels that ``means`` does not have."""
    other = means.select(F.col(column).alias("_level"), F.col(name).alias("_mean"))
    found = df.join(other, F.col(column).eqNullSafe(F.col("_level")), "left")
    return found.withColumn(name, F.coalesce("_mean", F.lit(float(unseen)))).drop("_level", "_mean")
