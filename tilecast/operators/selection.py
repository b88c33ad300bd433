"""Row selection: day windows, hold-out, places, samples, splits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.functions.calendar import with_clock
from tilecast.operators.percentiles import values_at_ranks
from tilecast.schema import KEYS
from tilecast.session import materialize


def train_window(df: DataFrame, n_days: int, start_day: int = 1) -> DataFrame:
    """Rows with ``start_day <= day <= start_day + n_days``: both ends in, so n_days + 1 days."""
    return df.filter(F.col("day").between(start_day, start_day + n_days))


def day_quantile(df: DataFrame, pct: float) -> Column:
    """Linear quantile of the distinct days, as a scalar subquery."""
    days = df.select("day").distinct()
    return days.agg(F.percentile("day", F.lit(pct)).alias("bound")).scalar()


def train_quantile_days(
    df: DataFrame, pct: float = 0.3, start_day: int = 1, days: DataFrame | None = None
) -> DataFrame:
    """Rows from ``start_day`` up to the ``pct`` quantile of the days present.

    ``days`` may name a cheaper frame to take the days from.
    """
    bound = day_quantile(df if days is None else days, pct)
    return df.filter((F.col("day") >= start_day) & (F.col("day") <= bound))


def holdout(df: DataFrame, train: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of ``df`` whose key is not in ``train``."""
    return with_clock(df).join(with_clock(train).select(*keys), list(keys), "left_anti")


def holdout_days(df: DataFrame, n_days: int, start_day: int = 1) -> DataFrame:
    """The complement of ``train_window``: the same rows as ``holdout``, without a join."""
    return df.filter(~F.col("day").between(start_day, start_day + n_days))


def at_place(df: DataFrame, geohash6: str | Column) -> DataFrame:
    return df.filter(F.col("geohash6") == geohash6)


def on_days(df: DataFrame, days: Sequence[int]) -> DataFrame:
    return df.filter(F.col("day").isin(list(days)))


def split_share(keys: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) fixed by the row's key and the seed alone."""
    # eight hex digits of md5, which any engine computes alike
    return F.conv(F.substring(key_digest(keys, seed), 1, 8), 16, 10).cast("double") / 2.0**32


def key_digest(keys: Sequence[str], seed: int | str) -> Column:
    """md5 of the key's values and the seed."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.md5(text.cast("binary"))


def frac_sample(
    df: DataFrame, frac: float = 0.2, seed: int = 1, keys: Sequence[str] = KEYS
) -> DataFrame:
    """About ``frac`` of the rows. The same rows come out under any partitioning or row order."""
    return df.filter(split_share(keys, seed) < frac)


def train_test_split(
    df: DataFrame, test_size: float = 0.3, seed: int = 1, keys: Sequence[str] = KEYS
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are ``df``; repeatable like ``frac_sample``."""
    share = split_share(keys, seed)
    return df.filter(share >= test_size), df.filter(share < test_size)


def hash_rank(keys: Sequence[str], seed: int) -> Column:
    """A BIGINT that orders rows at random, fixed by the row's key and the seed: 60 bits of md5."""
    return F.conv(F.substring(key_digest(keys, seed), 1, 15), 16, 10).cast("bigint")


def _first_rows(df: DataFrame, share: float, orders: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """The first floor(share * n) rows by ``orders``, and the rest.

    The value at the border is found by rank descent and rows are compared with it, so nothing is
    sorted. Rows tied with it, as a rule none but one, go by the next order.
    """
    hashes = materialize(df.select(orders[0].alias("_v")), "hashes")
    return _split_at(df, hashes, int(share * hashes.count()), orders)


def _split_at(
    df: DataFrame, hashes: DataFrame, size: int, orders: Sequence[Column]
) -> tuple[DataFrame, DataFrame]:
    if size == 0:
        return df.limit(0), df
    border = values_at_ranks(hashes, [], {"border": F.lit(size - 1)}).first()["value"]
    place = F.col("_v")
    row = hashes.agg(F.count_if(place < border).alias("below"), F.count_if(place == border).alias("tied")).first()
    order, missing = orders[0], size - row["below"]
    if missing == row["tied"]:
        return df.filter(order <= border), df.filter(order > border)
    tied = materialize(df.filter(order == border).withColumn("_place", F.monotonically_increasing_id()), "tied")
    rest = orders[1:] or [F.col("_place")]
    first, second = _split_at(tied, tied.select(rest[0].alias("_v")), missing, rest)
    return (
        df.filter(order < border).unionByName(first.select(df.columns)),
        df.filter(order > border).unionByName(second.select(df.columns)),
    )


def exact_sample(
    df: DataFrame, frac: float = 0.2, seed: int = 1, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Exactly floor(frac * n) rows, the same ones under any partitioning or row order."""
    return exact_split(df, frac, seed, keys)[1]


def exact_split(
    df: DataFrame, test_size: float = 0.3, seed: int = 1, keys: Sequence[str] = KEYS
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are ``df``, the second of exactly floor(test_size * n) rows.

    Rows are ordered by a hash of their key, those of one key by a hash of the whole row.
    """
    test, train = _first_rows(df, test_size, [hash_rank(keys, seed), F.xxhash64(*df.columns)])
    return train, test


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def join_suffixed(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", suffix: str = "_r"
) -> DataFrame:
    """A join in which columns of ``right`` that ``left`` has, too, get ``suffix``. Null keys meet nothing."""
    clash = [c for c in right.columns if c in left.columns and c not in keys]
    taken = [c + suffix for c in clash if c + suffix in left.columns or c + suffix in right.columns]
    if taken:
        raise ValueError(f"already a column: {', '.join(taken)}")
    renamed = reduce(lambda d, c: d.withColumnRenamed(c, c + suffix), clash, right)
    return left.join(renamed, list(keys), how)
