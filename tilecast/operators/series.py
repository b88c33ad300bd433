"""Order-sensitive columns along one place's series.

Every window is partitioned by the place and ordered by time, never by the order rows arrive in,
and stops at the place's border. One place holds one row per tick, so a window partition is bounded
by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.schema import GDOWH, GEO, LAGS, TIME


def series_window(group: Sequence[str] = GEO, order: Sequence[str] = TIME):
    return Window.partitionBy(*group).orderBy(*order)


def lag_column(lag: int, value: str = "demand", group: Sequence[str] = GEO) -> Column:
    return F.lag(value, lag).over(series_window(group))


def add_lags(df: DataFrame, lags: Sequence[int] = LAGS, group: Sequence[str] = GEO) -> DataFrame:
    """``demand_tmin{n}``: demand n rows earlier in the place's series."""
    return df.withColumns({f"demand_tmin{n}": lag_column(n, group=group) for n in lags})


def rolling_mean(
    window: int,
    value: str = "demand",
    group: Sequence[str] = GEO,
    order: Sequence[str] = TIME,
) -> Column:
    """Mean of the last ``window`` rows; NULL until that many values are there."""
    frame = series_window(group, order).rowsBetween(-(window - 1), 0)
    return F.when(F.count(value).over(frame) == window, F.avg(value).over(frame))


def add_rolling_mean(df: DataFrame, window: int, group: Sequence[str] = GEO) -> DataFrame:
    return df.withColumn(f"demand_rolling_{window}", rolling_mean(window, group=group))


def add_lag_means(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """``mean_enc_demand_tmin{n}``: mean of each lag over its place, day of week and hour."""
    group = Window.partitionBy(*GDOWH)
    return df.withColumns(
        {f"mean_enc_demand_tmin{n}": F.avg(f"demand_tmin{n}").over(group) for n in lags}
    )


#: Rows of a series that are worked on together where a series may be longer than a task can hold.
BLOCK_ROWS = 100_000


def add_sequence_in_blocks(
    df: DataFrame, block_days: int, group: Sequence[str] = GEO, order: Sequence[str] = TIME
) -> DataFrame:
    """``x`` as in ``add_sequence``, for series of any length: rows are numbered within ``block_days`` days.

    The counts of a series' blocks, a row for each, tell where a block's numbers begin.
    """
    block = F.floor(F.col(order[0]) / block_days).alias("_block")
    rows = df.select("*", block)
    counts = rows.groupBy(*group, "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(
        *[F.col(g).alias(f"_of_{g}") for g in group],
        F.col("_block").alias("_of__block"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_begin"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in [*group, "_block"]]
    inside = F.row_number().over(Window.partitionBy(*group, "_block").orderBy(*order))
    rows = rows.withColumn("_inside", inside - 1).join(begins, same)
    return rows.withColumn("x", (F.col("_begin") + F.col("_inside")).cast("bigint")).select(*df.columns, "x")


def add_series_in_blocks(
    df: DataFrame,
    lags: Sequence[int] = (),
    rolling: Sequence[int] = (),
    block_days: int = 100,
    block_rows: int = BLOCK_ROWS,
    value: str = "demand",
    group: Sequence[str] = GEO,
    order: Sequence[str] = TIME,
) -> DataFrame:
    """Lags and rolling means as in ``add_lags`` and ``add_rolling_mean``, for series of any length.

    Each series is numbered, and cut into blocks of ``block_rows`` rows. A block also receives the last
    rows of the one before, as many as the longest lag or window reaches back, so no task holds more
    of a series than a block and those. Rows alike in ``order`` are in no fixed order, as there.
    """
    reach = max([*lags, *(n - 1 for n in rolling), 0])
    size = max(block_rows, reach)
    rows = add_sequence_in_blocks(df, block_days, group, order)
    own = F.floor(F.col("x") / size)
    here = F.struct(own.alias("_part"), F.lit(False).alias("_halo"))
    there = F.when(F.col("x") % size >= size - reach, F.struct((own + 1).alias("_part"), F.lit(True).alias("_halo")))
    rows = rows.select("*", F.inline(F.array_compact(F.array(here, there))))
    series = Window.partitionBy(*group, "_part").orderBy("x")
    new = {f"{value}_tmin{n}": F.lag(value, n).over(series) for n in lags}
    for n in rolling:
        frame = series.rowsBetween(-(n - 1), 0)
        new[f"{value}_rolling_{n}"] = F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))
    return rows.withColumns(new).filter(~F.col("_halo")).select(*df.columns, *new)


def rolling_days(daily: DataFrame, window: int, columns: Sequence[str]) -> DataFrame:
    """Rolling mean over a table that has one row per day.

    The window has no partition key; its single task gets one row per calendar day.
    """
    frame = Window.orderBy("day").rowsBetween(-(window - 1), 0)
    return daily.select(
        "day",
        *[
            F.when(F.count(c).over(frame) == window, F.avg(c).over(frame)).alias(
                f"{c}_rolling_{window}"
            )
            for c in columns
        ],
    )


def latest_ticks(df: DataFrame) -> DataFrame:
    """The last (day, hour, minute) of each place."""
    last = df.groupBy(*GEO).agg(F.max(F.struct(*TIME)).alias("last"))
    return last.select(*GEO, "last.*")


def add_sequence(df: DataFrame) -> DataFrame:
    """``x``: 0, 1, 2, ... along each place's series."""
    return df.withColumn("x", F.row_number().over(series_window()) - 1)
