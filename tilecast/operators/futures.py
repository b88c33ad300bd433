"""Ticks after the end of each place's series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.functions.calendar import add_calendar_geo, advance
from tilecast.operators.series import latest_ticks
from tilecast.schema import TICK_MINUTES


def next_ticks(last: DataFrame, n_ticks: int, tick_minutes: int = TICK_MINUTES) -> DataFrame:
    """``n_ticks`` rows per row of ``last`` (geohash6, day, hour, minute), one per coming tick."""
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n_ticks))))
    moved = advance(
        F.col("day"), F.col("hour"), F.col("minute"), F.col("step"), tick_minutes
    )
    return steps.select("geohash6", *[c.alias(name) for name, c in moved.items()])


def future_rows(df: DataFrame, n_ticks: int, tick_minutes: int = TICK_MINUTES) -> DataFrame:
    """The coming ticks of every place in ``df``, with their calendar and place columns."""
    return add_calendar_geo(next_ticks(latest_ticks(df), n_ticks, tick_minutes))
