"""Calendar columns over day ordinals and ``H:M`` labels.

Days are plain ordinals, not dates. Spark's ``%`` keeps the sign of the dividend, so every
remainder that can go negative uses ``pmod``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.functions.geo import add_lat_long
from tilecast.schema import MINUTES_PER_DAY, TICK_MINUTES


def _day(day: Column) -> Column:
    return F.greatest(day, F.lit(0))


def is_weekend(day: Column) -> Column:
    """Days 5, 6, 12, 13, ... are the weekend."""
    return (F.pmod(_day(day) - 5, F.lit(7)) == 0) | (F.pmod(_day(day) - 6, F.lit(7)) == 0)


def day_of_week(day: Column) -> Column:
    """Day 6 is 0 and day 5 is 6."""
    return F.pmod(_day(day) - 6, F.lit(7))


def shifted_hour(hour: Column, offset: int = 8) -> Column:
    """Hour in another time zone. The day does not roll with it."""
    return F.pmod(hour + offset, F.lit(24))


def is_working_hour(local_hour: Column, dow: Column) -> Column:
    """9 to 18, both ends in, on days of week up to 5."""
    return local_hour.between(9, 18) & (dow <= 5)


def label_hour(timestamp: Column) -> Column:
    return F.split_part(timestamp, F.lit(":"), F.lit(1)).cast("int")


def label_minute(timestamp: Column) -> Column:
    return F.split_part(timestamp, F.lit(":"), F.lit(2)).cast("int")


def tick_label(hour: Column, minute: Column) -> Column:
    """Unpadded ``H:M``."""
    return F.concat_ws(":", hour.cast("string"), minute.cast("string"))


def day_tick_label(day: Column, timestamp: Column) -> Column:
    """``D:H:M``."""
    return F.concat_ws(":", day.cast("string"), timestamp)


def drop_day(day_timestamp: Column) -> Column:
    """``D:H:M`` back to ``H:M``."""
    return F.substring_index(day_timestamp, ":", -2)


def series_minute(day: Column, hour: Column, minute: Column) -> Column:
    """Minutes since day 0, the single sortable form of (day, hour, minute)."""
    return day.cast("bigint") * MINUTES_PER_DAY + hour * 60 + minute


def from_series_minute(total: Column) -> dict[str, Column]:
    """The (day, hour, minute) columns of a ``series_minute``."""
    of_day = F.pmod(total, F.lit(MINUTES_PER_DAY))
    return {
        "day": F.floor((total - of_day) / MINUTES_PER_DAY).cast("int"),
        "hour": F.floor(of_day / 60).cast("int"),
        "minute": F.pmod(of_day, F.lit(60)).cast("int"),
    }


def advance(
    day: Column, hour: Column, minute: Column, steps: Column, tick_minutes: int = TICK_MINUTES
) -> dict[str, Column]:
    """(day, hour, minute) moved ahead by ``steps`` ticks."""
    return from_series_minute(series_minute(day, hour, minute) + steps * tick_minutes)


def with_clock(df: DataFrame) -> DataFrame:
    """Add ``hour`` and ``minute`` from ``timestamp``, unless the frame has them already."""
    if {"hour", "minute"} <= set(df.columns):
        return df
    return df.withColumns(
        {"hour": label_hour(F.col("timestamp")), "minute": label_minute(F.col("timestamp"))}
    )


def add_calendar_geo(df: DataFrame, hour_offset: int = 8) -> DataFrame:
    """The calendar and place columns every later step relies on."""
    df = with_clock(df.withColumn("day", F.col("day").cast("int")))
    df = add_lat_long(
        df.withColumns(
            {
                "is_weekend": is_weekend(F.col("day")),
                "dow": day_of_week(F.col("day")),
                "hour_p8": shifted_hour(F.col("hour"), hour_offset),
            }
        )
    )
    return df.withColumn("is_working_hour", is_working_hour(F.col("hour_p8"), F.col("dow")))
