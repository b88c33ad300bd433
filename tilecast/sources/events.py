"""Demand table derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilecast.functions.calendar import tick_label
from tilecast.functions.geo import geohash_of_cell
from tilecast.schema import TICK_MINUTES

FIRST_DAY = "2024-01-01"
#: Places are laid out 2 * 16 rows and 32768 columns to a band; there is room for so many bands.
BANDS = 818


def _event_day(ts):
    return F.datediff(ts.cast("date"), F.lit(FIRST_DAY).cast("date")) + 1


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day ordinal of every event, read from one column."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(_event_day(F.col("ts")).alias("day"))


def demand_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of event values per place, day and tick.

    Ten neighbouring users make one place; odd and even places lie in two areas. The sum is
    partially aggregated before its shuffle on four keys, so a busy place costs no more than its
    number of ticks, and geohashes are spelled only for the aggregated rows. No two of the first 850
    million places share a geohash; a place beyond has none (NULL).
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    place = F.expr("user_id div 10")
    ticks = (
        events.select(
            place.alias("place"),
            _event_day(F.col("ts")).alias("day"),
            F.hour("ts").alias("hour"),
            (F.minute("ts") - F.minute("ts") % TICK_MINUTES).alias("minute"),
            "value",
        )
        .groupBy("place", "day", "hour", "minute")
        .agg(F.round(F.sum("value"), 2).alias("demand"))
    )
    odd = F.col("place") % 2
    band = F.expr("place div 1048576")
    low = F.when(band.between(0, BANDS - 1), 25 + 40 * ((384 + band) % BANDS))
    cells = ticks.withColumns(
        {
            "lat_cell": low + F.expr("place div 2") % 16 + 20 * odd,
            "long_cell": (24635 + F.expr("place div 32") % 32768 + 60 * odd) % 32768,
        }
    )
    return cells.select(
        geohash_of_cell(F.col("lat_cell"), F.col("long_cell")).alias("geohash6"),
        "day",
        tick_label(F.col("hour"), F.col("minute")).alias("timestamp"),
        "demand",
    )
