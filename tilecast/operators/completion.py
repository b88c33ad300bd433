"""Fill the tick grid: every place, on every day the data has, at every tick.

The grid is never built or joined. Each place's rows are sorted once by position in the grid, and
each row emits itself and the grid positions between it and its neighbours. Only the observed rows
are shuffled, on the place, and every later per-place window reuses that shuffle. A place holds at
most one row per tick, so no place can outgrow the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.functions.calendar import tick_label, with_clock
from tilecast.schema import MINUTES_PER_DAY, TICK_MINUTES


def _calendar(days: DataFrame, within: tuple[int, int] | None = None) -> Column:
    """One struct for the whole table: the days present, the number of each, and how many of them lie
    before and up to the end of ``within``.

    A scalar subquery, so it stays lazy. It holds one int per day of the calendar range.
    """
    present = days.filter(F.col("day").isNotNull()).agg(
        F.sort_array(F.collect_set(F.col("day").cast("int"))).alias("days")
    )
    first, last = F.get("days", F.lit(0)), F.element_at("days", -1)
    numbers = F.transform(F.sequence(first, last), lambda d: F.array_position("days", d) - 1)
    return present.select(
        F.struct(
            F.col("days"),
            first.alias("first"),
            numbers.alias("numbers"),
            F.size(F.filter("days", lambda d: d < within[0]) if within else F.array()).alias("low"),
            F.size(F.filter("days", lambda d: d <= within[1]) if within else "days").alias("high"),
        )
    ).scalar()


def complete_ticks(
    df: DataFrame,
    fill: float = 0.0,
    tick_minutes: int = TICK_MINUTES,
    days: DataFrame | None = None,
    partitions: int | None = None,
    within: tuple[int, int] | None = None,
) -> DataFrame:
    """Add a row with demand ``fill`` for every tick a place lacks.

    Every place gets every day found in the data; days nobody has are not made up. Rows off the
    grid or repeated are kept as they are. ``days`` may name a cheaper frame to take the days from,
    when ``df`` is itself costly to compute; a row on another day then fails the job, since it has no
    place in the grid.

    ``within`` keeps the days from its first to its last only. Places still come from all rows, and
    ticks outside are never made, which a filter on the result could not spare.

    Rows multiply after the shuffle, so merging small shuffle partitions by their size beforehand
    would leave too few tasks for everything that follows. The number of ``partitions`` is therefore
    fixed, at the session's ``spark.sql.shuffle.partitions`` unless given.
    """
    calendar = _calendar(df if days is None else days, within)
    found = F.get(calendar["numbers"], (F.col("day") - calendar["first"]).cast("int"))
    found = F.when(found >= 0, found)
    lost = F.raise_error(F.concat(F.lit("complete_ticks: day not among days: "), F.col("day")))
    day_number = F.when(F.col("day").isNull() | found.isNotNull(), found).otherwise(lost.cast("int"))
    rows = with_clock(df).select(
        "geohash6",
        "demand",
        (day_number * MINUTES_PER_DAY + F.col("hour") * 60 + F.col("minute")).alias("position"),
    )
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(partitions, "geohash6")
    per_day = MINUTES_PER_DAY // tick_minutes
    n_ticks = F.size(calendar["days"]).cast("bigint") * per_day
    # the grid ticks of the wanted days, which are neighbours in the calendar
    low = calendar["low"].cast("bigint") * per_day
    high = calendar["high"].cast("bigint") * per_day - 1
    series = Window.partitionBy("geohash6").orderBy("position")
    rows = rows.withColumns(
        {
            "before": F.lag("position").over(series),
            "after": F.lead("position").over(series),
        }
    )

    # Grid ticks strictly between two positions. Leading ones belong to a place's first row.
    own = F.col("position")
    next_tick = F.floor(own / tick_minutes) + 1
    last_tick = F.coalesce(F.ceil(F.col("after") / tick_minutes), n_ticks) - 1
    leading = F.ceil(own / tick_minutes) - 1
    nothing = F.array().cast("array<bigint>")

    def span(begin: Column, end: Column) -> Column:
        begin, end = F.greatest(begin, low), F.least(end, high)
        return F.when(begin <= end, F.sequence(begin, end)).otherwise(nothing)

    itself = F.array(F.lit(-1).cast("bigint"))
    if within is not None:
        inside = own.between(low * tick_minutes, (high + 1) * tick_minutes - 1)
        itself = F.when(inside, itself).otherwise(nothing)
    ticks = F.concat(
        itself,
        F.when(F.col("before").isNull(), span(F.lit(0).cast("bigint"), leading)).otherwise(nothing),
        span(next_tick, last_tick),
    )
    filled = rows.select("geohash6", "demand", "position", F.explode(ticks).alias("tick"))
    observed = F.col("tick") < 0
    filled = filled.select(
        "geohash6",
        F.when(observed, own).otherwise(F.col("tick") * tick_minutes).alias("position"),
        F.when(observed, F.col("demand")).otherwise(F.lit(float(fill))).alias("demand"),
    )
    of_day = F.col("position") % MINUTES_PER_DAY
    number = F.floor(F.col("position") / MINUTES_PER_DAY).cast("int")
    filled = filled.select(
        "geohash6",
        F.get(calendar["days"], number).alias("day"),
        F.floor(of_day / 60).cast("int").alias("hour"),
        (of_day % 60).cast("int").alias("minute"),
        "demand",
    )
    return filled.select(
        "geohash6",
        "day",
        tick_label(F.col("hour"), F.col("minute")).alias("timestamp"),
        "demand",
        "hour",
        "minute",
    )


def complete_ticks_in_blocks(
    df: DataFrame,
    block_days: int,
    fill: float = 0.0,
    tick_minutes: int = TICK_MINUTES,
    days: DataFrame | None = None,
) -> DataFrame:
    """``complete_ticks`` for places whose rows no single task should hold: years of ticks, or repeated rows.

    A place's calendar is cut into blocks of ``block_days`` of the days present. Each (place, block) has
    a row of its own that begins it, so blocks without any observed row are filled, too, and none needs
    to know its neighbours. Rows without a day have no place in the grid and stay as they are.
    """
    calendar = _calendar(df if days is None else days)
    found = F.get(calendar["numbers"], (F.col("day") - calendar["first"]).cast("int"))
    found = F.when(found >= 0, found)
    lost = F.raise_error(F.concat(F.lit("complete_ticks: day not among days: "), F.col("day")))
    columns = ["geohash6", "day", "timestamp", "demand", "hour", "minute"]
    clocked = with_clock(df)
    number = F.when(found.isNotNull(), found).otherwise(lost.cast("int"))
    position = number * MINUTES_PER_DAY + F.col("hour") * 60 + F.col("minute")
    rows = clocked.filter(F.col("day").isNotNull()).select(
        "geohash6", "demand", F.floor(number / block_days).cast("int").alias("block"), position.cast("bigint").alias("position")
    )
    n_blocks = F.ceil(F.size(calendar["days"]) / block_days).cast("int")
    begins = clocked.select("geohash6").distinct().select(
        "geohash6",
        F.lit(None).cast("double").alias("demand"),
        F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"),
        F.lit(None).cast("bigint").alias("position"),
    )
    per_day = MINUTES_PER_DAY // tick_minutes
    series = Window.partitionBy("geohash6", "block").orderBy(F.asc_nulls_first("position"))
    both = rows.unionByName(begins).withColumn("after", F.lead("position").over(series))
    low = F.col("block").cast("bigint") * block_days * per_day
    high = F.least(low + block_days * per_day, F.size(calendar["days"]).cast("bigint") * per_day) - 1
    first = F.when(F.col("position").isNull(), low).otherwise(F.floor(F.col("position") / tick_minutes) + 1)
    last = F.least(F.coalesce(F.ceil(F.col("after") / tick_minutes) - 1, high), high)
    nothing = F.array().cast("array<bigint>")
    missing = F.when(first <= last, F.sequence(first, last)).otherwise(nothing)
    itself = F.when(F.col("position").isNull(), nothing).otherwise(F.array(F.lit(-1).cast("bigint")))
    filled = both.select("geohash6", "demand", "position", F.explode(F.concat(itself, missing)).alias("tick"))
    observed = F.col("tick") < 0
    filled = filled.select(
        "geohash6",
        F.when(observed, F.col("position")).otherwise(F.col("tick") * tick_minutes).alias("position"),
        F.when(observed, F.col("demand")).otherwise(F.lit(float(fill))).alias("demand"),
    )
    of_day = F.col("position") % MINUTES_PER_DAY
    number = F.floor(F.col("position") / MINUTES_PER_DAY).cast("int")
    hour, minute = F.floor(of_day / 60).cast("int"), (of_day % 60).cast("int")
    filled = filled.select(
        "geohash6",
        F.get(calendar["days"], number).alias("day"),
        tick_label(hour, minute).alias("timestamp"),
        "demand",
        hour.alias("hour"),
        minute.alias("minute"),
    )
    return filled.unionByName(clocked.filter(F.col("day").isNull()).select(*columns))
