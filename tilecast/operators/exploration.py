"""Tables behind the usual charts of a demand table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.functions.calendar import shifted_hour
from tilecast.operators.percentiles import exact_percentiles, percentile_at
from tilecast.operators.selection import key_digest
from tilecast.operators.series import add_sequence
from tilecast.operators.statistics import mean_of_means
from tilecast.schema import GEO, KEYS
from tilecast.session import materialize

HOURS = list(range(24))


def daily_mean(df: DataFrame) -> DataFrame:
    """Mean per place and day, then mean of those per day."""
    return mean_of_means(df, ["geohash6", "day"], ["day"], ["demand"])


def rows_at_median(df: DataFrame) -> DataFrame:
    """Rows whose demand equals their place's median. None or several per place may."""
    median = F.median("demand").over(Window.partitionBy(*GEO))
    return df.withColumn("demand_median", median).filter(
        F.col("demand") == F.col("demand_median")
    )


def sum_by_day_hour(df: DataFrame, offset: int = 8) -> DataFrame:
    """Demand summed per day and GMT hour; the hour is then shown in local time.

    The shift follows the sum and does not move the day.
    """
    sums = df.groupBy("day", "hour").agg(F.sum("demand").alias("demand"))
    return sums.withColumn("hour", shifted_hour(F.col("hour"), offset))


def median_by_day_hour(df: DataFrame, offset: int = 8) -> DataFrame:
    """Median demand per day and GMT hour over all places, hour shown in local time."""
    medians = exact_percentiles(df, ["day", "hour"], "demand", [0.5])
    return medians.select(
        "day",
        shifted_hour(F.col("hour"), offset).alias("hour"),
        percentile_at(0).alias("demand"),
    )


def pivot_hours(df: DataFrame, by: str, value: str = "demand") -> DataFrame:
    """One row per ``by``, one column ``h0`` ... ``h23`` per hour, 0 where there is nothing.

    The hours are given, so no extra job looks for them.
    """
    wide = df.groupBy(by).pivot("hour", HOURS).agg(F.sum(value)).fillna(0)
    return wide.select(by, *[F.col(str(h)).alias(f"h{h}") for h in HOURS])


def histogram(
    df: DataFrame, column: str, n_bins: int = 20, by: Sequence[str] = (), limits=None
) -> DataFrame:
    """Row counts in ``n_bins`` equal bins (1 to n) between ``limits`` or the column's own ends."""
    x = F.col(column).cast("double")
    if limits is None:
        ends = df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high")).alias("e")).scalar()
        low, high = ends["low"], ends["high"]
    else:
        low, high = (F.lit(float(end)) for end in limits)
    # The upper end belongs to the last bin, and a constant column fills the first.
    bin_ = F.least(F.coalesce(F.width_bucket(x, low, high, F.lit(n_bins)), F.lit(1)), F.lit(n_bins))
    return (
        df.filter(x.isNotNull())
        .select(*by, bin_.cast("int").alias("bin"))
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("n"))
    )


def auto_histogram(df: DataFrame, column: str, most: int = 50) -> DataFrame:
    """Row counts in bins whose number the data give: ``bin``, its ``low`` and ``high``, ``n``.

    The width is that of Freedman and Diaconis, 2 IQR / cube root of n; with an IQR of 0 there are
    floor(sqrt(n)) bins, and never more than ``most``. Empty bins have n = 0.
    """
    x = F.col(column).cast("double")
    rows = df.filter(x.isNotNull() & ~F.isnan(x)).select(x.alias("x"))
    ends = rows.agg(
        F.count("*").alias("rows"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        exact_percentiles(rows, [], "x", [0.25, 0.75]).scalar().alias("percentiles"),
    ).filter("rows > 0")
    spread, reach = percentile_at(1) - percentile_at(0), F.col("high") - F.col("low")
    by_width = F.ceil(reach / (2 * spread / F.pow("rows", F.lit(1 / 3))))
    wanted = F.when(spread > 0, by_width).otherwise(F.floor(F.sqrt("rows")))
    bins = F.greatest(F.least(wanted, F.lit(most)), F.lit(1)).cast("int")
    plan = materialize(ends.select("low", "high", bins.alias("bins")), "bins")  # one row
    one = plan.select(F.struct("low", "high", "bins").alias("s")).scalar()
    bucket = F.coalesce(F.width_bucket(F.col("x"), one["low"], one["high"], one["bins"]), F.lit(1))
    counts = rows.groupBy(F.least(bucket.cast("int"), one["bins"]).alias("bin")).agg(F.count("*").alias("n"))
    step = (F.col("high") - F.col("low")) / F.col("bins")
    every = plan.select("*", F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (F.col("low") + (F.col("bin") - 1) * step).alias("low"),
        (F.col("low") + F.col("bin") * step).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_by(df: DataFrame, by: str, value: str = "demand") -> DataFrame:
    """Quartiles per level of ``by``, and whiskers at the last values within 1.5 IQR of them."""
    quartiles = exact_percentiles(df, [by], value, [0.25, 0.5, 0.75]).select(
        by,
        percentile_at(0).alias("q25"),
        percentile_at(1).alias("q50"),
        percentile_at(2).alias("q75"),
    )
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = F.col(value).between(F.col("q25") - reach, F.col("q75") + reach)
    return (
        df.select(by, value)
        .join(quartiles, by)
        .groupBy(by, "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        )
    )


def line_by(
    df: DataFrame, x: str, value: str = "demand", by: Sequence[str] = ()
) -> DataFrame:
    """Mean of ``value`` and its standard error per ``x``, one line per level of ``by``."""
    return df.groupBy(*by, x).agg(
        F.avg(value).alias("mean"),
        F.try_divide(F.stddev_samp(value), F.sqrt(F.count(value))).alias("stderr"),
        F.count(value).alias("n"),
    )


def grid_density(points: DataFrame, step: float = 0.05) -> DataFrame:
    """Number of points in each ``step`` by ``step`` degree cell."""

    def cell(axis: str) -> Column:
        return F.floor(F.col(axis) / step).cast("int")

    return points.groupBy(cell("lat").alias("lat_cell"), cell("long").alias("long_cell")).agg(
        F.count("*").alias("n")
    )


def kernel_density(
    points: DataFrame, columns: Sequence[str] = ("lat", "long"), per_bandwidth: int = 4
) -> DataFrame:
    """A Gaussian kernel density of ``points`` on a grid: cell numbers, cell centres, ``mass``, ``density``.

    The bandwidth of an axis is Scott's, its standard deviation times n^(-1 / (axes + 4)), and a cell is
    a ``per_bandwidth``-th of it. Points are counted per cell first; then each axis in turn passes
    every cell's mass to the cells within three bandwidths, with weights that add up to 1. Work and
    shuffles depend on the occupied cells, not on the points. An axis without spread is one cell.
    """
    columns = list(columns)
    whole = [F.col(c).cast("double") for c in columns]
    rows = points.select([w.alias(c) for w, c in zip(whole, columns, strict=True)])
    rows = rows.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in columns]))
    factor = F.pow(F.count("*").cast("double"), F.lit(-1 / (len(columns) + 4)))
    steps = rows.agg(
        F.struct(
            F.count("*").alias("n"),
            *[(F.coalesce(F.stddev_samp(c), F.lit(0.0)) * factor / per_bandwidth).alias(c) for c in columns],
        ).alias("s")
    )
    steps = materialize(steps, "bandwidths").scalar()
    cells = {c: F.when(steps[c] > 0, F.floor(F.col(c) / steps[c])).otherwise(F.lit(0)) for c in columns}
    of = {c: f"{c}_cell" for c in columns}
    mass = rows.groupBy([x.cast("bigint").alias(of[c]) for c, x in cells.items()]).agg(
        (F.count("*") / steps["n"]).alias("mass")
    )
    reach = 3 * per_bandwidth
    weights = [math.exp(-0.5 * (o / per_bandwidth) ** 2) for o in range(-reach, reach + 1)]
    kernel = [F.struct(F.lit(o).alias("o"), F.lit(w / sum(weights)).alias("w")) for o, w in zip(range(-reach, reach + 1), weights, strict=True)]
    still = F.array(F.struct(F.lit(0).alias("o"), F.lit(1.0).alias("w")))
    for c in columns:
        spread = mass.select("*", F.inline(F.when(steps[c] > 0, F.array(*kernel)).otherwise(still)))
        spread = spread.withColumn(of[c], F.col(of[c]) + F.col("o"))
        mass = spread.groupBy(*of.values()).agg(F.sum(F.col("mass") * F.col("w")).alias("mass"))
    area = reduce(lambda a, b: a * b, [F.when(steps[c] > 0, steps[c]) for c in columns])
    centre = {c: F.when(steps[c] > 0, (F.col(of[c]) + 0.5) * steps[c]) for c in columns}
    return mass.select(
        *of.values(), *[x.alias(c) for c, x in centre.items()], "mass", (F.col("mass") / area).alias("density")
    )


#: P(Poisson(1) <= k) for k = 0, 1, ...: a uniform number's weight is how many of these it reaches.
POISSON = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(12)]


def bootstrap_bands(
    df: DataFrame,
    x: str,
    value: str = "demand",
    by: Sequence[str] = (),
    keys: Sequence[str] = KEYS,
    replicates: int = 100,
    level: float = 0.95,
    seed: int = 1,
) -> DataFrame:
    """Mean of ``value`` per ``x``, one line per level of ``by``, with a bootstrap interval: ``low``, ``high``.

    Each row weighs in each replicate as often as a Poisson number of mean 1 says, made of the md5 of
    its key, so one pass does all replicates, in any order and partitioning. Their sums are combined
    before the shuffle. Percentiles of the replicates' means are interpolated linearly; replicates
    that drew no row of a group are left out.
    """
    groups, y = [*by, x], F.col(value).cast("double")
    rows = df.filter(y.isNotNull()).select(
        *groups, y.alias("_y"), *[key_digest(keys, f"{seed}-{g}").alias(f"_h{g}") for g in range(-(-replicates // 4))]
    )

    def weight(r: int) -> Column:
        digits = F.conv(F.substring(f"_h{r // 4}", 8 * (r % 4) + 1, 8), 16, 10).cast("bigint")
        hits = [(digits >= math.ceil(p * 2**32)).cast("int") for p in POISSON]
        return reduce(lambda a, b: a + b, hits)

    rows = rows.select(*groups, "_y", *[weight(r).alias(f"_w{r}") for r in range(replicates)])
    sums = rows.groupBy(*groups).agg(
        F.avg("_y").alias("mean"),
        F.count("_y").alias("n"),
        *[F.try_divide(F.sum(F.col(f"_w{r}") * F.col("_y")), F.sum(f"_w{r}")).alias(f"_m{r}") for r in range(replicates)],
    )
    means = F.sort_array(F.array_compact(F.array(*[f"_m{r}" for r in range(replicates)])))
    sums = sums.select(*groups, "mean", "n", means.alias("_m"))

    def percentile(p: float) -> Column:
        at = F.lit(p) * (F.size("_m") - 1)
        low, past = F.floor(at).cast("int"), at - F.floor(at)
        first = F.get("_m", low)
        return first + (F.coalesce(F.get("_m", low + 1), first) - first) * past

    tail = (1 - level) / 2
    return sums.select(*groups, "mean", percentile(tail).alias("low"), percentile(1 - tail).alias("high"), "n")


def place_series(
    df: DataFrame,
    places: Sequence[str] | None = None,
    columns: Sequence[str] = ("demand", "y_hat"),
) -> DataFrame:
    """Each place's series: position ``x`` and the chosen columns.

    With ``places``, their filter comes first, so only those series are sorted.
    """
    if places is not None:
        df = df.filter(F.col("geohash6").isin(list(places)))
    return add_sequence(df).select("geohash6", "x", *columns)
