"""Scaling a target column and back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.operators.percentiles import exact_percentiles


@dataclass(frozen=True)
class Scaler:
    """``(x - centre) / scale``; a scale of 0 counts as 1."""

    centre: float
    scale: float

    def apply(self, x: Column) -> Column:
        return (x - self.centre) / (self.scale or 1.0)

    def invert(self, x: Column) -> Column:
        return x * (self.scale or 1.0) + self.centre


def fit_standard_scaler(df: DataFrame, column: str) -> Scaler:
    """Mean and population standard deviation."""
    row = df.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s")).first()
    return Scaler(row["m"], row["s"])


def fit_robust_scaler(df: DataFrame, column: str) -> Scaler:
    """Median and interquartile range."""
    low, mid, high = exact_percentiles(df, [], column, [0.25, 0.5, 0.75]).first()["percentiles"]
    return Scaler(mid, high - low)
