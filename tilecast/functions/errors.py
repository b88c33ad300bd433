"""Error formulas as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mape(y: Column, y_hat: Column, inf_on_zero: bool = False) -> Column:
    """Mean of |error| / y in percent.

    A row with y = 0 has no ratio and is skipped. With ``inf_on_zero`` it counts as infinite, and
    only 0/0 is skipped.
    """
    ratio = F.try_divide(F.abs(y - y_hat), y)
    if inf_on_zero:
        ratio = F.when((y == 0) & (y_hat != 0), F.lit(float("inf"))).otherwise(ratio)
    return F.avg(ratio) * 100


def mape1(y: Column, y_hat: Column) -> Column:
    """Mean of (|error| + 1) / (y + 1) in percent."""
    return F.avg(F.try_divide(F.abs(y - y_hat) + 1, y + 1)) * 100


def rmse(y: Column, y_hat: Column) -> Column:
    return F.sqrt(F.avg(F.pow(y - y_hat, F.lit(2.0))))


def mae(y: Column, y_hat: Column) -> Column:
    return F.avg(F.abs(y - y_hat))


def r2(y: Column, y_hat: Column) -> Column:
    """1 - residual sum of squares / total sum of squares."""
    residual = F.avg(F.pow(y - y_hat, F.lit(2.0)))
    return 1 - F.try_divide(residual, F.var_pop(y))


def explained_variance(y: Column, y_hat: Column) -> Column:
    """1 - variance of the error / variance of y."""
    return 1 - F.try_divide(F.var_pop(y - y_hat), F.var_pop(y))


def place_mape(mse: Column, y_true: Column) -> Column:
    """The per-place score ((mse + 1) / (mean y + 1) - 1) in percent; not the usual MAPE."""
    return (F.try_divide(mse + 1, y_true + 1) - 1) * 100
