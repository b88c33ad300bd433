"""The batch jobs: forecast from a file, and score a forecaster on held-out days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tilecast.operators.completion import complete_ticks
from tilecast.operators.evaluation import join_actuals, mean_place_error, place_errors
from tilecast.operators.exploration import histogram, place_series
from tilecast.operators.selection import train_window
from tilecast.plans.forecasters import DemandForecaster
from tilecast.session import materialize
from tilecast.sources.demand import read_demand, write_predictions


def forecast_job(
    spark: SparkSession,
    path: str,
    ticks: int = 5,
    start_day: int = 1,
    n_days: int = 14,
    out: str | None = None,
    forecaster=None,
    out_format: str = "csv",
    in_format: str | None = None,
) -> DataFrame:
    """Read demand, keep the training days, complete the grid, fit, forecast and write."""
    # written once: a zip archive would be inflated for every pass over it
    observed = materialize(train_window(read_demand(spark, path, format=in_format), n_days, start_day), "observed")
    train = complete_ticks(observed)
    model = (forecaster or DemandForecaster()).fit(train)
    predictions = model.predict_futures(ticks)
    if out:
        write_predictions(predictions, out, out_format)
    return predictions


def evaluate(
    predictions: DataFrame, held_out: DataFrame, places: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Forecasts against held-out demand: the joined rows, errors per place, their distribution and
    mean, and the series of chosen places.

    The join is written out once; every table of the report starts from it.
    """
    joined = materialize(join_actuals(predictions, held_out), "judged")
    per_place = place_errors(joined)
    report = {
        "pred_vs_act": joined,
        "per_place": per_place,
        "rmse_histogram": histogram(per_place, "rmse"),
        "mape_histogram": histogram(per_place, "MAPE"),
        "mean": mean_place_error(per_place),
    }
    if places:
        report["series"] = place_series(joined, places)
    return report
