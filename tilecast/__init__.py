"""Demand features and forecasts per place and tick, as Spark DataFrame operators."""

__version__ = "0.1.0"
