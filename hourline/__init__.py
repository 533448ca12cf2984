"""Hourly-series analytics on Spark: cleaning, quality, lag windows, drift, forecasting and monitoring."""

__version__ = "0.1.0"
