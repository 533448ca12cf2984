"""The next hour of every zone."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline import schema
from hourline.functions import round_half_even
from hourline.operators.clean import as_of_range_or_tail, require_rows
from hourline.operators.learn import check_lags
from hourline.operators.windows import latest_windows
from hourline.session import stage


def prediction_inputs(
    features: DataFrame,
    as_of: Column,
    seq_len: int = schema.SEQ_LEN,
    lookback_days: int = 29,
    covariates: list[str] | None = None,
    **clock,
) -> tuple[DataFrame, DataFrame]:
    """Lag arrays that are long enough, and the zones whose history is too short.

    The scan is cut to the lookback range first, and at most ``seq_len`` rows per zone are shuffled. ``clock`` are the
    ``lag_mode`` and ``grain_seconds`` that the model was trained with.
    """
    hour = F.date_trunc("hour", as_of)
    recent = as_of_range_or_tail(features, hour, lookback_days, tail=seq_len)
    return vector_inputs(latest_windows(recent, seq_len, covariates=covariates, **clock), as_of, seq_len)


def vector_inputs(latest: DataFrame, as_of: Column, seq_len: int = schema.SEQ_LEN) -> tuple[DataFrame, DataFrame]:
    """The same from latest vectors, such as a stream keeps (``streaming.read_latest``), whatever their age."""
    renamed = latest.withColumnRenamed(schema.TIME, "feature_time")
    stamped = stage(renamed.withColumn(schema.TIME, F.date_trunc("hour", as_of)), "latest-windows")  # one row per zone, read twice
    return stamped.where(F.col("n_lags") >= seq_len), stamped.where(F.col("n_lags") < seq_len)


def predict_next(
    features: DataFrame,
    model: PipelineModel,
    as_of: Column,
    seq_len: int = schema.SEQ_LEN,
    lookback_days: int = 29,
    covariates: list[str] | None = None,
    grain: str = "1 hour",
    **clock,
) -> DataFrame:
    """(sub_region_code, predicted_demand, date) plus the hour the features are from and the hour they point at.

    ``date`` is the hour of ``as_of``; predictions are whole megawatts, halves to even.
    """
    check_lags(model, seq_len)
    ready, _ = prediction_inputs(features, as_of, seq_len, lookback_days, covariates, **clock)
    return score_inputs(ready, model, grain)


def score_inputs(ready: DataFrame, model: PipelineModel, grain: str = "1 hour") -> DataFrame:
    """Predictions from the first table of ``prediction_inputs``."""
    require_rows(ready, "No zone has enough history for a prediction")
    return model.transform(ready).select(
        schema.KEY,
        round_half_even(F.col("prediction")).alias("predicted_demand"),
        schema.TIME,
        "feature_time",
        (F.col("feature_time") + F.expr(f"INTERVAL {grain}")).alias("target_time"),
    )
