"""Model selection on the past, evaluation on the last 90 days."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from hourline import schema
from hourline.operators.clean import holdout_split, require_columns, require_rows
from hourline.operators.learn import check_lags, grid_search, trainable
from hourline.operators.metrics import regression_metrics
from hourline.operators.windows import check_parameters, check_seq_len, expanding_folds, lag_windows
from hourline.session import stage


def _windows(part: DataFrame, seq_len: int, step: int, options: dict) -> DataFrame:
    return require_rows(
        stage(lag_windows(part, seq_len, step, **options), "windows"), schema.NO_WINDOWS
    )


def train(
    features: DataFrame,
    seq_len: int = schema.SEQ_LEN,
    step: int = schema.STEP_SIZE,
    folds: int = schema.CV_FOLDS,
    fold_order: str = "time",
    grids: dict | None = None,
    season: int = schema.SEASON,
    holdout_days: int = 90,
    parallelism: int = 4,
    **window_options,
) -> tuple[PipelineModel, DataFrame, dict]:
    """Split, window, search, refit. ``fold_order="concat"`` walks the folds zone after zone instead of through time."""
    check_parameters(seq_len, folds)
    check_seq_len(seq_len, season)
    covariates = window_options.get("covariates")
    require_columns(features, ["date", "demand", "sub_region_code", *(schema.COVARIATES if covariates is None else covariates)])
    require_rows(features, "There are no features to work on")
    train_part, test_part = holdout_split(features, holdout_days)
    message = "The holdout cut leaves one side without rows"
    require_rows(test_part, message)
    windows = _windows(require_rows(train_part, message), seq_len, step, window_options)
    folded = expanding_folds(trainable(windows, covariates), folds, fold_order)
    return grid_search(folded, grids, season, covariates, parallelism)


def evaluate(
    features: DataFrame,
    model: PipelineModel,
    seq_len: int = schema.SEQ_LEN,
    step: int = schema.STEP_SIZE,
    holdout_days: int = 90,
    baseline_mape: float = schema.BASELINE_MAPE,
    warmup: bool = False,
    **window_options,
) -> DataFrame:
    """Score the windows that lie in the holdout and return the metrics row.

    The first ``seq_len`` rows of the holdout only serve as lags. With ``warmup=True`` the lags may reach back into the
    training part, so every holdout row is a target.
    """
    require_rows(features, "There are no features to work on")
    _, test_part = holdout_split(features, holdout_days)
    require_rows(test_part, "The holdout has no rows")
    source = features if warmup else test_part
    windows = lag_windows(source, seq_len, step, **window_options)
    if warmup:
        windows = windows.join(test_part.select(schema.KEY, schema.TIME), [schema.KEY, schema.TIME], "left_semi")
    windows = require_rows(stage(windows, "holdout"), schema.NO_WINDOWS)
    check_lags(model, seq_len)
    return regression_metrics(model.transform(windows), schema.TARGET, "prediction", baseline_mape=baseline_mape)
