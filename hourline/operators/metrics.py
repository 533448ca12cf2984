"""Regression metrics as one aggregate, grouped or not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from hourline import schema

# Fixed value: the spacing of doubles at 1, the smallest divisor in the percentage error.
EPS = 2.220446049250313e-16


def regression_metrics(
    df: DataFrame,
    actual: str,
    predicted: str,
    by: list[str] | None = None,
    baseline_mape: float = schema.BASELINE_MAPE,
) -> DataFrame:
    """MSE, MAE, MAPE in percent, RMSE, R², and the improvement over the baseline's MAPE.

    R² of a constant actual is 1 for exact predictions and 0 otherwise. ``n_samples`` counts the pairs used; pairs with a
    null on one side take part in nothing.
    """
    return _metrics(df.groupBy(*(by or [])), by or [], actual, predicted, baseline_mape)


def regression_cube(df: DataFrame, actual: str, predicted: str, by: list[str], baseline_mape: float = schema.BASELINE_MAPE) -> DataFrame:
    """The same metrics for every combination of ``by``, for each of them alone and over all, in one pass.

    ``grouping_id`` has a bit for each column, the first one highest, that is set where a row is over all its values; the
    column is null there, and null too where the value itself is.
    """
    return _metrics(df.cube(*by), by, actual, predicted, baseline_mape, [F.grouping_id(*by).alias("grouping_id")])


def _metrics(grouped: GroupedData, by: list[str], actual: str, predicted: str, baseline_mape: float, more: list[Column] = ()) -> DataFrame:
    p = F.col(predicted).cast("double")
    y = F.when(p.isNotNull(), F.col(actual).cast("double"))
    error = y - p
    sums = grouped.agg(
        *more,
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(EPS))) * 100).alias("mape"),
        F.sum(error * error).alias("_residual"),
        (F.var_pop(y) * F.count(y)).alias("_total"),
        F.count(error).alias("n_samples"),
    )
    r2 = (
        F.when(F.col("_total") != 0, 1 - F.col("_residual") / F.col("_total"))
        .when(F.col("_residual") == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    base = F.lit(float(baseline_mape))
    return sums.select(
        *by,
        *["grouping_id" for _ in more],
        "mse",
        "mae",
        "mape",
        F.sqrt("mse").alias("rmse"),
        r2.alias("r2_score"),
        base.alias("baseline_mape"),
        ((base - F.col("mape")) / base * 100).alias("forecast_improvement_percent"),
        "n_samples",
    )
