"""Predictions against what happened, and drift of the features."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline import schema
from hourline.operators.drift import (
    column_summary,
    counts_report,
    daily_counts,
    dataset_drift,
    drift_document,
    drift_report,
    label_periods,
    period_counts,
    roll_counts,
)
from hourline.operators.joins import predictions_vs_actuals
from hourline.operators.metrics import regression_metrics
from hourline.operators.sketches import daily_sketches, period_sketches, sketched_summary
from hourline.session import stage
from hourline.sinks import write_daily


def monitor(predictions: DataFrame, features: DataFrame, as_of: Column, days: int = 1) -> DataFrame:
    """Predictions joined to actuals between the start of yesterday and the start of today, both ends included.

    Both sides are cut to the range before they are shuffled; two stores of the same buckets (``sinks.write_store``) are not
    shuffled at all, and only the days of the range are opened.
    """
    today = F.date_trunc("day", as_of)
    start = today - F.make_dt_interval(F.lit(days))
    in_range = F.col(schema.TIME).between(start, today)
    predictions, features = (
        side.where(F.col("day").between(F.to_date(start), F.to_date(today))) if "day" in side.columns else side
        for side in (predictions, features)
    )
    joined = predictions_vs_actuals(
        predictions.where(in_range).select(schema.KEY, "predicted_demand", schema.TIME), features.where(in_range)
    )
    return joined.select(schema.KEY, "predicted_demand", schema.TIME, schema.VALUE)


def monitoring_errors(monitored: DataFrame, by_zone: bool = True) -> DataFrame:
    """Our addition to the joined rows: the usual metrics, per zone or over all."""
    return regression_metrics(monitored, schema.VALUE, "predicted_demand", [schema.KEY] if by_zone else None)


def roll_drift(
    spark: SparkSession,
    fresh: DataFrame,
    columns: list[str],
    root: str,
    last: str,
    reference_days: int = 365,
    gap_days: int = 30,
    current_days: int = 29,
    tests: str = "distance",
) -> DataFrame:
    """The drift report of the periods that end with the day ``last``, from daily counts kept below ``root``.

    ``fresh`` are the feature rows of the days that are new or have changed since the last call; no other row is read. The
    period counts of the last call are moved on by the days between; a day that changed inside them is replaced, so the
    periods are then summed anew from the days. Days older than the periods reach are not kept, so ``last`` only moves on.
    """
    days, periods = f"{root}/days", f"{root}/periods"
    # The day before the oldest one is the last to leave.
    since = F.date_sub(F.lit(last).cast("date"), reference_days + 1)
    counted = stage(daily_counts(fresh.where(F.to_date(schema.TIME) >= since), columns), "fresh-days")
    known = _stored(spark, days)
    state = _stored(spark, periods)
    touched = known is not None and not known.select("day").join(F.broadcast(counted.select("day").distinct()), "day", "left_semi").isEmpty()
    write_daily(counted, days)
    daily = spark.read.parquet(days)
    span = {"reference_days": reference_days, "gap_days": gap_days, "current_days": current_days}
    if state is None or touched:
        counts = period_counts(daily, last, **span)
    else:
        before = str(state.agg(F.max("last")).first()[0])
        own = stage(state.where(F.col("last") == F.lit(before).cast("date")).select("column", "x", "n_ref", "n_cur"), "periods-before")
        counts = roll_counts(own, daily, before, last, **span)
    counts = stage(counts, "periods")
    write_daily(counts.withColumn("last", F.lit(last).cast("date")), periods, "last")
    return counts_report(counts, tests=tests)


def roll_summary(
    spark: SparkSession,
    fresh: DataFrame,
    columns: list[str],
    root: str,
    last: str,
    time: str = schema.TIME,
    reference_days: int = 365,
    gap_days: int = 30,
    current_days: int = 29,
) -> DataFrame:
    """Column summaries of the periods that end with the day ``last``, from sketches of days kept below ``root``.

    ``fresh`` are the whole days that are new or have changed since the last call; no other row is read. A day is one row
    per column, so days lie in folders by month, and the months that change are written anew.
    """
    path = f"{root}/sketches"
    rows = stage(daily_sketches(fresh, columns, time).withColumn("month", F.trunc("day", "month")), "fresh-sketches")
    known = _stored(spark, path)
    if known is not None:
        # One row per month and per day that changes.
        months, days = (F.broadcast(rows.select(c).distinct()) for c in ("month", "day"))
        rows = stage(rows.unionByName(known.join(months, "month", "left_semi").join(days, "day", "left_anti")), "changed-months")
    write_daily(rows, path, "month")
    return sketched_summary(period_sketches(spark.read.parquet(path), last, reference_days, gap_days, current_days))


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def detect_drift(
    features: DataFrame, reference_days: int = 365, gap_days: int = 30, current_days: int = 29, tests: str = "distance"
) -> tuple[bool, DataFrame, DataFrame]:
    """The verdict, the per-column report and the document for the JSON sink."""
    labelled = label_periods(features, schema.TIME, reference_days, gap_days, current_days)
    labelled = labelled.drop("date_str", schema.TIME)
    report = stage(drift_report(labelled, tests=tests), "drift-report")
    document = drift_document(report, column_summary(labelled, schema.VALUE))
    return bool(dataset_drift(report).first()["dataset_drift"]), report, document
