"""The runs as jobs over stored tables: ``python -m hourline.jobs features|intake|training|inference|monitoring --root PATH``.

Every job reads its inputs from and writes its results to fixed places below one root folder, so each can run on its
own, and can run again.
"""

from __future__ import annotations

import argparse
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourline import plans, schema, sinks, sources, streaming
from hourline.functions import parse_utc
from hourline.operators.clean import require_rows, split_rejects
from hourline.operators.learn import best_per_family, check_lags, lags_of, load_model, save_model
from hourline.operators.quality import quality_report, require_valid, validation_status
from hourline.session import configure, stage, use_utc

WINDOW_OPTIONS = ("covariates", "lag_mode", "grain_seconds", "bucket_seconds")


@dataclass(frozen=True)
class Locations:
    """Where everything lies below ``root``."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


def run_features(
    spark: SparkSession,
    at: Locations,
    start: str | None = None,
    end: str | None = None,
    dedupe: bool = True,
    encoder: str = "static",
    holiday_mode: str = "midnight",
    expected: dict[str, str] | None = None,
    valid_only: bool = False,
    as_of: Column | None = None,
    store: bool = False,
) -> DataFrame:
    """``demand`` (landed envelopes by day) and ``weather`` → ``processed``, ``validation_status``, ``features``, ``rejects``
    and ``bad_documents``, the landed documents that could not be read.

    Weather is a CSV, or the blocks of two providers, ``weather_archive`` and ``weather_forecast``, where those are there.
    Where there is a source of envelopes, ``arrivals``, the days of the range that have not landed or are not settled at
    ``as_of`` are landed from it first. With ``store`` the days built are also put into ``feature_store``, by zone and time,
    where they replace what lay there; days not built stay.
    """
    use_utc(spark)
    as_of = F.current_timestamp() if as_of is None else as_of
    if _exists(spark, at.arrivals):
        refresh_demand(spark, at, start, end, as_of)
    sources.require_source(spark, at.demand, "Demand")
    raw, broken = sources.landed_documents(spark, at.demand, start, end)
    sinks.write_table(broken.select("day", "file", F.col("_corrupt_record").alias("document")), at.bad_documents)
    weather = stored_weather(spark, at, as_of)
    merged = stage(plans.merge_demand_weather(raw, weather, dedupe), "merged")
    sinks.write_table(require_rows(merged, "Nothing landed in the range; the tables stay as they are"), at.processed)
    processed = spark.read.parquet(at.processed)
    sinks.write_document(validation_status(quality_report(processed, expected)), at.validation_status)
    if valid_only:
        require_valid(processed, sources.read_document(spark, at.validation_status, schema.STATUS_DDL))
    good, bad = split_rejects(plans.feature_table(processed, encoder, holiday_mode), [schema.KEY, schema.TIME])
    sinks.write_features(good, at.features)
    sinks.write_table(bad, at.rejects)
    if store:
        sinks.write_store(sources.read_table(spark, at.features, schema.FEATURES_DDL), at.feature_store)
    return sources.read_table(spark, at.features, schema.FEATURES_DDL)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        sources.require_source(spark, path, "Source")
    except FileNotFoundError:
        return False
    return True


def refresh_demand(spark: SparkSession, at: Locations, start: str | None, end: str | None, as_of: Column) -> DataFrame:
    """``arrivals`` (envelopes by day, as the source serves them) → ``demand`` and ``landed_days``, its ledger.

    Without a range it goes over the year up to ``as_of``. Returns what was done with each day.
    """
    today = F.to_date(as_of)
    ends = spark.range(1).select(F.date_sub(today, 365).cast("string").alias("a"), today.cast("string").alias("b")).first()
    spine = sources.day_spine(spark, start or ends["a"], end or ends["b"])
    days = sources.days_to_read(spine, sources.landed_days(spark, at.landed_days), as_of)
    arrived = sources.landed_demand(spark, at.arrivals, start or ends["a"], end or ends["b"])
    return sinks.refresh_landed(arrived, at.demand, at.landed_days, days, as_of)


def stored_weather(spark: SparkSession, at: Locations, as_of: Column) -> DataFrame:
    """Archive and forecast blocks put together, one of them if the other is not there, or the CSV without either."""
    past, coming = _exists(spark, at.weather_archive), _exists(spark, at.weather_forecast)
    if past and coming:
        return sources.combine_sources(sources.read_blocks(spark, at.weather_archive), sources.read_blocks(spark, at.weather_forecast), as_of)
    if past or coming:
        return sources.read_blocks(spark, at.weather_archive if past else at.weather_forecast)
    sources.require_source(spark, at.weather, "Weather")
    return sources.read_weather_csv(spark, at.weather)


def run_intake(spark: SparkSession, at: Locations) -> DataFrame:
    """``incoming`` (a growing folder of envelopes) → ``readings``, one row per zone and hour, the version that came last.

    Goes on where the last call ended; ``intake_state`` holds Spark's checkpoint and the ledger of batches.
    """
    use_utc(spark)
    documents = streaming.read_stream(spark, at.incoming, schema.ENVELOPE_DDL, "json")
    readings = sources.unwrap(documents)[0].withColumn(schema.TIME, parse_utc(F.col("period"))).where(F.col(schema.TIME).isNotNull())
    return streaming.keep_keyed(readings, at.readings, at.intake_state, ["subba", schema.TIME])


def stored_features(spark: SparkSession, at: Locations) -> DataFrame:
    return sources.read_table(spark, at.features, schema.FEATURES_DDL, what="Preprocessed data")


def run_training(
    spark: SparkSession,
    at: Locations,
    seq_len: int = schema.SEQ_LEN,
    step: int = schema.STEP_SIZE,
    holdout_days: int = 90,
    drift_days: tuple[int, int, int] = (365, 30, 29),
    run_id: str | None = None,
    **search,
) -> dict:
    """``features`` → ``model``, ``model_options``, ``metrics``, ``runs``, ``drift_report``; returns the winner and the drift verdict.

    A job that is started again after a failure with the ``run_id`` it had replaces its rows of ``runs``; without one every
    call is a run of its own.
    """
    run_id = run_id or uuid.uuid4().hex
    use_utc(spark)
    features = stored_features(spark, at)
    model, scores, best = plans.train(features, seq_len, step, holdout_days=holdout_days, **search)
    save_model(model, at.model)
    windowing = {k: v for k, v in search.items() if k in WINDOW_OPTIONS}
    options = (windowing.get("covariates"), windowing.get("lag_mode"), windowing.get("grain_seconds"), seq_len)
    sinks.write_document(spark.createDataFrame([options], schema.MODEL_OPTIONS_DDL), at.model_options)
    sinks.log_runs(
        best_per_family(scores).select(
            F.lit("tuning").alias("run"),
            F.col("family").alias("step"),
            F.from_json("params", "map<string,string>").alias("params"),
            F.create_map(F.lit("cv_best_rmse"), F.col("cv_best_rmse")).alias("metrics"),
            F.current_timestamp().alias("logged_at"),
        ),
        at.runs,
        run_id,
    )
    now = F.current_timestamp()
    sinks.log_runs(
        sinks.run_row(spark, "training", best["model_name"], best["params"], {"best_cv_rmse": best["score"]}, now), at.runs, run_id
    )
    # The holdout is windowed as the training was.
    metrics = plans.evaluate(features, model, seq_len, step, holdout_days, **windowing)
    sinks.write_document(metrics, at.metrics)
    row = sources.read_document(spark, at.metrics, schema.METRICS_DDL).first().asDict()
    logged = {f"val_{k}": row[k] for k in ("mse", "mae", "mape", "rmse", "r2_score")}
    logged["forecast_improvement_percent"] = row["forecast_improvement_percent"]
    sinks.log_runs(sinks.run_row(spark, "evaluation", best["model_name"], {}, logged, now), at.runs, run_id)
    drifted, _, document = plans.detect_drift(features, *drift_days)
    sinks.write_document(document, at.drift_report)
    return {**best, "metrics": row, "drift_detected": drifted}


def run_inference(
    spark: SparkSession, at: Locations, as_of: Column | None = None, seq_len: int | None = None, keep_history: bool = True
) -> DataFrame:
    """``features``, ``model`` and the window options stored with it → ``predictions``, kept by key and day or, without history, overwritten, and
    ``prediction_rejects``, the zones whose history is too short. Where there is a ``feature_store``, the predictions are also kept in
    ``prediction_store``, in as many buckets.

    Windows have the length the model was trained on; a ``seq_len`` that differs from it is refused."""
    use_utc(spark)
    sources.require_source(spark, at.model, "Model")
    features = stored_features(spark, at)
    as_of = F.current_timestamp() if as_of is None else as_of
    stored = sources.read_document(spark, at.model_options, schema.MODEL_OPTIONS_DDL, "Window options of the model").first()
    options = {k: v for k, v in stored.asDict().items() if v is not None}
    model = load_model(at.model)
    trained = options.pop("seq_len", None) or lags_of(model)
    check_lags(model, trained if seq_len is None else seq_len)
    ready, short = plans.prediction_inputs(features, as_of, trained, **options)
    sinks.write_table(short.select(schema.KEY, schema.TIME, "feature_time", "n_lags"), at.prediction_rejects)
    predicted = plans.score_inputs(ready, model, f"{options.get('grain_seconds', 3600)} seconds")
    if keep_history:
        sinks.keep_predictions(predicted, at.predictions)
    else:
        sinks.write_table(predicted, at.predictions)
    if keep_history and sinks.store_exists(spark, at.feature_store):
        made = predicted.select(*StructType.fromDDL(schema.PREDICTIONS_DDL).names)
        sinks.upsert_store(made, at.prediction_store, buckets=sinks.store_buckets(spark, at.feature_store))
    return sources.read_table(spark, at.predictions, schema.PREDICTIONS_DDL)


def run_monitoring(spark: SparkSession, at: Locations, as_of: Column | None = None, days: int = 1) -> DataFrame:
    """``predictions`` and ``features`` → ``monitoring``; from ``prediction_store`` and ``feature_store`` where both are there."""
    use_utc(spark)
    if sinks.store_exists(spark, at.prediction_store) and sinks.store_exists(spark, at.feature_store):
        predictions, features = sinks.open_store(spark, at.prediction_store), sinks.open_store(spark, at.feature_store)
    else:
        predictions = sources.read_table(spark, at.predictions, schema.PREDICTIONS_DDL, what="Predictions")
        features = sources.read_table(spark, at.features, schema.FEATURES_DDL, what="Actuals")
    joined = plans.monitor(predictions, features, F.current_timestamp() if as_of is None else as_of, days)
    sinks.write_table(joined.orderBy(schema.KEY, schema.TIME), at.monitoring)
    return sources.read_table(spark, at.monitoring, schema.MONITORING_DDL)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["features", "intake", "training", "inference", "monitoring"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--as-of", help="UTC time that stands for now")
    parser.add_argument("--start", help="first landing day")
    parser.add_argument("--end", help="last landing day")
    args = parser.parse_args()
    spark = configure(SparkSession.builder.appName(f"hourline-{args.job}")).getOrCreate()
    at = Locations(args.root)
    as_of = F.lit(args.as_of).cast("timestamp") if args.as_of else None
    if args.job == "features":
        run_features(spark, at, args.start, args.end, as_of=as_of)
    elif args.job == "intake":
        run_intake(spark, at)
    elif args.job == "training":
        print(run_training(spark, at))
    elif args.job == "inference":
        run_inference(spark, at, as_of)
    else:
        run_monitoring(spark, at, as_of)


if __name__ == "__main__":
    main()
