import math
import shutil

import pytest
from pyspark.sql import functions as F

from hourline import jobs, plans, schema, sinks, sources
from tests.helpers import hours, values

N = 24 * 45


@pytest.fixture(scope="module")
def at(spark, tmp_path_factory):
    """45 days of two zones and their weather, landed as the sources deliver them."""
    root = jobs.Locations(str(tmp_path_factory.mktemp("root")))
    rows = [
        (t.date(), t.strftime("%Y-%m-%dT%H"), zone, str(round(1000 + 300 * k + 200 * math.sin(2 * math.pi * t.hour / 24))))
        for t in hours("2025-01-01", N)
        for k, zone in enumerate(("ZONA", "ZONJ"))
    ]
    sinks.write_landed_demand(spark.createDataFrame(rows, "day date, period string, subba string, value string"), root.demand)
    wx = [(t, 10.0 + t.hour / 10, 0.0, 50.0, 5.0) for t in hours("2025-01-01", N)]
    sinks.write_table(spark.createDataFrame(wx, schema.RAW_WEATHER_DDL), root.weather, "csv")
    return root


def test_jobs_end_to_end(spark, at):
    with pytest.raises(FileNotFoundError, match="Preprocessed data not found"):
        jobs.run_training(spark, at)
    with pytest.raises(FileNotFoundError, match="Model not found"):
        jobs.run_inference(spark, at)
    with pytest.raises(FileNotFoundError, match="Predictions not found"):
        jobs.run_monitoring(spark, at)

    features = jobs.run_features(spark, at)
    assert features.count() == 2 * N
    assert sources.read_document(spark, at.validation_status, schema.STATUS_DDL).first()[0] is True

    grids = {
        "XGBoost": {"n_estimators": [1, 3], "max_depth": [2], "learning_rate": [0.3]},
        "LightGBM": {"n_estimators": [1, 3], "num_leaves": [4], "learning_rate": [0.3]},
    }
    # A step of 5 reaches every hour of the day, so the holdout asks for nothing the training has not seen.
    out = jobs.run_training(
        spark, at, 28, 5, holdout_days=10, drift_days=(40, 10, 9), folds=2, grids=grids, season=7
    )
    assert out["params"]["n_estimators"] == 3 and out["metrics"]["n_samples"] > 0 and out["metrics"]["mape"] < 10
    runs = spark.read.parquet(at.runs)
    assert sorted(r["run"] for r in runs.collect()) == ["evaluation", "training", "tuning", "tuning"]
    logged = {r["step"]: r for r in runs.where("run = 'tuning'").collect()}
    assert {r["params"]["n_estimators"] for r in logged.values()} == {"3"}
    assert logged[out["model_name"]]["metrics"]["cv_best_rmse"] == pytest.approx(out["score"])
    assert sources.read_document(spark, at.drift_report).first()["number_of_columns"] > 0

    # Predictions of the hours before, then the day after they are compared with what came.
    for hour in ("2025-02-13 05:10:00", "2025-02-13 06:10:00"):
        predicted = jobs.run_inference(spark, at, F.lit(hour).cast("timestamp"))
    assert predicted.count() == 4
    assert jobs.run_inference(spark, at, F.lit("2025-02-13 06:10:00").cast("timestamp"), 28).count() == 4  # a repeated run
    with pytest.raises(ValueError, match="windows of 28 lags"):
        jobs.run_inference(spark, at, F.lit("2025-02-13 06:10:00").cast("timestamp"), 12)
    assert spark.read.parquet(at.prediction_rejects).count() == 0
    monitored = jobs.run_monitoring(spark, at, F.lit("2025-02-14 03:00:00").cast("timestamp"))
    assert monitored.count() == 4 and monitored.columns == ["sub_region_code", "predicted_demand", "date", "demand"]
    assert jobs.run_inference(spark, at, F.lit("2025-02-13 06:10:00").cast("timestamp"), 28, keep_history=False).count() == 2


def test_inference_windows_like_the_training(spark, at):
    jobs.run_features(spark, at)
    grids = {"XGBoost": {"n_estimators": [1], "max_depth": [1]}}
    options = {"covariates": ["hour"], "lag_mode": "time", "grain_seconds": 3600}
    jobs.run_training(spark, at, 28, 5, holdout_days=10, drift_days=(40, 10, 9), folds=2, grids=grids, season=7, **options)
    stored = sources.read_document(spark, at.model_options, schema.MODEL_OPTIONS_DDL).first().asDict()
    assert stored == options | {"seq_len": 28}
    predicted = jobs.run_inference(spark, at, F.lit("2025-02-13 05:10:00").cast("timestamp"), keep_history=False)
    assert predicted.count() == 2


def test_monitoring_from_stores(spark, at, tmp_path):
    """The stored tables and the plain ones give the same rows; a job that runs again leaves the same stores."""
    landed, at = at, jobs.Locations(str(tmp_path))
    shutil.copytree(landed.demand, at.demand)
    shutil.copytree(landed.weather, at.weather)
    for _ in range(2):
        jobs.run_features(spark, at, store=True)
    assert sinks.open_store(spark, at.feature_store).count() == 2 * N
    grids = {"XGBoost": {"n_estimators": [1], "max_depth": [1]}}
    jobs.run_training(spark, at, 28, 5, holdout_days=10, drift_days=(40, 10, 9), folds=2, grids=grids, season=7)
    for hour in ("2025-02-13 05:10:00", "2025-02-13 06:10:00", "2025-02-13 06:10:00"):
        jobs.run_inference(spark, at, F.lit(hour).cast("timestamp"))
    stored = sinks.open_store(spark, at.prediction_store)
    assert stored.count() == 4 and stored.columns == ["sub_region_code", "predicted_demand", "date", "day"]
    columns = ("sub_region_code", "date", "demand", "predicted_demand")
    got = values(jobs.run_monitoring(spark, at, F.lit("2025-02-14 03:00:00").cast("timestamp")), *columns)
    plain = plans.monitor(stored.drop("day"), sources.read_table(spark, at.features, schema.FEATURES_DDL), F.lit("2025-02-14 03:00:00").cast("timestamp"))
    assert len(got) == 4 and got == values(plain, *columns)


def test_landing_range(spark, at):
    assert sources.landed_demand(spark, at.demand, "2025-01-02", "2025-01-03").count() == 2 * 48
