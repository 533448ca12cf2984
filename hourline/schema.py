"""Declared schemas, the zone dimension and the default parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEY, TIME, VALUE = "sub_region_code", "date", "demand"
TARGET = "target_demand_next_hour"
COVARIATES = ["temperature_2m", "hour", "day_of_week", "month", "is_weekend", "is_holiday"]

SEQ_LEN = 672
STEP_SIZE = 1
CV_FOLDS = 3
SEASON = 168
BASELINE_MAPE = 10.0


RAW_DEMAND_DDL = "period string, subba string, value string, parent string"
ENVELOPE_DDL = "response struct<data: array<struct<period: string, subba: string, value: string, parent: string>>>"
RAW_WEATHER_DDL = (
    "date timestamp, temperature_2m double, weather_code double, relative_humidity_2m double, wind_speed_10m double"
)
WEATHER_BLOCK_DDL = (
    "start long, `end` long, interval long, temperature_2m array<double>, weather_code array<double>, "
    "relative_humidity_2m array<double>, wind_speed_10m array<double>"
)
FEATURES_DDL = (
    "date_str string, date timestamp, sub_region_code bigint, demand double, temperature_2m double, "
    "hour bigint, day_of_week bigint, month bigint, is_weekend bigint, is_holiday bigint"
)
PREDICTIONS_DDL = "sub_region_code bigint, predicted_demand double, date timestamp"
MONITORING_DDL = "sub_region_code bigint, predicted_demand double, date timestamp, demand double"
METRICS_DDL = (
    "mse double, mae double, mape double, rmse double, r2_score double, baseline_mape double, "
    "forecast_improvement_percent double, n_samples bigint"
)
STATUS_DDL = "validation_status boolean"
RUNS_DDL = "run string, step string, params map<string,string>, metrics map<string,double>, logged_at timestamp, run_id string"

FEATURE_COLUMNS = ["date", "demand", "sub_region_code", *COVARIATES]

# Beginnings and words of messages that callers match on.
NO_WINDOWS = "No valid time-series sequences"
NO_COLUMNS = "missing required columns"
TOO_SHORT = "input_seq_len must be >="
MODEL_TYPE = "model_type must be"
TOO_FEW_FOLDS = "cv_folds must be >= 2"

# Zone index, zone code, display name, latitude, longitude.
ZONES = [
    (0, "ZONA", "West", 42.8864, -78.8784),
    (1, "ZONB", "Genesee", 43.1610, -77.6109),
    (2, "ZONC", "Central", 43.0481, -76.1474),
    (3, "ZOND", "North", 44.6995, -73.4525),
    (4, "ZONE", "Mohawk Valley", 43.1009, -75.2327),
    (5, "ZONF", "Capital", 42.6526, -73.7562),
    (6, "ZONG", "Hudson Valley", 41.7004, -73.9210),
    (7, "ZONH", "Millwood", 41.2048, -73.8293),
    (8, "ZONI", "Dunwoodie", 40.9142, -73.8557),
    (9, "ZONJ", "New York City", 40.7128, -74.0060),
    (10, "ZONK", "Long Island", 40.7891, -73.1350),
]
# Where a code has no zone, and what stands in for a missing weather reading.
DEFAULT_LAT, DEFAULT_LON = 42.0, -75.0
WEATHER_DEFAULTS = {
    "temperature_2m": 10.0,
    "relative_humidity_2m": 50.0,
    "weather_code": 0.0,
    "wind_speed_10m": 5.0,
}


def zones(spark: SparkSession) -> DataFrame:
    """The zone dimension: 11 rows, so it is always safe to broadcast."""
    return spark.createDataFrame(
        ZONES, "sub_region_code bigint, subba string, zone_name string, latitude double, longitude double"
    )

# How the windows of a stored model were cut; null fields stand for the defaults.
MODEL_OPTIONS_DDL = "covariates array<string>, lag_mode string, grain_seconds long, seq_len int"
