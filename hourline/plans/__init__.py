"""The four runs a user starts: feature build, training and evaluation, next-hour prediction, monitoring."""

from hourline.plans.features import build_features, feature_table, feature_view, merge_demand_weather
from hourline.plans.inference import predict_next, prediction_inputs, score_inputs, vector_inputs
from hourline.plans.monitoring import detect_drift, monitor, monitoring_errors, roll_drift, roll_summary
from hourline.plans.training import evaluate, train

__all__ = [
    "build_features",
    "detect_drift",
    "evaluate",
    "feature_table",
    "feature_view",
    "merge_demand_weather",
    "monitor",
    "monitoring_errors",
    "predict_next",
    "prediction_inputs",
    "roll_drift",
    "roll_summary",
    "score_inputs",
    "train",
    "vector_inputs",
]
