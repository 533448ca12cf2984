"""Shapes for the service and the map: items, colours, the peak zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline import schema
from hourline.functions import color_scale
from hourline.operators.joins import with_zone_names

RADIUS_FACTOR = 5


def response_items(predictions: DataFrame) -> DataFrame:
    """sub_region_code int, zone_name, predicted_demand_mw double, date as text."""
    return with_zone_names(predictions).select(
        F.col(schema.KEY).cast("int").alias(schema.KEY),
        "zone_name",
        F.col("predicted_demand").cast("double").alias("predicted_demand_mw"),
        F.date_format(schema.TIME, "yyyy-MM-dd HH:mm:ssXXX").alias("date"),
    )


def response(predictions: DataFrame) -> DataFrame:
    """One row: the number of predictions and their time span."""
    return predictions.agg(
        F.lit("success").alias("status"),
        F.max(schema.TIME).alias("prediction_time"),
        F.count(F.lit(1)).alias("record_count"),
    )


def map_points(predictions: DataFrame) -> DataFrame:
    """Name, position, radius and fill colour per prediction; the colour range is that of all predictions."""
    bounds = predictions.agg(F.struct(F.min("predicted_demand").alias("low"), F.max("predicted_demand").alias("high")).alias("b")).scalar()
    return (
        with_zone_names(predictions)
        .withColumn("_bounds", bounds)
        .withColumns(
            {
                "fill_color": color_scale(F.col("predicted_demand"), F.col("_bounds.low"), F.col("_bounds.high")),
                "radius": F.col("predicted_demand") * RADIUS_FACTOR,
            }
        )
        .drop("_bounds")
    )


def peak_zone(predictions: DataFrame) -> DataFrame:
    """The zone with the highest prediction, the lowest code on ties."""
    top = predictions.agg(
        F.max_by(F.struct(schema.KEY, "predicted_demand"), F.struct("predicted_demand", -F.col(schema.KEY))).alias("_top")
    )
    return with_zone_names(top.select("_top.*"))


def top_zones(predictions: DataFrame, n: int = 6) -> DataFrame:
    """The ``n`` highest predictions with whole megawatts."""
    best = predictions.orderBy(F.col("predicted_demand").desc(), F.col(schema.KEY)).limit(n)
    return best.withColumn("whole_mw", F.col("predicted_demand").cast("bigint"))


def health(spark, model_path: str):
    """One row: ``healthy`` when the model is there, ``degraded`` otherwise."""
    from hourline.sources import require_source

    try:
        require_source(spark, model_path, "Model")
        found = True
    except FileNotFoundError:
        found = False
    return spark.createDataFrame(
        [("healthy" if found else "degraded", found, model_path)], "status string, model_loaded boolean, model_path string"
    ).withColumn("timestamp", F.current_timestamp())
