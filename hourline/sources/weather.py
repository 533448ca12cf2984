"""Weather: columnar blocks, landed CSV, two overlapping providers and the current snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline import schema
from hourline.functions import from_epoch, json_number
from hourline.operators.clean import dedupe_first

MEASURES = ["temperature_2m", "weather_code", "relative_humidity_2m", "wind_speed_10m"]
ARCHIVE_DAYS = 85


def expand_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks (start, end, interval in epoch seconds, value arrays) to one row per step; ``end`` is excluded."""
    start, end, interval = F.col("start"), F.col("end"), F.col("interval")
    steps = F.when(end > start, F.sequence(start, end - 1, interval))
    rows = blocks.withColumn("_steps", steps).select(F.inline(F.arrays_zip("_steps", *MEASURES)))
    return rows.where(F.col("_steps").isNotNull()).select(from_epoch(F.col("_steps")).alias("date"), *MEASURES)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Weather blocks as the provider delivers them, one JSON document a line, as one row per step."""
    return expand_blocks(spark.read.schema(schema.WEATHER_BLOCK_DDL).json(path))


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.RAW_WEATHER_DDL).csv(path, header=True)


def combine_sources(archive: DataFrame, forecast: DataFrame, as_of: Column, archive_days: int = ARCHIVE_DAYS) -> DataFrame:
    """Archive up to the day of ``as_of − 85 d``, forecast from that day on; on a shared date the archive row stays."""
    cutoff = F.to_date(as_of - F.make_dt_interval(F.lit(archive_days)))
    past = archive.where(F.to_date("date") <= cutoff).withColumn("_rank", F.lit(0))
    rest = forecast.where(F.to_date("date") >= cutoff).withColumn("_rank", F.lit(1))
    both = past.unionByName(rest, allowMissingColumns=True)
    values = [F.col(c) for c in both.columns if c not in ("date", "_rank")]
    return dedupe_first(both, ["date"], [F.col("_rank"), *values]).drop("_rank")


def current_weather(documents: DataFrame, doc: str = "doc") -> DataFrame:
    """Four readings out of a JSON text ``{"current": {…}}``; a missing reading or document gives the default."""
    return documents.withColumns(
        {m: json_number(F.col(doc), f"$.current.{m}", default) for m, default in schema.WEATHER_DEFAULTS.items()}
    )
