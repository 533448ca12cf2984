"""Raw demand and weather to the validated feature table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline import schema
from hourline.functions import calendar_columns, parse_utc, to_number
from hourline.operators.clean import date_strings, dedupe_first, label_encode, normalize_names, split_rejects
from hourline.operators.joins import enrich_with_weather, zone_code
from hourline.operators.quality import quality_report, require_valid, validation_status


@dataclass
class FeatureBuild:
    processed: DataFrame
    features: DataFrame
    report: DataFrame
    status: DataFrame
    rejects: DataFrame


def merge_demand_weather(raw: DataFrame, weather: DataFrame, dedupe: bool = True) -> DataFrame:
    """Parse, optionally de-duplicate, join on the hour, normalise the names and add ``date_str``.

    Days that share their boundary hour deliver it twice; ``dedupe=False`` keeps both copies.
    """
    demand = raw.withColumn("date", parse_utc(F.col("period")))
    if dedupe:
        rest = [F.col(c) for c in raw.columns if c not in ("subba", "period")]
        demand = dedupe_first(demand, ["date", "subba"], [*rest, F.col("period")])
    merged = enrich_with_weather(demand.where(F.col("date").isNotNull()), weather)
    return date_strings(normalize_names(merged))


def feature_table(processed: DataFrame, encoder: str = "static", holiday_mode: str = "midnight") -> DataFrame:
    """Zone code, demand and temperature as numbers, and the calendar columns.

    ``encoder="static"`` uses the fixed zone index, ``"labels"`` numbers the zones that occur.
    """
    if encoder == "static":
        coded = processed.withColumn("sub_region_code", zone_code(F.col("subba")))
    elif encoder == "labels":
        coded = label_encode(processed, "subba", "sub_region_code")
    else:
        raise ValueError("encoder must be 'static' or 'labels'")
    numbers = coded.select(
        "date_str",
        "date",
        "sub_region_code",
        to_number(F.col("value").cast("string")).alias("demand"),
        F.col("temperature_2m").cast("double").alias("temperature_2m"),
    )
    return calendar_columns(numbers, "date", holiday_mode)


def build_features(
    raw: DataFrame,
    weather: DataFrame,
    dedupe: bool = True,
    encoder: str = "static",
    holiday_mode: str = "midnight",
    expected: dict[str, str] | None = None,
    valid_only: bool = False,
) -> FeatureBuild:
    """The whole feature build, lazily. ``valid_only=True`` stops when a check fails; the default only reports it."""
    processed = merge_demand_weather(raw, weather, dedupe)
    report = quality_report(processed, expected)
    status = validation_status(report)
    if valid_only:
        require_valid(processed, status)
    features, rejects = split_rejects(feature_table(processed, encoder, holiday_mode), [schema.KEY, schema.TIME])
    return FeatureBuild(processed, features, report, status, rejects)


def feature_view(features: DataFrame, name: str = "features") -> DataFrame:
    """The nine training columns as a view that SQL can query by ``name``."""
    view = features.select("date", "sub_region_code", "demand", *schema.COVARIATES)
    view.createOrReplaceTempView(name)
    return view
