"""Scans of landed demand, weather and stored tables."""

from hourline.sources.demand import (
    day_spine,
    days_to_read,
    landed_days,
    landed_demand,
    landed_documents,
    landed_files,
    read_envelopes,
    refresh_plan,
    request_filter,
    unwrap,
)
from hourline.sources.tables import read_document, read_table, require_source
from hourline.sources.weather import combine_sources, current_weather, expand_blocks, read_blocks, read_weather_csv

__all__ = [
    "combine_sources",
    "current_weather",
    "day_spine",
    "days_to_read",
    "expand_blocks",
    "landed_days",
    "landed_demand",
    "landed_documents",
    "landed_files",
    "read_blocks",
    "read_document",
    "read_envelopes",
    "read_table",
    "read_weather_csv",
    "refresh_plan",
    "request_filter",
    "require_source",
    "unwrap",
]
