"""Live intake and monitoring with Structured Streaming."""

from hourline.streaming.intake import (
    batch_is_kept,
    drain,
    drop_duplicate_readings,
    enrich_stream,
    hourly_totals,
    keep_keyed,
    keyed_writer,
    match_predictions,
    read_stream,
    state_on_disk,
)
from hourline.streaming.latest import keep_latest, latest_vectors, latest_writer, read_latest, trim_recent

__all__ = [
    "batch_is_kept",
    "drain",
    "drop_duplicate_readings",
    "enrich_stream",
    "hourly_totals",
    "keep_keyed",
    "keep_latest",
    "keyed_writer",
    "latest_vectors",
    "latest_writer",
    "match_predictions",
    "read_latest",
    "read_stream",
    "state_on_disk",
    "trim_recent",
]
