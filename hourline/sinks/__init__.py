"""Writers; every one of them can be repeated without leaving duplicates behind."""

from hourline.sinks.store import open_store, store_buckets, store_exists, upsert_store, write_store
from hourline.sinks.tables import (
    keep_predictions,
    log_runs,
    append_runs,
    refresh_landed,
    run_row,
    upsert_keyed,
    write_daily,
    write_document,
    write_features,
    write_landed_demand,
    write_table,
)

__all__ = [
    "keep_predictions",
    "log_runs",
    "open_store",
    "store_buckets",
    "store_exists",
    "upsert_store",
    "write_store",
    "append_runs",
    "refresh_landed",
    "run_row",
    "upsert_keyed",
    "write_daily",
    "write_document",
    "write_features",
    "write_landed_demand",
    "write_table",
]
