"""What a table holds: its time range, its series, its size, and its rows in the order of the series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline import schema


def date_bounds(df: DataFrame, time: str = schema.TIME) -> DataFrame:
    """One row with the first and the last time; nulls where no row has a time."""
    return df.agg(F.min(time).alias("first"), F.max(time).alias("last"))


def distinct_keys(df: DataFrame, key: str = schema.KEY) -> DataFrame:
    """Every series once. A null key is one of them."""
    return df.select(key).distinct()


def table_profile(df: DataFrame, key: str = schema.KEY, time: str = schema.TIME, by: list[Column] | None = None) -> DataFrame:
    """Rows, columns, first and last time and the number of series, of the whole table or of each group of ``by``.

    Rows without a time or key count as rows only. The series are made distinct before they are counted, so no task
    holds more of them than its share.
    """
    by = by or []
    named = df.select(*[c.alias(f"_by{i}") for i, c in enumerate(by)], F.col(key).alias("_key"), F.col(time).alias("_time"))
    group = [f"_by{i}" for i in range(len(by))]
    # Two levels: one row per group and series, then one per group.
    per_key = named.groupBy(*group, "_key").agg(F.count("*").alias("n"), F.min("_time").alias("first"), F.max("_time").alias("last"))
    return per_key.groupBy(*group).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.count("_key").alias("n_zones"),
    )


def by_series(df: DataFrame, key: str = schema.KEY, time: str = schema.TIME) -> DataFrame:
    """The rows series by series in the order of time, nulls first. Spark sorts by range, over all tasks."""
    return df.orderBy(F.col(key).asc_nulls_first(), F.col(time).asc_nulls_first())
