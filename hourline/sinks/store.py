"""A table stored by day and by buckets of its key, so that joins and groups on that key read rows that already lie together.

Files lie in ``day=…`` folders, one for each bucket of a day. Two stores with the same keys and number of buckets join
without a shuffle of either, and a range of days opens the files of those days alone. Buckets of (zone, time) are even
however many rows one zone holds; buckets of the zone alone also serve groups by zone, and suit many zones of like size.
Each day costs a folder and a catalog entry, so a store is for days of many rows.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hourline import schema
from hourline.operators.clean import dedupe_first
from hourline.session import stage

DAY = "day"
BUCKET_ROWS = 1_000_000
LAYOUT_DDL = "keys array<string>, time string, buckets int, columns string"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _layout(spark: SparkSession, path: str):
    try:
        return spark.read.schema(LAYOUT_DDL).json(f"{path}/layout").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _table(spark: SparkSession, path: str, layout) -> str:
    """The store as a table of this session's catalog, with the days that lie there now."""
    name = "hourline_" + hashlib.sha256(path.encode()).hexdigest()[:16]
    fields = StructType.fromJson(json.loads(layout["columns"]))
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    keys = ", ".join(map(_quoted, layout["keys"]))
    location = f"{path}/rows".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
        f"PARTITIONED BY ({DAY}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {layout['buckets']} BUCKETS LOCATION '{location}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def store_exists(spark: SparkSession, path: str) -> bool:
    return _layout(spark, path.rstrip("/")) is not None


def store_buckets(spark: SparkSession, path: str) -> int:
    """The number of buckets of a store, for another one that is to be joined to it."""
    return _layout(spark, path.rstrip("/"))["buckets"]


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a store and their ``day``."""
    path = path.rstrip("/")
    layout = _layout(spark, path)
    if layout is None:
        raise FileNotFoundError(f"No store at {path}")
    return spark.table(_table(spark, path, layout))


def write_store(
    df: DataFrame,
    path: str,
    keys: list[str] | None = None,
    time: str = schema.TIME,
    buckets: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Put rows into a store, replacing exactly the days that occur in ``df``, and read the store.

    The first call fixes keys and columns, and the buckets: as many as the largest day needs at ``bucket_rows`` rows
    each, a power of two. Later calls follow them. Rows without a time lie in a day of their own, repeated rows and null keys
    stay. The columns must be those of the first call, in any order; a column named ``day`` is refused.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if DAY in (c.lower() for c in df.columns):
        raise ValueError(f"A store adds its own column {DAY}")
    layout = _layout(spark, path)
    if layout is None:
        if buckets is None:
            df = stage(df, "store")
            largest = df.groupBy(F.to_date(time)).count().agg(F.max("count")).first()[0] or 0
            buckets = 1 << max(0, -(-largest // bucket_rows) - 1).bit_length()
        none = df.withColumn(DAY, F.to_date(time)).limit(0)
        none.write.mode("append").partitionBy(DAY).parquet(f"{path}/rows")
        row = (keys or [schema.KEY, time], time, buckets, none.schema.json())
        spark.createDataFrame([row], LAYOUT_DDL).coalesce(1).write.mode("overwrite").json(f"{path}/layout")
        layout = _layout(spark, path)
    name = _table(spark, path, layout)
    stored = spark.table(name).columns
    if sorted(stored) != sorted([*df.columns, DAY]):
        raise ValueError(f"The store has the columns {stored}, the rows {df.columns}")
    # One task for each day and bucket, so one file; small ones are put together by the adaptive plan.
    bucket = F.pmod(F.hash(*layout["keys"]), F.lit(layout["buckets"]))
    rows = df.withColumn(DAY, F.to_date(layout["time"])).select(*map(_quoted, stored))
    rows.repartition(F.col(DAY), bucket).write.mode("overwrite").insertInto(name)
    return open_store(spark, path)


def upsert_store(new: DataFrame, path: str, keys: list[str] | None = None, time: str = schema.TIME, **layout) -> DataFrame:
    """Merge rows into a store, the newer version of a key wins; only the days that occur in ``new`` are read and replaced."""
    spark = new.sparkSession
    keys = keys or [schema.KEY, time]
    incoming = new.withColumn("_age", F.lit(0))
    if store_exists(spark, path):
        # One row per day that changes.
        days = new.select(F.to_date(time).alias(DAY)).distinct()
        old = open_store(spark, path)
        touched = old.join(F.broadcast(days), old[DAY].eqNullSafe(days[DAY]), "left_semi").drop(DAY)
        incoming = incoming.unionByName(touched.withColumn("_age", F.lit(1)))
    rest = [F.col(_quoted(c)) for c in new.columns if c not in keys]
    merged = stage(dedupe_first(incoming, keys, [F.col("_age"), *rest]).drop("_age"), "store-merge")
    return write_store(merged, path, keys, time, **layout)
