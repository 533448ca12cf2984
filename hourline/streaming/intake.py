"""Streaming twins of intake, enrichment and monitoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline import schema
from hourline.functions import exact_sum
from hourline.operators.joins import lookup_join
from hourline.session import scratch_path, stage
from hourline.sinks import upsert_keyed

LATE = "2 days"
SPREAD = 16
#: Bundles of rows for a stream join: shares of one time, rows of a bundle, bytes that a task gathers before it makes bundles.
SHARES, BUNDLE, GATHERED = 16, 1024, 64 << 20
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LEDGER_DDL = "name string, batch long, rows long, days long, written_at timestamp"


def read_stream(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet", glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(ddl).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def drop_duplicate_readings(
    readings: DataFrame, key: str = schema.KEY, time: str = schema.TIME, late: str = LATE, spread: int = SPREAD
) -> DataFrame:
    """One reading per (key, time), for repeats that arrive within ``late``.

    Repeats are first dropped within ``spread`` shares of the input partitions, so that many copies of one reading do
    not all meet in one task; what is left, at most ``spread`` rows per key, is then made unique. The second step alone
    decides what is kept, whichever share a copy fell into.
    """
    share = F.pmod(F.spark_partition_id(), F.lit(spread))
    marked = readings.withWatermark(time, late).withColumn("_share", share)
    return (
        marked.dropDuplicatesWithinWatermark([key, time, "_share"])
        .dropDuplicatesWithinWatermark([key, time])
        .drop("_share")
    )


def enrich_stream(readings: DataFrame, weather: DataFrame, on: str = schema.TIME, **limits: int) -> DataFrame:
    """Inner join of a stream to the static weather table."""
    return lookup_join(readings, weather, [on], "inner", **limits)


def bundle_rows(readings: DataFrame, key: str, time: str) -> DataFrame:
    """One row for up to ``BUNDLE`` readings of one time and share of the keys: time, _share, _hashes (ascending) and _rows.

    Readings without a time are left out, as no watermark or join sees them.
    """
    kept = [F.col(f"`{c}`") for c in readings.columns if c != time]
    rows = readings.where(F.col(time).isNotNull()).select(
        time, F.pmod(F.xxhash64(key, F.lit("share")), F.lit(SHARES)).cast("int").alias("_share"), F.xxhash64(key).alias("_hash"), F.struct(*kept).alias("_row")
    )
    out = T.StructType([rows.schema[time], rows.schema["_share"], T.StructField("_hashes", T.ArrayType(T.LongType())), T.StructField("_rows", T.ArrayType(rows.schema["_row"].dataType))])

    def bundles(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        at, share, hashes = (table.column(i).cast(pa.int64()).to_numpy() for i in range(3))
        order = np.lexsort((hashes, share, at))
        new = np.flatnonzero((np.diff(at[order]) != 0) | (np.diff(share[order]) != 0)) + 1
        starts = np.concatenate([[0], new])
        # A longer group is cut every ``BUNDLE`` rows.
        cuts = -(-np.diff(np.append(starts, len(order))) // BUNDLE)
        starts = np.repeat(starts, cuts) + BUNDLE * (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts))
        ends = np.append(starts[1:], len(order))
        for i in range(0, len(starts), 256):
            first, last = starts[i], ends[min(i + 256, len(starts)) - 1]
            part, heads = table.take(pa.array(order[first:last])), table.take(pa.array(order[starts[i : i + 256]]))
            offsets = pa.array(np.append(starts[i : i + 256], last) - first, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, part.column(c).combine_chunks()) for c in (2, 3)]
            yield pa.RecordBatch.from_arrays([*(heads.column(c).combine_chunks() for c in (0, 1)), *lists], names=out.names)

    def run(batches):
        gathered, size = [], 0
        for batch in batches:
            if batch.num_rows:
                gathered.append(batch)
                size += batch.nbytes
            if size >= GATHERED:
                yield from bundles(gathered)
                gathered, size = [], 0
        if gathered:
            yield from bundles(gathered)

    return rows.repartition(time, "_share").mapInArrow(run, out)


def equal_hashes(left: str, right: str) -> Column:
    """Places (l, r) of all equal pairs of two ascending arrays of hashes."""

    def places(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.searchsorted(y, x, "left")
        n = np.searchsorted(y, x, "right") - first
        return np.repeat(np.arange(len(x)), n), np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        (a, x), (b, y) = ((c.offsets.to_numpy(), c.values.to_numpy()) for c in (left, right))
        found = [places(x[a[i] : a[i + 1]], y[b[i] : b[i + 1]]) for i in range(len(left))]
        ends = pa.array(np.cumsum([0, *(len(i) for i, _ in found)]), pa.int32())
        sides = [pa.array(np.concatenate([np.zeros(0, np.int32), *(f[k] for f in found)]), pa.int32()) for k in (0, 1)]
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(sides, names=["l", "r"]))

    return F.arrow_udf(run, "array<struct<l:int,r:int>>")(left, right)


def match_predictions(
    predictions: DataFrame, readings: DataFrame, key: str = schema.KEY, time: str = schema.TIME, late: str = LATE
) -> DataFrame:
    """Join two streams on zone and time; the watermarks on both sides let old state go.

    Spark's join keeps an entry of its state for every row, with a count beside it. The streams are therefore joined as
    bundles of rows of one time and share of the zones, which makes the state a few large entries; the pairs inside two
    bundles are found by hash and then held to equal zones.
    """
    left, right = (
        bundle_rows(s, key, time).withWatermark(time, late).withColumnsRenamed({"_hashes": f"_{n}_hashes", "_rows": f"_{n}_rows"})
        for s, n in ((predictions, "left"), (readings, "right"))
    )
    places = equal_hashes("_left_hashes", "_right_hashes")
    both = left.join(right, [time, "_share"], "inner").select(time, "_left_rows", "_right_rows", places.alias("_places"))
    pair = lambda p: F.struct(F.get("_left_rows", p["l"]).alias("l"), F.get("_right_rows", p["r"]).alias("r"))
    pairs = both.select(time, F.transform("_places", pair).alias("_pairs")).select(time, F.explode("_pairs").alias("_pair"))
    own = [F.col(f"_pair.{n}.`{c}`").alias(c) for n, s in (("l", predictions), ("r", readings)) for c in s.columns if c not in (key, time)]
    return pairs.where(F.col(f"_pair.l.`{key}`") == F.col(f"_pair.r.`{key}`")).select(F.col(f"_pair.l.`{key}`").alias(key), time, *own)


def hourly_totals(
    readings: DataFrame,
    key: str = schema.KEY,
    time: str = schema.TIME,
    value: str = schema.VALUE,
    hour: str = "1 hour",
    late: str = LATE,
    scale: int | None = None,
) -> DataFrame:
    """Demand per zone and hour; in append mode an hour is emitted once, when nothing can join it any more."""
    total = F.sum(F.col(value).cast("double")) if scale is None else exact_sum(F.col(value), scale)
    return (
        readings.withWatermark(time, late)
        .groupBy(F.window(time, hour).alias("_window"), key)
        .agg(total.alias(value))
        .select(key, F.col("_window.start").alias(time), value)
    )


def keyed_writer(path: str, ledger: str, keys: list[str], event_time: str = schema.TIME, name: str = "intake") -> Callable[[DataFrame, int], None]:
    """The function that puts a micro-batch into a keyed table, once.

    The ledger has a row for every batch that is whole in the table. A batch found there, which Spark sends again after a
    stop between the write and its own commit, changes nothing; one that stopped before its ledger row is merged again,
    which gives the same table, as a key's newer version wins and equal versions are equal.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_is_kept(spark, ledger, batch_id, name):
            return
        rows = stage(batch, f"{name}-batch")
        seen = rows.agg(F.count("*").alias("rows"), F.countDistinct(F.to_date(event_time)).alias("days"))
        if seen.first()["rows"]:
            upsert_keyed(rows, path, keys, event_time)
        row = seen.select(F.lit(name).alias("name"), F.lit(batch_id).cast("long").alias("batch"), "rows", "days", F.current_timestamp().alias("written_at"))
        row.write.mode("append").parquet(ledger)

    return write


def batch_is_kept(spark: SparkSession, ledger: str, batch_id: int, name: str = "intake") -> bool:
    try:
        rows = spark.read.schema(LEDGER_DDL).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return not rows.where((F.col("name") == name) & (F.col("batch") == batch_id)).isEmpty()


def keep_keyed(
    readings: DataFrame, path: str, state: str, keys: list[str] | None = None, event_time: str = schema.TIME, name: str = "intake"
) -> DataFrame:
    """Drain a stream into a keyed table below ``path`` and read the table.

    ``state`` holds Spark's checkpoint and the ledger; the next call with the same goes on where this one ended.
    """
    write = keyed_writer(path, f"{state}/ledger", keys or [schema.KEY, schema.TIME], event_time, name)
    query = readings.writeStream.foreachBatch(write).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return readings.sparkSession.read.parquet(path)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on the executors' disks, and not on their heaps."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ON_DISK)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything that is there now, into Parquet below the shared folder, and read the result."""
    spark = stream.sparkSession
    out, state = scratch_path(spark, name), scratch_path(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
