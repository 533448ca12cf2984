"""The latest vector of every series, kept up to date by a stream.

The state of a series is its last ``seq_len`` readings. A late reading takes its place in their order, one older than
all of a full state changes nothing. No watermark is set: a series that falls silent keeps its vector.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline import schema
from hourline.operators.windows import LAGS
from hourline.session import stage

#: Rows a task gathers before it trims them, and the rows it keeps at most before it hands them on.
GATHERED_ROWS = 50_000
KEPT_ROWS = 500_000
STATE_DDL = "at array<bigint>, readings array<double>, covariates array<string>"


def trim_recent(rows: DataFrame, seq_len: int, key: str, at: str, reading: str) -> DataFrame:
    """The rows of each input partition that can still be among the last ``seq_len`` times of their series.

    Of several rows of a series and time the one with the largest reading stays. A series that holds most of the rows so
    sends ``seq_len`` rows per task to its state. A task keeps KEPT_ROWS rows at most and then hands them on as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, fresh = [], []
        count = lambda parts: sum(p.num_rows for p in parts)
        for batch in batches:
            fresh.append(batch)
            if count(fresh) >= max(GATHERED_ROWS, count(kept)):
                kept, fresh = _newest(kept + fresh, seq_len, key, at, reading), []
                if count(kept) > KEPT_ROWS:
                    yield from kept
                    kept = []
        yield from _newest(kept + fresh, seq_len, key, at, reading)

    return rows.mapInArrow(run, rows.schema)


def _newest(parts: list[pa.RecordBatch], seq_len: int, key: str, at: str, reading: str) -> list[pa.RecordBatch]:
    if not parts:
        return []
    rows = pa.Table.from_batches(parts).combine_chunks()
    frame = rows.to_pandas()
    by = [key, at, reading, *[c for c in rows.column_names if c not in (key, at, reading)]]
    order = frame.sort_values(by, na_position="first").drop_duplicates([key, at], keep="last")
    recent = order.groupby(key).cumcount(ascending=False) < seq_len
    return rows.take(pa.array(np.sort(order.index[recent]))).to_batches()


def _updater(seq_len: int) -> Callable:
    """The function that puts a micro-batch's rows of one series into its state and gives its new vector."""

    def update(key, frames, state):
        at, readings, covariates = state.get if state.exists else ([], [], None)
        known = dict(zip(at, readings))
        newest, before = (max(known) if known else None), (list(at), list(readings), covariates)
        arrived = {}
        for frame in frames:
            for t, value, missing, *rest in frame.itertuples(index=False, name=None):
                rank = (not missing, 0.0 if missing else value, [(r is not None, r or "") for r in rest])
                if t not in arrived or arrived[t][0] < rank:
                    arrived[t] = (rank, None if missing else value, rest)
            for t in sorted(arrived)[:-seq_len]:
                del arrived[t]
        known |= {t: value for t, (_, value, _) in arrived.items()}
        times = sorted(known)[-seq_len:]
        if arrived and (newest is None or max(arrived) >= newest):
            covariates = list(arrived[max(arrived)][2])
        after = (times, [known[t] for t in times], covariates)
        if repr(after) == repr(before):
            return
        state.update(after)
        yield pd.DataFrame({"key": [key[0]], "at": [times[-1]], "readings": [after[1]], "covariates": [covariates], "n": [len(times)]})

    return update


def latest_vectors(
    readings: DataFrame,
    seq_len: int = schema.SEQ_LEN,
    key: str = schema.KEY,
    time: str = schema.TIME,
    value: str = schema.VALUE,
    covariates: list[str] | None = None,
) -> DataFrame:
    """The new vector of every series that a micro-batch has changed, with the columns of ``windows.latest_windows``.

    There is one reading per series and time: of those of one micro-batch the largest (a null is the smallest, equal ones
    are told apart by their covariates), and a later micro-batch replaces it. A NaN counts as a null, which keeps its place.
    Rows without a key or a time belong to no series and are left out. Covariates are of simple types; those of the newest
    time count.
    """
    covariates = list(schema.COVARIATES if covariates is None else covariates)
    kinds = dict(readings.dtypes)
    reading = F.col(value).cast("double")
    lost = reading.isNull() | F.isnan(reading)
    rows = readings.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("key"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("at"),
        F.when(~lost, reading).alias("reading"),
        lost.alias("missing"),
        # Text keeps whole numbers with nulls as they are on their way through pandas.
        *[F.col(c).cast("string").alias(f"covariate{i}") for i, c in enumerate(covariates)],
    )
    out = T.StructType([rows.schema["key"], T.StructField("at", T.LongType()), *T.StructType.fromDDL(f"{STATE_DDL}, n int").fields[1:]])
    values = [c for c in rows.columns if c != "key"]
    update = _updater(seq_len)

    def step(k, frames, state):
        yield from update(k, (f[values] for f in frames), state)

    changed = trim_recent(rows, seq_len, "key", "at", "reading").groupBy("key").applyInPandasWithState(
        step, out, T.StructType.fromDDL(STATE_DDL), "update", "NoTimeout"
    )
    return changed.select(
        F.col("key").alias(key),
        F.timestamp_micros("at").alias(time),
        F.col("readings").alias(LAGS),
        *[F.get("covariates", F.lit(i)).cast(kinds[c]).alias(c) for i, c in enumerate(covariates)],
        F.col("n").alias("n_lags"),
    )


def read_latest(spark: SparkSession, path: str, columns: T.StructType, key: str = schema.KEY, before: int | None = None) -> DataFrame:
    """The newest vector of every series kept below ``path``; an empty table where nothing is kept yet.

    Read from the last batch that holds all series on.
    """
    kept = T.StructType([*columns.fields, T.StructField("whole", T.BooleanType()), T.StructField("batch", T.LongType())])
    try:
        rows = spark.read.schema(kept).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], columns)
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    start = rows.where("whole").agg(F.coalesce(F.max("batch"), F.lit(0)).alias("b")).scalar()
    newest = rows.where(F.col("batch") >= start).groupBy(key).agg(F.max_by(F.struct(*columns.names), "batch").alias("_newest"))
    return newest.select("_newest.*")


def latest_writer(path: str, columns: T.StructType, key: str = schema.KEY, fold: int = 50) -> Callable[[DataFrame, int], None]:
    """The function that keeps a micro-batch's vectors, in a folder of its own that a repeated batch writes anew.

    Every ``fold``-th batch also takes over the vectors of all other series, so that reading never goes back further.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows, whole = batch, batch_id % fold == 0
        if whole and batch_id:
            rows = stage(batch, "latest-batch")
            # Both sides have one row per series.
            rows = rows.unionByName(read_latest(batch.sparkSession, path, columns, key, batch_id).join(rows.select(key), key, "left_anti"))
        rows = rows.withColumns({"whole": F.lit(whole), "batch": F.lit(batch_id).cast("long")})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "whole").parquet(path)

    return write


def keep_latest(vectors: DataFrame, path: str, state: str, key: str = schema.KEY, fold: int = 50) -> DataFrame:
    """Drain a stream of ``latest_vectors`` into the table below ``path`` and read the newest vector of every series.

    ``state`` is Spark's checkpoint; the next call with the same goes on where this one ended.
    """
    write = latest_writer(path, vectors.schema, key, fold)
    query = vectors.writeStream.foreachBatch(write).option("checkpointLocation", state).outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    return read_latest(vectors.sparkSession, path, vectors.schema, key)
