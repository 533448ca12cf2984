"""Tables, documents and the run log."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline import schema
from hourline.operators.clean import dedupe_first
from hourline.session import shuffle_partitions, stage

MAX_RECORDS_PER_FILE = 5_000_000


def write_landed_demand(records: DataFrame, root: str, day: str = "day") -> None:
    """Land records as envelopes under ``root/day=…``, replacing only the days that occur in ``records``.

    One envelope per line and record, so no day has to be put together in one place: small days are written by one task
    each, a large one is split over several. A day without records leaves no folder.
    """
    fields = [c for c in records.columns if c != day]
    envelope = F.to_json(F.struct(F.struct(F.array(F.struct(*fields)).alias("data")).alias("response")))
    (
        records.select(F.col(day).alias("day"), envelope.alias("value"))
        .hint("rebalance", "day")
        .write.partitionBy("day")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .text(root)
    )


def refresh_landed(
    records: DataFrame, root: str, ledger: str, days: DataFrame, landed_at: Column, day: str = "day"
) -> DataFrame:
    """Land the readings of the days marked ``read`` (see ``sources.days_to_read``), leaving all others as they lie.

    Exactly the days that are asked for and have readings are replaced, and the ledger gets an entry for each, after they
    are written: a run that stops before that reads them again. ``records`` are cut to those days where they are scanned.
    Returns the plan with ``action`` (kept, landed, replaced, none where a day asked for has no readings) and ``rows``.
    """
    plan = stage(days, "days-to-read")
    wanted = plan.where("read").select(F.col("day").alias(day))
    # One row per calendar day of the range.
    fresh = stage(records.join(F.broadcast(wanted), day, "left_semi"), "fresh-days")
    counts = stage(fresh.groupBy(F.col(day).alias("day")).agg(F.count("*").alias("rows")), "fresh-counts")
    if not counts.isEmpty():
        write_landed_demand(fresh, root, day)
        counts.select("day", landed_at.cast("timestamp").alias("landed_at"), "rows").coalesce(1).write.mode("append").parquet(ledger)
    action = (
        F.when(~F.col("read"), "kept").when(F.col("rows").isNull(), "none").when(F.col("landed_before"), "replaced").otherwise("landed")
    )
    return plan.join(F.broadcast(counts), "day", "left").select("day", "days_old", action.alias("action"), F.coalesce("rows", F.lit(0)).alias("rows"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Whole-table write as Parquet or as CSV with a header."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
    writer.csv(path, header=True) if fmt == "csv" else writer.format(fmt).save(path)


def write_features(df: DataFrame, path: str, time: str = schema.TIME, key: str = schema.KEY, fmt: str = "parquet") -> None:
    """The feature table in time order: range-partitioned, so the order holds across files without a one-task sort."""
    ordered = df.repartitionByRange(shuffle_partitions(df.sparkSession), time, key).sortWithinPartitions(time, key)
    write_table(ordered, path, fmt)


def write_daily(df: DataFrame, path: str, day: str = "day") -> None:
    """Rows by day, replacing exactly the days that occur."""
    df.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row table as a JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def keep_predictions(predictions: DataFrame, path: str, key: str = schema.KEY, time: str = schema.TIME) -> None:
    """Keep the history of predictions by day, so that a later run can be compared with what was predicted before.

    A prediction of the same zone and hour replaces the older one, so a job that runs twice leaves the same table.
    """
    upsert_keyed(predictions, path, [key, time], time)


def run_row(
    spark: SparkSession, run: str, step: str, params: dict[str, object], metrics: dict[str, float], logged_at: Column
) -> DataFrame:
    """One log row: what was run with which parameters and what came out."""
    row = (run, step, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})
    df = spark.createDataFrame([row], "run string, step string, params map<string,string>, metrics map<string,double>")
    return df.withColumn("logged_at", logged_at)


def append_runs(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def log_runs(rows: DataFrame, path: str, run_id: str) -> None:
    """Log the rows of a run under its id; a run that is repeated with its id replaces what it logged before.

    Steps of one name are replaced together, so they are given in one call. Every (id, run) lies in a folder of its own.
    """
    marked = rows.withColumn("run_id", F.lit(run_id))
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "run").parquet(path)


def upsert_keyed(new: DataFrame, path: str, keys: list[str], event_time: str = schema.TIME) -> DataFrame:
    """Merge rows into a keyed table partitioned by day of the event time; the newer version of a key wins.

    Only the days that occur in ``new`` are read and replaced. The key
    must fix the event time, as (date_str, zone) does, so that a row never moves between days.
    """
    spark = new.sparkSession
    incoming = new.withColumn("day", F.to_date(event_time))
    try:
        old = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        old = None
    if old is not None:
        days = incoming.select("day").distinct()
        # One row per day that changes.
        touched = old.join(F.broadcast(days), "day", "left_semi").withColumn("_age", F.lit(1))
        incoming = incoming.withColumn("_age", F.lit(0)).unionByName(touched)
    else:
        incoming = incoming.withColumn("_age", F.lit(0))
    rest = [F.col(c) for c in new.columns if c not in keys]
    merged = stage(dedupe_first(incoming, keys, [F.col("_age"), *rest]).drop("_age"), f"upsert-{uuid.uuid4().hex[:8]}")
    merged.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return spark.read.parquet(path)
