"""Landed demand: JSON envelopes ``{"response": {"data": [{…}]}}`` per day."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline import schema
from hourline.functions import days_between
from hourline.operators.ordered import top_n

# Fixed values of the day request.
PARENT = "NYIS"
SETTLED_DAYS = 2
LANDED_DDL = "day date, landed_at timestamp, rows long"


def day_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day, both ends included; none when end lies before start."""
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    days = F.when(last >= first, F.sequence(first, last))
    return spark.range(1).select(F.explode(days).alias("day"))


def read_envelopes(
    spark: SparkSession, path: str, multiline: bool = False, extra: str = "", glob: str | None = None
) -> DataFrame:
    """Envelope documents with the landing ``file`` and, for text that is no JSON, ``_corrupt_record``.

    ``multiline`` reads one document per file, otherwise one per line. ``extra`` declares columns that come from the
    folder names, such as ``day date``.
    """
    ddl = f"{schema.ENVELOPE_DDL}, _corrupt_record string" + (f", {extra}" if extra else "")
    reader = (
        spark.read.schema(ddl)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    docs = reader.json(path)
    return docs.select("*", F.col("_metadata.file_path").alias("file"))


def unwrap(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records of all envelopes, and the documents that are broken or have no envelope.

    A bad document contributes no rows and never stops the run.
    """
    keep = [c for c in documents.columns if c not in ("response", "_corrupt_record", "file")]
    rows = documents.select(*keep, F.explode("response.data").alias("_record")).select(*keep, "_record.*")
    has_corrupt = "_corrupt_record" in documents.columns
    broken = F.col("response.data").isNull() | (F.col("_corrupt_record").isNotNull() if has_corrupt else F.lit(False))
    return rows, documents.where(broken)


def landed_demand(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Records landed under ``root/day=yyyy-MM-dd``; only the folders of the closed day range are read."""
    return landed_documents(spark, root, start, end)[0]


def landed_documents(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The records of ``landed_demand``, and the landed documents that could not be read, with their day and file."""
    docs = read_envelopes(spark, root, extra="day date")
    if start is not None:
        docs = docs.where(F.col("day") >= F.to_date(F.lit(start)))
    if end is not None:
        docs = docs.where(F.col("day") <= F.to_date(F.lit(end)))
    return unwrap(docs)


def landed_files(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Records of the one-document-per-day layout ``hourly_demand_yyyy-MM-dd.json``, with the day of the file."""
    docs = read_envelopes(spark, root, multiline=True, glob="hourly_demand_*.json")
    day = F.to_date(F.regexp_extract("file", r"hourly_demand_(\d{4}-\d{2}-\d{2})\.json$", 1))
    docs = docs.withColumn("day", day)
    if start is not None:
        docs = docs.where(F.col("day") >= F.to_date(F.lit(start)))
    if end is not None:
        docs = docs.where(F.col("day") <= F.to_date(F.lit(end)))
    return unwrap(docs)[0]


def request_filter(df: DataFrame, period: str = "period", parent: str = PARENT, rows: int | None = None) -> DataFrame:
    """What the day requests return: per day the readings of one parent in [day, day + 1], or the newest ``rows`` of them.

    A reading at midnight belongs to the day it starts and to the day before; ``day`` tells which request it answers.
    """
    t = F.col(period)
    day = F.to_date(t)
    days = F.when(t == F.date_trunc("day", t), F.array(day, F.date_sub(day, 1))).otherwise(F.array(day))
    asked = df.where(F.col("parent") == parent).withColumn("day", F.explode(days))
    if rows is None:
        return asked
    ties = [F.col(c) for c in df.columns if c not in (period, "parent")]
    return top_n(asked, ["day"], [t.desc(), *ties], rows)


def landed_days(spark: SparkSession, ledger: str) -> DataFrame:
    """(day, landed_at, rows): the newest entry of every day of a landing ledger; empty where none was written."""
    try:
        entries = spark.read.schema(LANDED_DDL).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        entries = spark.createDataFrame([], LANDED_DDL)
    newest = F.max_by(F.struct("landed_at", "rows"), F.struct("landed_at", "rows")).alias("_e")
    return entries.groupBy("day").agg(newest).select("day", "_e.landed_at", "_e.rows")


def days_to_read(spine: DataFrame, landed: DataFrame, as_of: Column, settled_days: int = SETTLED_DAYS) -> DataFrame:
    """Every day of ``spine`` with its age, ``landed_before`` and ``read``: true for a day that is under ``settled_days``
    old or has not landed, so that its readings must be asked for."""
    known = refresh_plan(spine, as_of, settled_days).join(landed.select("day", F.lit(True).alias("landed_before")), "day", "left")
    before = F.coalesce("landed_before", F.lit(False))
    return known.select("day", "days_old", before.alias("landed_before"), (~F.col("use_landed") | ~before).alias("read"))


def refresh_plan(days: DataFrame, as_of: Column, settled_days: int = SETTLED_DAYS) -> DataFrame:
    """Per day its age and whether the landed copy is final (at least two days old) or must be read again."""
    age = days_between(as_of, F.col("day").cast("timestamp"))
    return days.withColumns({"days_old": age, "use_landed": age >= settled_days})
