"""Helpers of the operators: row-wise work over Arrow batches, dense names of sorted keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hourline.session import stage

#: White space of the text contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
WS = r"\x20\x09-\x0D"
BATCH_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: str, buckets: int, bucket: int):
    """True where crc32 of the id as text leaves ``bucket``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % buckets == bucket, F.lit(False))


def slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Parts of a batch with about BATCH_CHARS characters each, one row at least."""
    texts, start, size = batch.column(batch.schema.get_field_index(text)).to_pylist(), 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield batch.slice(start, i + 1 - start), texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def add_columns(df: DataFrame, text: str, fields: list[T.StructField], fn: Callable[[], Callable], keep_text: bool = True) -> DataFrame:
    """Columns computed from ``text``, row by row. ``fn()`` runs once in a task and gives the function from a list of
    texts to one list per field. Input columns named like a new one are replaced, all others stay, the text unless told
    otherwise."""
    names = [f.name for f in fields]
    given = [f for f in df.schema.fields if f.name not in names or f.name == text]
    kept = [f for f in given if keep_text or f.name != text]
    if text in names:
        raise ValueError(f"{text!r} is the text column")
    kinds = [to_arrow_type(f.dataType) for f in fields]
    places = [i for i, f in enumerate(given) if f in kept]

    def run(batches):
        work = fn()
        for batch in batches:
            for part, texts in slices(batch, text):
                new = [pa.array(v, type=k) for v, k in zip(work(texts), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in places] + new, names=[f.name for f in kept] + names)

    return df.select(*[F.col(f"`{f.name}`") for f in given]).mapInArrow(run, T.StructType(kept + fields))


def keep_rows(df: DataFrame, text: str, fn: Callable[[], Callable]) -> DataFrame:
    """The rows whose text the function of ``fn()`` marks; all columns as they are."""

    def run(batches):
        work = fn()
        for batch in batches:
            for part, texts in slices(batch, text):
                yield part.filter(pa.array(work(texts), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def name_keys(keys: DataFrame, by: list[str], name: str, label: str) -> DataFrame:
    """Distinct ``keys`` with their rank from 1 in the order of ``by``, written once.

    Sorted over all tasks by range; a task's rows are numbered in place and the tasks' row counts give the offsets, so
    no task sees more than its range. The offsets are one row per task.
    """
    placed = stage(keys.sort(*by).withColumn("_at", F.monotonically_increasing_id()), label)
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select(*keys.columns, (F.col("_before") + inside + 1).alias(name))
