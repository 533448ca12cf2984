"""Stored tables and documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def require_source(spark: SparkSession, path: str, what: str) -> str:
    """Stop with FileNotFoundError when nothing lies at ``path``."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"{what} not found: {path}") from error
    return path


def read_table(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet", what: str = "Table") -> DataFrame:
    """A table with a declared schema, as Parquet, or as CSV with a header."""
    require_source(spark, path, what)
    reader = spark.read.schema(ddl)
    return reader.csv(path, header=True, enforceSchema=False) if fmt == "csv" else reader.format(fmt).load(path)


def read_document(spark: SparkSession, path: str, ddl: str | None = None, what: str = "Document") -> DataFrame:
    """One JSON document as a row."""
    require_source(spark, path, what)
    reader = spark.read.option("multiLine", True)
    return (reader.schema(ddl) if ddl else reader).json(path)
