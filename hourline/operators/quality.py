"""Data-quality checks: columns, types and shares of missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

FAMILIES = {
    "int": {"int", "bigint"},
    "float": {"float", "double"},
    "object": {"string"},
    "str": {"string"},
}
CHECKED = ["date_str", "date", "subba", "value", "temperature_2m"]
REPORT_DDL = "check string, column string, value double, passed boolean"


def missing_columns(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Expected columns the table lacks; extra columns are fine."""
    return sorted(set(expected) - set(df.columns))


def type_mismatches(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Columns outside their type family; absent columns are skipped, other names mean one exact type."""
    actual = dict(df.dtypes)
    return [c for c, t in expected.items() if c in actual and actual[c] not in FAMILIES.get(t, {t})]


def _missing(df: DataFrame, column: str) -> Column:
    absent = F.col(column).isNull()
    return absent | F.isnan(column) if dict(df.dtypes)[column] in ("double", "float") else absent


def null_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, value): the share of null or NaN per column, from one pass over the table."""
    columns = columns or df.columns
    shares = df.agg(*[F.avg(_missing(df, c).cast("double")).alias(c) for c in columns])
    return shares.unpivot([], columns, "column", "value")


def missing_values(df: DataFrame, columns: list[str] | None = None, threshold: float = 0.05) -> DataFrame:
    """``null_shares`` with a verdict; a share passes up to and including the threshold."""
    return null_shares(df, columns or CHECKED).withColumn(
        "passed", ~(F.coalesce(F.col("value"), F.lit(0.0)) > threshold)
    )


def any_missing(df: DataFrame) -> DataFrame:
    """The strict form: (column, has_missing) for every column."""
    flags = df.agg(*[F.coalesce(F.max(_missing(df, c)), F.lit(False)).alias(c) for c in df.columns])
    return flags.unpivot([], df.columns, "column", "has_missing")


def quality_report(
    df: DataFrame,
    expected: dict[str, str] | None = None,
    columns: list[str] | None = None,
    threshold: float = 0.05,
    strict: bool = False,
) -> DataFrame:
    """(check, column, value, passed) for every check; without ``expected`` only missing values are checked."""
    expected = expected or {}
    absent, wrong = missing_columns(df, expected), type_mismatches(df, expected)
    static = [Row(check="column_presence", column=c, value=None, passed=c not in absent) for c in expected]
    static += [Row(check="data_types", column=c, value=None, passed=c not in wrong) for c in expected if c in df.columns]
    limit = 0.0 if strict else threshold
    found = missing_values(df, df.columns if strict else columns, limit).select(
        F.lit("missing_values").alias("check"), "column", "value", "passed"
    )
    return found.unionByName(df.sparkSession.createDataFrame(static, REPORT_DDL)) if static else found


def validation_status(report: DataFrame) -> DataFrame:
    """One row: whether every check passed."""
    return report.agg(F.coalesce(F.min("passed"), F.lit(True)).alias("validation_status"))


def require_valid(df: DataFrame, status: DataFrame) -> DataFrame:
    """Stop when validation failed; off in the default feature build."""
    if not status.first()["validation_status"]:
        raise ValueError("Data validation failed; no features are built")
    return df
