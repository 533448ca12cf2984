"""Names, types, encodings, filters, unions and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline import schema
from hourline.functions import exact_sum, iso_string, normalized_name, parse_utc, to_number
from hourline.operators.joins import lookup_join, zone_code
from hourline.operators.ordered import running_totals, top_n
from hourline.session import stage


def normalize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalized_name(c) for c in df.columns])


def rename_demand(df: DataFrame) -> DataFrame:
    """subba → sub_region and value → demand; names that are absent are left alone."""
    return df.withColumnsRenamed({"subba": "sub_region", "value": "demand"})


def split_rejects(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column, and the rows that lack one."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return df.where(complete), df.where(~complete)


def union_all(*tables: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column one table lacks is null there."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Keep the first row per key; without ``order`` the row that sorts first by all of its columns.

    Every map task already drops its own duplicates before the shuffle, so many copies of one key are no burden.
    """
    return top_n(df, keys, order or [F.col(c) for c in df.columns if c not in keys] or [F.lit(0)], 1)


def clean_demand(raw: DataFrame, dedupe: bool = True, order: list[Column] | None = None) -> DataFrame:
    """Raw readings to date, sub_region_code and demand.

    Unknown zones keep a null code and unusable values a null demand. Of several rows for one (date, zone) the first by
    ``order`` stays, for landed files usually the landing day; without ``order`` the row that sorts first.
    """
    out = raw.withColumns(
        {
            "date": parse_utc(F.col("period")),
            "sub_region_code": zone_code(F.col("subba")),
            "demand": to_number(F.col("value").cast("string")),
        }
    )
    return dedupe_first(out, ["date", "sub_region_code"], order) if dedupe else out


def label_encode(df: DataFrame, column: str, into: str, splits: int | None = None) -> DataFrame:
    """Number the sorted distinct values from 0 and put each row's number into ``into``."""
    distinct = stage(df.select(column).where(F.col(column).isNotNull()).distinct(), "labels")
    codes = running_totals(distinct.withColumn("_one", F.lit(1)), column, ["_one"], splits=splits)
    return lookup_join(df, codes.select(column, F.col("_one_before").cast("bigint").alias(into)), [column], "left")


def date_strings(df: DataFrame, time: str = schema.TIME) -> DataFrame:
    return df.withColumn("date_str", iso_string(F.col(time)))


def between(df: DataFrame, time: str, start: Column, end: Column) -> DataFrame:
    """The closed range ``start ≤ time ≤ end``."""
    return df.where(F.col(time).between(start, end))


def newest(df: DataFrame, time: str = schema.TIME) -> Column:
    """The latest time of a table as a scalar subquery: no driver round trip and no join."""
    return df.agg(F.max(time)).scalar()


def holdout_split(df: DataFrame, days: int = 90, time: str = schema.TIME) -> tuple[DataFrame, DataFrame]:
    """Train is everything before ``max(time) − days`` over all zones, test is the rest."""
    cutoff = newest(df, time) - F.make_dt_interval(F.lit(days))
    return df.where(F.col(time) < cutoff), df.where(F.col(time) >= cutoff)


def as_of_range(df: DataFrame, as_of: Column, days: int = 29, time: str = schema.TIME) -> DataFrame:
    """The ``days`` before the earlier of ``as_of`` and the newest row, both ends included."""
    end = F.least(as_of, newest(df, time))
    return between(df, time, end - F.make_dt_interval(F.lit(days)), end)


def as_of_range_or_tail(
    df: DataFrame, as_of: Column, days: int = 29, tail: int = schema.SEQ_LEN, time: str = schema.TIME, key: str = schema.KEY
) -> DataFrame:
    """Like ``as_of_range``; when nothing falls into the range, the last ``tail`` rows of every zone instead."""
    ranged = as_of_range(df, as_of, days, time)
    return top_n(df, [key], [F.col(time).desc()], tail) if ranged.isEmpty() else ranged


def tail_rows(df: DataFrame, n: int, time: str = schema.TIME, key: str = schema.KEY) -> DataFrame:
    """The last ``n`` rows by time, ties by key."""
    return df.orderBy(F.col(time).desc(), F.col(key).desc()).limit(n)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def require_columns(df: DataFrame, columns: list[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{schema.NO_COLUMNS}: {missing}")


def require_numeric(df: DataFrame, columns: list[str] | None = None) -> None:
    """Refuse feature tables with anything but whole numbers, floating point and booleans."""
    allowed = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}
    allowed |= {"array<double>"}
    bad = [f.name for f in df.schema.fields if (columns is None or f.name in columns) and f.dataType.simpleString() not in allowed]
    if bad:
        raise ValueError(f"These columns hold no numbers: {bad}")


def fallback(live: DataFrame, baseline: DataFrame) -> DataFrame:
    """The live table, or the baseline when the live one is empty."""
    return baseline if live.isEmpty() else live


def common_codes(a: DataFrame, b: DataFrame, key: str = schema.KEY) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def demand_series(
    df: DataFrame, key: Column, time: Column, value: Column, grain: str = "hour", scale: int | None = None
) -> DataFrame:
    """Sum readings per series and hour (or day): one row per (key, time).

    With ``scale`` the values have at most that many decimals and the sums are exact.
    """
    total = F.sum(value.cast("double")) if scale is None else exact_sum(value, scale)
    return df.groupBy(key.alias(schema.KEY), F.date_trunc(grain, time).alias(schema.TIME)).agg(total.alias(schema.VALUE))
