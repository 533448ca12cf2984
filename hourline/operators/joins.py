"""Joins to a lookup side whose size is checked before it is broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline import schema

BROADCAST_BYTES = 64 * 1024 * 1024
TASK_ROWS = 1_000_000
HOT_KEYS = 100_000

WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def _bytes_per_row(df: DataFrame) -> Column:
    """The size of a row's values: fixed for numbers and times, measured for everything else."""
    width = F.lit(8)
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(column), F.lit(0)) + 8
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 8
        else:
            width = width + WIDTHS.get(kind, 8)
    return width.cast("bigint")


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when all of ``df`` takes at most ``max_bytes``: one sum, added up where the rows are."""
    return (df.agg(F.sum(_bytes_per_row(df))).first()[0] or 0) <= max_bytes


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Inner or left join of many facts to a lookup table.

    A lookup of a checked size is broadcast and the facts stay where they are. A larger one is joined by shuffle: the
    rows of a hot key are spread over as many tasks as its count asks for, about ``task_rows`` each, and only the lookup
    rows of hot keys are repeated. A key is hot above ``task_rows`` rows and above one in ``HOT_KEYS`` of the facts, so
    there are fewer than ``HOT_KEYS`` of them. Batches of a stream are small and are joined as they are.
    """
    if fits(lookup, broadcast_bytes):
        return facts.join(F.broadcast(lookup), on, how)
    if facts.isStreaming:
        return facts.join(lookup, on, how)
    hot = hot_keys(facts, on, task_rows)
    unmatched = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    # The partition number spreads identical rows too; which task a row goes to never changes the result. Rows without a
    # key match nothing and may lie anywhere.
    some = F.xxhash64(*facts.columns) + F.spark_partition_id()
    salts = F.when(unmatched, F.lit(1 << 16)).otherwise(F.coalesce("_salts", F.lit(1)))
    spread = facts.join(F.broadcast(hot), on, "left").withColumn("_salt", F.pmod(some, salts).cast("int")).drop("_salts")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = lookup.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def hot_keys(facts: DataFrame, on: list[str], task_rows: int = TASK_ROWS, most: int = HOT_KEYS) -> DataFrame:
    """The keys of more than ``task_rows`` rows and of more than one in ``most`` of all, with the tasks to spread them over."""
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = facts.agg(F.count(F.lit(1))).scalar()
    large = F.greatest(F.lit(task_rows).cast("long"), F.floor(total / most))
    return counts.where(F.col("_n") > large).select(*on, F.ceil(F.col("_n") / large).cast("int").alias("_salts"))


def enrich_with_weather(demand: DataFrame, weather: DataFrame, on: str = "date", **limits: int) -> DataFrame:
    """Inner join of all zones to the one weather series; hours without weather drop out.

    Columns on both sides (other than the key) get the suffixes ``_x`` and ``_y``. Null times match nothing.
    """
    clash = [c for c in demand.columns if c in weather.columns and c != on]
    left = demand.withColumnsRenamed({c: f"{c}_x" for c in clash})
    right = weather.withColumnsRenamed({c: f"{c}_y" for c in clash})
    return lookup_join(left, right, [on], "inner", **limits)


def predictions_vs_actuals(predictions: DataFrame, actuals: DataFrame) -> DataFrame:
    """Inner join on zone and time; only three columns of the actuals take part."""
    keys = [schema.KEY, schema.TIME]
    return predictions.join(actuals.select(*keys, schema.VALUE), keys, "inner")


def code_lookup(code: Column, values: dict, default: Column | None = None) -> Column:
    """A fixed dictionary as a map column, with a default for unknown codes."""
    pairs = reduce(lambda acc, kv: [*acc, F.lit(kv[0]), F.lit(kv[1])], values.items(), [])
    found = F.try_element_at(F.create_map(*pairs), code)
    return found if default is None else F.coalesce(found, default)


def zone_code(subba: Column) -> Column:
    """Zone name to its fixed index; unknown zones give null."""
    return code_lookup(subba, {name: code for code, name, *_ in schema.ZONES}).cast("bigint")


def with_zone_names(df: DataFrame, key: str = schema.KEY) -> DataFrame:
    """Add zone_name, latitude and longitude, with the defaults for codes that have no zone."""
    code = F.col(key).cast("int")
    unnamed = F.concat(F.lit("Zone "), F.col(key).cast("string"))
    return df.withColumns(
        {
            "zone_name": code_lookup(code, {z[0]: z[2] for z in schema.ZONES}, unnamed),
            "latitude": code_lookup(code, {z[0]: z[3] for z in schema.ZONES}, F.lit(schema.DEFAULT_LAT)),
            "longitude": code_lookup(code, {z[0]: z[4] for z in schema.ZONES}, F.lit(schema.DEFAULT_LON)),
        }
    )
