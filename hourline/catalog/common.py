"""Registry and the bindings of the given tables to the data model.

``hourly``: events per type and hour. ``daily``: line items per return flag and ship day. ``weather``: mean order price
per order day. Sums run over two-decimal numbers, so they are exact and do not depend on the order of the rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline.functions import calendar_columns, exact_sum
from hourline.operators.clean import demand_series
from hourline.operators.joins import enrich_with_weather
from hourline.session import use_utc

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL twin; timestamps and days leave it as UTC wall clock."""

    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(use_utc(spark), sf_dir)
            times = {c for c, t in df.dtypes if t in ("timestamp", "date")}
            return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in times else F.col(c) for c in df.columns])

        REGISTRY[name] = (run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand_series(table(spark, sf_dir, "events"), F.col("event_type"), F.col("ts"), F.col("value"), scale=2)


def daily(spark: SparkSession, sf_dir: str, key: Column | None = None) -> DataFrame:
    key = F.col("l_returnflag") if key is None else key
    return demand_series(table(spark, sf_dir, "lineitem"), key, F.col("l_shipdate"), F.col("l_quantity"), "day", scale=2)


def mean_of(column: str) -> Column:
    return exact_sum(F.col(column), 2) / F.count(column)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.date_trunc("day", "o_orderdate").alias("date")).agg(
        mean_of("o_totalprice").alias("temperature_2m")
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_columns(enrich_with_weather(daily(spark, sf_dir), weather(spark, sf_dir)))


HOURLY = """hourly AS (
  SELECT event_type AS sub_region_code, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS demand
  FROM events GROUP BY 1, 2)"""

DAILY = """daily AS (
  SELECT l_returnflag AS sub_region_code, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS date,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS demand
  FROM lineitem GROUP BY 1, 2)"""

WEATHER = """weather AS (
  SELECT CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS date,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS temperature_2m
  FROM orders GROUP BY 1)"""

# Federal holidays as a list per year, moved off the weekend where the rule says so.
HOLIDAYS = """years AS (SELECT CAST(range AS INTEGER) AS y FROM range(1979, 2041)),
dated AS (
  SELECT make_date(y, m, d) AS day FROM years, (VALUES (1, 1, 0), (6, 19, 2021), (7, 4, 0), (11, 11, 0), (12, 25, 0)) v(m, d, since)
  WHERE y >= since),
observed AS (
  SELECT CASE isodow(day) WHEN 6 THEN day - 1 WHEN 7 THEN day + 1 ELSE day END AS day FROM dated),
mondays AS (
  SELECT make_date(y, m, 1) + CAST((8 - isodow(make_date(y, m, 1))) % 7 AS INTEGER) + 7 * (n - 1) AS day
  FROM years, (VALUES (1, 3, 1986), (2, 3, 0), (9, 1, 0), (10, 2, 0)) v(m, n, since) WHERE y >= since),
thursdays AS (
  SELECT make_date(y, 11, 1) + CAST((11 - isodow(make_date(y, 11, 1))) % 7 AS INTEGER) + 21 AS day FROM years),
memorial AS (
  SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) AS day FROM years),
holidays AS (
  SELECT CAST(day AS DATE) AS day FROM observed UNION SELECT CAST(day AS DATE) FROM mondays
  UNION SELECT CAST(day AS DATE) FROM thursdays UNION SELECT CAST(day AS DATE) FROM memorial)"""

CALENDAR = """CAST(hour(date) AS BIGINT) AS hour, CAST(isodow(date) - 1 AS BIGINT) AS day_of_week,
         CAST(month(date) AS BIGINT) AS month, CAST(isodow(date) >= 6 AS BIGINT) AS is_weekend,
         CAST(date IN (SELECT CAST(day AS TIMESTAMP) FROM holidays) AS BIGINT) AS is_holiday"""

FEATURES = f"""{DAILY},
{WEATHER},
{HOLIDAYS},
features AS (
  SELECT date, sub_region_code, demand, temperature_2m, {CALENDAR}
  FROM daily JOIN weather USING (date))"""
