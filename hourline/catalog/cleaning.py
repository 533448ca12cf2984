"""Names, casts, encodings, filters, joins, unions, duplicates and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline import functions as fn
from hourline.catalog.common import (
    CALENDAR,
    DAILY,
    FEATURES,
    HOLIDAYS,
    HOURLY,
    WEATHER,
    daily,
    features,
    hourly,
    query,
    table,
    weather,
)
from hourline.operators import clean, joins, quality


@query(
    "c1_normalized_names",
    "SELECT event_id, event_type AS sub_ba_name, value AS value_units_ FROM events",
)
def normalized_names(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select("event_id", "event_type", "value").toDF("Event-ID", "Sub-BA Name", "value units ")
    return clean.normalize_names(raw)


@query("c2_rename_prune", "SELECT event_type AS sub_region, value AS demand FROM events")
def rename_prune(spark, sf_dir):
    raw = table(spark, sf_dir, "events").withColumnRenamed("event_type", "subba")
    return clean.rename_demand(raw).select("sub_region", "demand")


@query(
    "c5_parse_utc",
    """SELECT event_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_form, CAST(date_trunc('second', ts) AS TIMESTAMP) AS iso_form,
      CAST(NULL AS TIMESTAMP) AS bad_form FROM events""",
)
def parse_utc(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        fn.parse_utc(F.date_format("ts", "yyyy-MM-dd'T'HH")).alias("hour_form"),
        fn.parse_utc(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso_form"),
        fn.parse_utc(F.col("event_type")).alias("bad_form"),
    )


@query(
    "c6_try_numeric",
    "SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS demand FROM events",
)
def try_numeric(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", fn.to_number(text).alias("demand"))


ZONE_LIST = "(VALUES (0,'West',42.8864,-78.8784),(1,'Genesee',43.1610,-77.6109),(2,'Central',43.0481,-76.1474),(3,'North',44.6995,-73.4525),(4,'Mohawk Valley',43.1009,-75.2327),(5,'Capital',42.6526,-73.7562),(6,'Hudson Valley',41.7004,-73.9210),(7,'Millwood',41.2048,-73.8293),(8,'Dunwoodie',40.9142,-73.8557),(9,'New York City',40.7128,-74.0060),(10,'Long Island',40.7891,-73.1350)) z(code, name, lat, lon)"


@query(
    "c8_static_encode",
    "SELECT c_custkey, CASE WHEN c_nationkey <= 10 THEN CAST(c_nationkey AS BIGINT) END AS sub_region_code FROM customer",
)
def static_encode(spark, sf_dir):
    subba = F.concat(F.lit("ZON"), F.char(F.col("c_nationkey") + 65))
    return table(spark, sf_dir, "customer").select("c_custkey", joins.zone_code(subba).alias("sub_region_code"))


@query(
    "c9_label_encode",
    """WITH l AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS BIGINT) AS segment_code
      FROM (SELECT DISTINCT c_mktsegment FROM customer))
    SELECT c_custkey, c_mktsegment, segment_code FROM customer JOIN l USING (c_mktsegment)""",
)
def label_encode(spark, sf_dir):
    return clean.label_encode(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "segment_code")


@query(
    "c9_label_encode_many",
    """WITH l AS (SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS BIGINT) AS name_code
      FROM (SELECT DISTINCT c_name FROM customer))
    SELECT c_custkey, name_code FROM customer JOIN l USING (c_name)""",
)
def label_encode_many(spark, sf_dir):
    """As many labels as rows, numbered in 16 slices."""
    out = clean.label_encode(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", "name_code", splits=16)
    return out.select("c_custkey", "name_code")


@query(
    "c10_name_default",
    f"""SELECT c_custkey, coalesce(name, 'Zone ' || c_nationkey) AS zone_name, coalesce(CAST(lat AS DOUBLE), 42.0) AS latitude,
      coalesce(CAST(lon AS DOUBLE), -75.0) AS longitude FROM customer LEFT JOIN {ZONE_LIST} ON c_nationkey = code""",
)
def name_default(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "sub_region_code")
    return joins.with_zone_names(c).select("c_custkey", "zone_name", "latitude", "longitude")


@query(
    "c16_date_str",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS date_str, strftime(ts, '%Y-%m-%d') AS day_str FROM events",
)
def date_str(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", fn.iso_string(F.col("ts")).alias("date_str"), F.date_format("ts", "yyyy-MM-dd").alias("day_str")
    )


@query(
    "d1_closed_range",
    f"""WITH {DAILY}, m AS (SELECT max(date) AS last FROM daily)
    SELECT sub_region_code, date, demand FROM daily, m WHERE date BETWEEN last - INTERVAL 60 DAY AND last - INTERVAL 30 DAY""",
)
def closed_range(spark, sf_dir):
    base = daily(spark, sf_dir)
    last = clean.newest(base)
    return clean.between(base, "date", last - F.expr("INTERVAL 60 DAYS"), last - F.expr("INTERVAL 30 DAYS"))


@query(
    "d2_holdout_split",
    f"""WITH {DAILY}, m AS (SELECT max(date) - INTERVAL 90 DAY AS cut FROM daily)
    SELECT CASE WHEN date < cut THEN 'train' ELSE 'test' END AS part, sub_region_code, date, demand FROM daily, m""",
)
def holdout_split(spark, sf_dir):
    train, test = clean.holdout_split(daily(spark, sf_dir))
    out = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return out.select("part", "sub_region_code", "date", "demand")


@query(
    "d4_asof_clamp",
    f"""WITH {DAILY}, m AS (SELECT max(date) AS last FROM daily)
    SELECT sub_region_code, date, demand FROM daily, m WHERE date BETWEEN last - INTERVAL 29 DAY AND last""",
)
def asof_clamp(spark, sf_dir):
    """As of a year after the last row, the range ends at the last row."""
    base = daily(spark, sf_dir)
    return clean.as_of_range(base, clean.newest(base) + F.expr("INTERVAL 365 DAYS"))


@query(
    "d5_empty_range_tail",
    """WITH s AS (SELECT l_returnflag || l_linestatus || l_linenumber AS sub_region_code, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS date,
      CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS demand FROM lineitem GROUP BY 1, 2)
    SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY sub_region_code ORDER BY date DESC) <= 20""",
)
def empty_range_tail(spark, sf_dir):
    """As of a year before the first row nothing is in range, so the tail of every one of more than 11 series is used."""
    base = daily(spark, sf_dir, F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")))
    before = base.agg(F.min("date") - F.expr("INTERVAL 365 DAYS")).scalar()
    return clean.as_of_range_or_tail(base, before, tail=20)


@query(
    "e1_demand_weather",
    f"WITH {DAILY}, {WEATHER} SELECT date, sub_region_code, demand, temperature_2m FROM daily JOIN weather USING (date)",
)
def demand_weather(spark, sf_dir):
    return joins.enrich_with_weather(daily(spark, sf_dir), weather(spark, sf_dir))


@query(
    "e1_demand_weather_shuffled",
    f"WITH {DAILY}, {WEATHER} SELECT date, sub_region_code, demand, temperature_2m FROM daily JOIN weather USING (date)",
)
def demand_weather_shuffled(spark, sf_dir):
    """The same join with a lookup side that counts as too large to broadcast."""
    return joins.enrich_with_weather(daily(spark, sf_dir), weather(spark, sf_dir), broadcast_bytes=0)


@query(
    "e3_dimension_lookup",
    """SELECT c_custkey, n_name, coalesce(r_name, 'none') AS r_name FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def dimension_lookup(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    out = joins.lookup_join(table(spark, sf_dir, "customer"), nations, ["c_nationkey"], "left")
    out = joins.lookup_join(out, regions, ["n_regionkey"], "left")
    return out.select("c_custkey", "n_name", F.coalesce("r_name", F.lit("none")).alias("r_name"))


@query(
    "i1_union",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, CAST(NULL AS BIGINT) AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, CAST(s_nationkey AS BIGINT) FROM supplier""",
)
def union(spark, sf_dir):
    """Columns one side lacks are null there."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("bigint").alias("nation"))
    return clean.union_all(c, s)


@query(
    "i2_dedupe_first",
    """SELECT event_type AS sub_region_code, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date, event_id, value AS demand FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) = 1""",
)
def dedupe_first(spark, sf_dir):
    readings = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("sub_region_code"), F.date_trunc("hour", "ts").alias("date"), "event_id", F.col("value").alias("demand")
    )
    return clean.dedupe_first(readings, ["sub_region_code", "date"], [F.col("event_id")])


@query(
    "i2_clean_demand",
    """WITH r AS (SELECT CASE WHEN n_nationkey <= 10 THEN CAST(n_nationkey AS BIGINT) END AS sub_region_code,
        o_orderdate AS date, o_totalprice AS demand, o_orderkey
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT sub_region_code, date, demand, o_orderkey FROM r
    QUALIFY row_number() OVER (PARTITION BY sub_region_code, date ORDER BY o_orderkey) = 1""",
)
def clean_demand(spark, sf_dir):
    """Orders as readings of the buyer's nation; nations without a zone share the null code."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    raw = table(spark, sf_dir, "orders").join(customers, "o_custkey").select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH").alias("period"),
        F.concat(F.lit("ZON"), F.char(F.col("c_nationkey") + 65)).alias("subba"),
        F.col("o_totalprice").alias("value"),
        "o_orderkey",
    )
    return clean.clean_demand(raw, order=[F.col("o_orderkey")]).select("sub_region_code", "date", "demand", "o_orderkey")


@query(
    "i3_intersect",
    "SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS sub_region_code FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier)",
)
def intersect(spark, sf_dir):
    code = lambda name, column: table(spark, sf_dir, name).select(F.col(column).cast("bigint").alias("sub_region_code"))
    return clean.common_codes(code("customer", "c_nationkey"), code("supplier", "s_nationkey"))


@query(
    "z16_rejects",
    """SELECT count(*) FILTER (WHERE c_nationkey <= 10) AS n_kept, count(*) FILTER (WHERE c_nationkey > 10) AS n_rejected FROM customer""",
)
def rejects(spark, sf_dir):
    subba = F.concat(F.lit("ZON"), F.char(F.col("c_nationkey") + 65))
    coded = table(spark, sf_dir, "customer").withColumn("sub_region_code", joins.zone_code(subba))
    good, bad = clean.split_rejects(coded, ["sub_region_code"])
    return good.agg(F.count(F.lit(1)).alias("n_kept")).withColumn("n_rejected", bad.agg(F.count(F.lit(1))).scalar())


@query(
    "j_calendar",
    f"WITH {HOURLY}, {HOLIDAYS} SELECT sub_region_code, date, demand, {CALENDAR} FROM hourly",
)
def calendar(spark, sf_dir):
    return fn.calendar_columns(hourly(spark, sf_dir))


@query(
    "j5_holiday_midnight",
    f"""WITH {HOLIDAYS} SELECT o_orderkey, CAST(o_orderdate IN (SELECT CAST(day AS TIMESTAMP) FROM holidays) AS BIGINT) AS at_midnight,
      CAST(o_orderdate + INTERVAL 5 HOUR IN (SELECT CAST(day AS TIMESTAMP) FROM holidays) AS BIGINT) AS later FROM orders""",
)
def holiday_midnight(spark, sf_dir):
    flag = lambda t: fn.is_holiday(t).cast("bigint")
    t = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", flag(t).alias("at_midnight"), flag(t + F.expr("INTERVAL 5 HOURS")).alias("later")
    )


@query(
    "j5_holiday_day",
    f"WITH {HOLIDAYS} SELECT event_id, CAST(CAST(ts AS DATE) IN (SELECT day FROM holidays) AS BIGINT) AS is_holiday FROM events",
)
def holiday_day(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fn.is_holiday(F.col("ts"), "calendar_day").cast("bigint").alias("is_holiday"))


@query(
    "j6_date_floor_and_shift",
    """SELECT event_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_floor, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_floor,
      CAST(date_trunc('hour', ts) + INTERVAL 1 HOUR AS TIMESTAMP) AS next_hour, ts - INTERVAL 720 HOUR AS live_start,
      CAST(floor((epoch_us(TIMESTAMP '2024-02-01 12:00:00') // 1000000 - epoch_us(ts) // 1000000) / 86400) AS BIGINT) AS days_old,
      CAST(date_trunc('second', ts) AS TIMESTAMP) AS from_epoch FROM events""",
)
def date_floor_and_shift(spark, sf_dir):
    t = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_trunc("hour", t).alias("hour_floor"),
        F.date_trunc("day", t).alias("day_floor"),
        (F.date_trunc("hour", t) + F.expr("INTERVAL 1 HOUR")).alias("next_hour"),
        (t - F.expr("INTERVAL 720 HOURS")).alias("live_start"),
        fn.days_between(F.lit("2024-02-01 12:00:00").cast("timestamp"), t).alias("days_old"),
        fn.from_epoch(F.unix_timestamp(t)).alias("from_epoch"),
    )


@query(
    "j11_eastern",
    """SELECT l_orderkey, l_linenumber,
      ((l_shipdate + to_hours(CAST(l_linenumber AS INTEGER))) AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS date_eastern FROM lineitem""",
)
def eastern(spark, sf_dir):
    t = F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", fn.eastern(t).alias("date_eastern"))


@query(
    "j16_half_even",
    "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS rounded, CAST(trunc(l_quantity / 2) AS BIGINT) AS whole FROM lineitem",
)
def half_even(spark, sf_dir):
    half = F.col("l_quantity") / 2
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.round_half_even(half).alias("rounded"), half.cast("bigint").alias("whole")
    )


PRESENT = """SELECT 'missing_values' AS "check", 'value' AS "column", avg(CAST(value IS NULL AS DOUBLE)) AS value,
  avg(CAST(value IS NULL AS INT)) <= 0.05 AS passed FROM events"""


@query(
    "q1_column_presence",
    PRESENT + """ UNION ALL SELECT 'column_presence', c, NULL, c <> 'subba' FROM (VALUES ('event_id'), ('value'), ('subba')) t(c)
    UNION ALL SELECT 'data_types', c, NULL, true FROM (VALUES ('event_id'), ('value')) t(c)""",
)
def column_presence(spark, sf_dir):
    expected = {"event_id": "int", "value": "float", "subba": "str"}
    return quality.quality_report(table(spark, sf_dir, "events"), expected, ["value"])


@query(
    "q2_data_types",
    PRESENT + """ UNION ALL SELECT 'column_presence', c, NULL, true FROM (VALUES ('event_id'), ('value'), ('event_type')) t(c)
    UNION ALL SELECT 'data_types', c, NULL, c <> 'value' FROM (VALUES ('event_id'), ('value'), ('event_type')) t(c)""",
)
def data_types(spark, sf_dir):
    expected = {"event_id": "int", "value": "int", "event_type": "object"}
    return quality.quality_report(table(spark, sf_dir, "events"), expected, ["value"])


WITH_GAPS = """gaps AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
  CASE WHEN user_id = 7 THEN NULL ELSE props END AS props, ts FROM events)"""


def with_gaps(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("user_id") != 7, F.col("props")).alias("props"),
        "ts",
    )


SHARES = """shares AS (SELECT 'event_id' AS "column", avg(CAST(event_id IS NULL AS INT)) AS s FROM gaps
  UNION ALL SELECT 'value', avg(CAST(value IS NULL AS INT)) FROM gaps
  UNION ALL SELECT 'props', avg(CAST(props IS NULL AS INT)) FROM gaps
  UNION ALL SELECT 'ts', avg(CAST(ts IS NULL AS INT)) FROM gaps)"""


@query("f1_null_share", f'WITH {WITH_GAPS}, {SHARES} SELECT "column", round(s, 6) AS value FROM shares')
def null_share(spark, sf_dir):
    return quality.null_shares(with_gaps(spark, sf_dir)).withColumn("value", F.round("value", 6))


@query("q3_missing", f'WITH {WITH_GAPS}, {SHARES} SELECT "column", round(s, 6) AS value, NOT s > 0.05 AS passed FROM shares')
def missing(spark, sf_dir):
    gaps = with_gaps(spark, sf_dir)
    return quality.missing_values(gaps, gaps.columns).withColumn("value", F.round("value", 6))


@query("q4_strict_missing", f'WITH {WITH_GAPS}, {SHARES} SELECT "column", s > 0 AS has_missing FROM shares')
def strict_missing(spark, sf_dir):
    return quality.any_missing(with_gaps(spark, sf_dir))


@query(
    "q5_report",
    f"""WITH {WITH_GAPS}, {SHARES} SELECT 'missing_values' AS "check", "column", round(s, 6) AS value, NOT s > 0.05 AS passed FROM shares
    UNION ALL SELECT 'column_presence', 'value', NULL, true UNION ALL SELECT 'data_types', 'value', NULL, true""",
)
def report(spark, sf_dir):
    gaps = with_gaps(spark, sf_dir)
    return quality.quality_report(gaps, {"value": "float"}, gaps.columns).withColumn("value", F.round("value", 6))


@query("q5_status", f"WITH {WITH_GAPS}, {SHARES} SELECT bool_and(NOT s > 0.05) AS validation_status FROM shares")
def status(spark, sf_dir):
    gaps = with_gaps(spark, sf_dir)
    return quality.validation_status(quality.quality_report(gaps, None, gaps.columns))


@query("feature_table", f"WITH {FEATURES} SELECT date, sub_region_code, demand, temperature_2m, hour, day_of_week, month, is_weekend, is_holiday FROM features")
def feature_table(spark, sf_dir):
    return features(spark, sf_dir)


@query("b12_feature_view", f"WITH {FEATURES} SELECT sub_region_code, count(*) AS n, max(demand) AS peak, max(hour) AS hour FROM features GROUP BY 1")
def feature_view(spark, sf_dir):
    from hourline.plans import feature_view as view

    view(features(spark, sf_dir), "daily_features")
    return spark.sql("SELECT sub_region_code, count(*) AS n, max(demand) AS peak, max(hour) AS hour FROM daily_features GROUP BY 1")
