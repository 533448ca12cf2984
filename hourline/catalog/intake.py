"""Sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hourline import jobs, plans, schema, sinks, sources, streaming
from hourline.catalog.common import DAILY, HOURLY, WEATHER, daily, hourly, mean_of, query, table, weather
from hourline.catalog.series import flat as array_scalars
from hourline.functions import iso_string, naive
from hourline.operators.clean import fallback, newest
from hourline.operators.joins import with_zone_names
from hourline.operators.metrics import regression_metrics
from hourline.operators.quality import quality_report, require_valid, validation_status
from hourline.operators.windows import seasonal_naive
from hourline.session import scratch_path

RECORDS = f"""{HOURLY},
records AS (
  SELECT CAST(CAST(date AS DATE) AS TIMESTAMP) AS day, strftime(date, '%Y-%m-%dT%H') AS period, sub_region_code AS subba, demand AS value
  FROM hourly)"""


def records(spark, sf_dir):
    """Hourly demand in the form the day requests deliver it."""
    return hourly(spark, sf_dir).select(
        F.to_date("date").alias("day"),
        F.date_format("date", "yyyy-MM-dd'T'HH").alias("period"),
        F.col("sub_region_code").alias("subba"),
        F.col("demand").cast("decimal(18,2)").cast("string").alias("value"),
    )


@query("a1_json_envelope", f"WITH {RECORDS} SELECT day, period, subba, value FROM records")
def json_envelope(spark, sf_dir):
    root = scratch_path(spark, "landed")
    sinks.write_landed_demand(records(spark, sf_dir), root)
    landed = sources.landed_demand(spark, root)
    return landed.select("day", "period", "subba", F.col("value").cast("double").alias("value"))


@query(
    "a2_bad_documents",
    f"""WITH {HOURLY} SELECT 'records' AS kind, count(*) AS n FROM hourly
    UNION ALL SELECT 'rejected', count(*) FROM events""",
)
def bad_documents(spark, sf_dir):
    """Good envelopes next to documents that are JSON but no envelope."""
    root = scratch_path(spark, "mixed")
    sinks.write_landed_demand(records(spark, sf_dir), root)
    other = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.col("props").alias("value"))
    other.write.partitionBy("day").mode("append").text(root)
    rows, rejected = sources.unwrap(sources.read_envelopes(spark, root, extra="day date"))
    counted = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    return counted(rows, "records").unionByName(counted(rejected, "rejected"))


@query(
    "a3_day_spine",
    """WITH spine AS (
      SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS day),
    placed AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(day AS TIMESTAMP) AS day, coalesce(n, 0) AS n FROM spine LEFT JOIN placed USING (day)""",
)
def day_spine(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    ends = orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")).first()
    placed = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    spine = sources.day_spine(spark, str(ends["a"]), str(ends["b"]))
    return spine.join(placed, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "a4_topk_per_day",
    """WITH r AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS period, event_id FROM events WHERE event_type = 'purchase'),
    d AS (SELECT CAST(period AS DATE) AS day, * FROM r
          UNION ALL SELECT CAST(period AS DATE) - 1, * FROM r WHERE hour(period) = 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY period DESC, event_id) AS rn FROM d)
    SELECT CAST(day AS TIMESTAMP) AS day, period, event_id FROM k WHERE rn <= 40""",
)
def topk_per_day(spark, sf_dir):
    readings = table(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").alias("period"), "event_id", F.col("event_type").alias("parent")
    )
    return sources.request_filter(readings, parent="purchase", rows=40).select("day", "period", "event_id")


@query(
    "a4_topk_large_page",
    """WITH r AS (SELECT l_shipdate AS period, l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R'),
    y AS (SELECT CAST(date_trunc('year', period) AS DATE) AS day, * FROM r),
    k AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY period DESC, l_orderkey, l_linenumber, l_partkey) AS rn FROM y)
    SELECT CAST(day AS TIMESTAMP) AS day, period, l_orderkey, l_linenumber, l_partkey FROM k WHERE rn <= 1500""",
)
def topk_large_page(spark, sf_dir):
    """Pages beyond Spark's own group limit: trimmed in shares of a year first."""
    from hourline.operators.ordered import top_n

    rows = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.to_date(F.date_trunc("year", "l_shipdate")).alias("day"),
        F.col("l_shipdate").alias("period"), "l_orderkey", "l_linenumber", "l_partkey",
    )
    order = [F.col("period").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")]
    return top_n(rows, ["day"], order, 1500)


@query(
    "a4_page_requests",
    """WITH r AS (SELECT l_shipdate AS period, l_orderkey, l_linenumber, l_partkey FROM lineitem),
    d AS (SELECT CAST(period AS DATE) AS day, * FROM r UNION ALL SELECT CAST(period AS DATE) - 1, * FROM r),
    k AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY period DESC, l_orderkey, l_linenumber, l_partkey) AS rn FROM d)
    SELECT CAST(day AS TIMESTAMP) AS day, period, l_orderkey, l_linenumber, l_partkey FROM k WHERE rn <= 1500""",
)
def page_requests(spark, sf_dir):
    """Day requests over all line items, pages of 1,500; ship days start at midnight and so answer two requests."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("period"), F.lit(sources.demand.PARENT).alias("parent"), "l_orderkey", "l_linenumber", "l_partkey"
    )
    return sources.request_filter(rows, rows=1500).drop("parent").select("day", "period", "l_orderkey", "l_linenumber", "l_partkey")


@query(
    "a5_refresh_days",
    """WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem),
    m AS (SELECT max(l_shipdate) + INTERVAL 12 HOUR AS as_of FROM lineitem)
    SELECT CAST(day AS TIMESTAMP) AS day, CAST(floor((epoch(as_of) - epoch(CAST(day AS TIMESTAMP))) / 86400) AS BIGINT) AS days_old,
           floor((epoch(as_of) - epoch(CAST(day AS TIMESTAMP))) / 86400) >= 2 AS use_landed FROM d, m""",
)
def refresh_days(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    as_of = newest(items, "l_shipdate") + F.expr("INTERVAL 12 HOURS")
    return sources.refresh_plan(items.select(F.to_date("l_shipdate").alias("day")).distinct(), as_of)


REFRESHED = f"""{RECORDS}, now AS (SELECT max(date) + INTERVAL 36 HOUR AS t FROM hourly),
  aged AS (SELECT r.*, floor((epoch(t) - epoch(day)) / 86400) AS days_old, day(day) % 10 = 0 AS late FROM records r, now)"""


def _refreshed(spark, sf_dir):
    """Every tenth day of a month is missing when the days land; a day and a half after the last hour the source serves
    doubled values and all days."""
    root, ledger = scratch_path(spark, "landed"), scratch_path(spark, "landed-days")
    source = records(spark, sf_dir)
    ends = source.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    spine = sources.day_spine(spark, str(ends["a"]), str(ends["b"]))
    first = newest(hourly(spark, sf_dir))
    plan = sources.days_to_read(spine, sources.landed_days(spark, ledger), first)
    sinks.refresh_landed(source.where(F.dayofmonth("day") % 10 != 0), root, ledger, plan, first)
    doubled = source.withColumn("value", (F.col("value").cast("decimal(18,2)") * 2).cast("string"))
    again = first + F.expr("INTERVAL 36 HOURS")
    plan = sources.days_to_read(spine, sources.landed_days(spark, ledger), again)
    return root, ledger, sinks.refresh_landed(doubled, root, ledger, plan, again)


@query(
    "a5_refresh_landed",
    f"""WITH {REFRESHED} SELECT day, period, subba, CASE WHEN days_old < 2 OR late THEN value * 2 ELSE value END AS value FROM aged""",
)
def refresh_landed(spark, sf_dir):
    """The landed days after unsettled and missing ones were read again."""
    root, _, _ = _refreshed(spark, sf_dir)
    return sources.landed_demand(spark, root).select("day", "period", "subba", F.col("value").cast("double").alias("value"))


@query(
    "a5_refresh_actions",
    f"""WITH {REFRESHED}, spine AS (
      SELECT CAST(unnest(generate_series((SELECT min(day) FROM records), (SELECT max(day) FROM records), INTERVAL 1 DAY)) AS TIMESTAMP) AS day),
    days AS (SELECT day, any_value(late) AS late, count(*) AS n FROM aged GROUP BY 1)
    SELECT s.day, CAST(floor((epoch(t) - epoch(s.day)) / 86400) AS BIGINT) AS days_old,
      CASE WHEN n IS NULL THEN 'none' WHEN late THEN 'landed' WHEN floor((epoch(t) - epoch(s.day)) / 86400) < 2 THEN 'replaced' ELSE 'kept' END AS action,
      CASE WHEN late OR floor((epoch(t) - epoch(s.day)) / 86400) < 2 THEN coalesce(n, 0) ELSE 0 END AS rows
    FROM spine s LEFT JOIN days USING (day), now""",
)
def refresh_actions(spark, sf_dir):
    """What the second run did with every day."""
    return _refreshed(spark, sf_dir)[2]


SLOTS = """means AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS v FROM events GROUP BY 1)"""


@query(
    "a6_array_block",
    f"""WITH {SLOTS}, days AS (SELECT DISTINCT date_trunc('day', date) AS d FROM means),
    slots AS (SELECT CAST(d AS TIMESTAMP) + to_hours(CAST(range AS INTEGER)) AS date FROM days, range(0, 24))
    SELECT s.date, v AS temperature_2m, v AS weather_code, v AS relative_humidity_2m, v AS wind_speed_10m
    FROM slots s LEFT JOIN means USING (date)""",
)
def array_block(spark, sf_dir):
    """One block of 24 slots per day; hours without events are empty slots."""
    means = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("date")).agg(
        mean_of("value").alias("v")
    )
    day = F.date_trunc("day", "date")
    # At most 24 rows per day.
    blocks = means.groupBy(day.alias("d")).agg(F.map_from_entries(F.collect_list(F.struct(F.hour("date"), "v"))).alias("m"))
    slots = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.try_element_at("m", h))
    start = F.unix_timestamp("d")
    blocks = blocks.select(
        start.alias("start"), (start + 86400).alias("end"), F.lit(3600).cast("bigint").alias("interval"),
        *[slots.alias(m) for m in sources.weather.MEASURES],
    )
    return sources.expand_blocks(blocks)


@query(
    "a7_weather_csv",
    f"""WITH {WEATHER} SELECT date, temperature_2m, CAST(NULL AS DOUBLE) AS weather_code,
    CAST(NULL AS DOUBLE) AS relative_humidity_2m, CAST(NULL AS DOUBLE) AS wind_speed_10m FROM weather""",
)
def weather_csv(spark, sf_dir):
    path = scratch_path(spark, "weather-csv")
    empty = F.lit(None).cast("double")
    landed = weather(spark, sf_dir).withColumns({m: empty for m in sources.weather.MEASURES[1:]})
    sinks.write_table(landed, path, "csv")
    return sources.read_weather_csv(spark, path)


@query(
    "a8_source_precedence",
    f"""WITH {WEATHER}, other AS (
      SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS date,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS temperature_2m
      FROM lineitem GROUP BY 1),
    cut AS (SELECT CAST(max(date) - INTERVAL 85 DAY AS DATE) AS c FROM weather),
    both_sides AS (SELECT *, 0 AS r FROM weather, cut WHERE CAST(date AS DATE) <= c
                   UNION ALL SELECT *, 1 FROM other, cut WHERE CAST(date AS DATE) >= c)
    SELECT date, temperature_2m FROM both_sides QUALIFY row_number() OVER (PARTITION BY date ORDER BY r) = 1""",
)
def source_precedence(spark, sf_dir):
    archive = weather(spark, sf_dir)
    forecast = table(spark, sf_dir, "lineitem").groupBy(F.date_trunc("day", "l_shipdate").alias("date")).agg(
        mean_of("l_extendedprice").alias("temperature_2m")
    )
    return sources.combine_sources(archive, forecast, newest(archive))


@query(
    "a9_json_defaults",
    """SELECT event_id,
      CASE WHEN event_type IN ('view', 'click') THEN 10.0 ELSE CAST(props->>'$.k' AS DOUBLE) END AS temperature_2m,
      CASE WHEN event_type = 'error' THEN CAST(props->>'$.k' AS DOUBLE) ELSE 50.0 END AS relative_humidity_2m,
      CAST(0 AS DOUBLE) AS weather_code, CAST(5 AS DOUBLE) AS wind_speed_10m FROM events""",
)
def json_defaults(spark, sf_dir):
    """No document, an empty one, one reading, two readings."""
    k = F.get_json_object("props", "$.k")
    doc = (
        F.when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .when(F.col("event_type") == "click", "{}")
        .when(F.col("event_type") == "error", F.concat(F.lit('{"current": {"temperature_2m": '), k, F.lit(', "relative_humidity_2m": '), k, F.lit("}}")))
        .otherwise(F.concat(F.lit('{"current": {"temperature_2m": '), k, F.lit("}}")))
    )
    docs = table(spark, sf_dir, "events").select("event_id", doc.alias("doc"))
    return sources.current_weather(docs).drop("doc")


@query("a10_csv_table", f"WITH {DAILY} SELECT sub_region_code, date, demand FROM daily")
def csv_table(spark, sf_dir):
    path = scratch_path(spark, "table-csv")
    sinks.write_table(daily(spark, sf_dir), path, "csv")
    return sources.read_table(spark, path, "sub_region_code string, date timestamp, demand double", "csv")


@query(
    "a12_live_else_baseline",
    f"WITH {HOURLY} SELECT sub_region_code, date, demand FROM hourly",
)
def live_else_baseline(spark, sf_dir):
    """A month after the last event the live range of 720 hours is empty, so the whole baseline is used."""
    base = hourly(spark, sf_dir)
    since = newest(base) + F.expr("INTERVAL 30 DAYS")
    return fallback(base.where(F.col("date") >= since), base)


@query(
    "a12_live_first",
    f"WITH {HOURLY} SELECT * FROM hourly WHERE date >= (SELECT max(date) FROM hourly) - INTERVAL 10 DAY",
)
def live_first(spark, sf_dir):
    base = hourly(spark, sf_dir)
    return fallback(base.where(F.col("date") >= newest(base) - F.expr("INTERVAL 10 DAYS")), base)


@query("b3_processed_table", f"WITH {DAILY}, {WEATHER} SELECT sub_region_code, date, demand, temperature_2m, strftime(date, '%Y-%m-%dT%H:%M:%S') AS date_str FROM daily JOIN weather USING (date)")
def processed_table(spark, sf_dir):
    from hourline.operators.joins import enrich_with_weather

    path = scratch_path(spark, "processed")
    merged = enrich_with_weather(daily(spark, sf_dir), weather(spark, sf_dir)).withColumn("date_str", iso_string(F.col("date")))
    sinks.write_table(merged, path)
    return sources.read_table(
        spark, path, "sub_region_code string, date timestamp, demand double, temperature_2m double, date_str string"
    )


@query("b4_sorted_features", f"WITH {DAILY} SELECT sub_region_code, date, demand FROM daily ORDER BY date, sub_region_code")
def sorted_features(spark, sf_dir):
    path = scratch_path(spark, "features")
    sinks.write_features(daily(spark, sf_dir), path)
    return spark.read.parquet(path).orderBy("date", "sub_region_code")


@query("b4_stored_order", f"WITH {DAILY} SELECT count(*) AS n_rows, 0::BIGINT AS out_of_order, 0::BIGINT AS overlapping_files FROM daily")
def stored_order(spark, sf_dir):
    """The order in which the feature table lies, as it is read, without sorting it again."""
    path = scratch_path(spark, "features")
    sinks.write_features(daily(spark, sf_dir), path)
    at = F.struct("date", "sub_region_code")
    rows = spark.read.parquet(path).select(at.alias("at"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    before = F.lag("at").over(Window.partitionBy("file").orderBy("row"))
    files = rows.withColumn("wrong", F.coalesce(before > F.col("at"), F.lit(False))).groupBy("file").agg(
        F.count("*").alias("n"), F.count_if("wrong").alias("wrong"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    # One row per file from here on.
    files = files.withColumn("late", F.coalesce(F.lag("last").over(Window.orderBy("file")) > F.col("first"), F.lit(False)))
    return files.agg(F.sum("n").alias("n_rows"), F.sum("wrong").alias("out_of_order"), F.count_if("late").alias("overlapping_files"))


@query(
    "b5_status_document",
    """SELECT max(CAST(value IS NULL AS INT)) = 0 AND max(CAST(props IS NULL AS INT)) = 0 AS validation_status FROM events""",
)
def status_document(spark, sf_dir):
    path = scratch_path(spark, "status")
    report = quality_report(table(spark, sf_dir, "events"), {"event_id": "int", "value": "float"}, ["value", "props"])
    sinks.write_document(validation_status(report), path)
    return sources.read_document(spark, path, schema.STATUS_DDL)


NAIVE = f"""{DAILY}, naive AS (
  SELECT sub_region_code, date, demand,
         lag(demand, 7) OVER (PARTITION BY sub_region_code ORDER BY date) AS predicted_demand FROM daily),
pairs AS (SELECT * FROM naive WHERE predicted_demand IS NOT NULL)"""


@query(
    "b6_metrics_document",
    f"""WITH {NAIVE} SELECT round(avg((demand - predicted_demand) ** 2), 3) AS mse,
      round(avg(abs(demand - predicted_demand)), 3) AS mae, count(*) AS n_samples FROM pairs""",
)
def metrics_document(spark, sf_dir):
    base = daily(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    pairs = base.join(seasonal_naive(base, 7), ["sub_region_code", "date"])
    sinks.write_document(regression_metrics(pairs, "demand", "predicted_demand"), path)
    read = sources.read_document(spark, path, schema.METRICS_DDL)
    return read.select(F.round("mse", 3).alias("mse"), F.round("mae", 3).alias("mae"), "n_samples")


LINES = """lines AS (SELECT CAST(l_linenumber AS BIGINT) AS sub_region_code, CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS date,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS demand FROM lineitem GROUP BY 1, 2)"""


@query(
    "b8_monitoring_table",
    f"""WITH {LINES}, n AS (SELECT *, lag(demand, 7) OVER (PARTITION BY sub_region_code ORDER BY date) AS predicted_demand FROM lines)
    SELECT sub_region_code, predicted_demand, date, demand FROM n
    WHERE predicted_demand IS NOT NULL AND date BETWEEN (SELECT max(date) FROM lines) - INTERVAL 400 DAY AND (SELECT max(date) FROM lines)""",
)
def monitoring_table(spark, sf_dir):
    """The monitoring job over stored predictions and features of seven series."""
    places = jobs.Locations(scratch_path(spark, "monitoring"))
    base = daily(spark, sf_dir, F.col("l_linenumber").cast("bigint"))
    sinks.write_features(base, places.features)
    sinks.write_table(seasonal_naive(base, 7), places.predictions)
    return jobs.run_monitoring(spark, places, newest(base) + F.expr("INTERVAL 5 HOURS"), days=400)


@query(
    "b7_prediction_history",
    f"""WITH {HOURLY}, n AS (SELECT sub_region_code, date,
      lag(demand, 24) OVER (PARTITION BY sub_region_code ORDER BY date) AS predicted_demand FROM hourly)
    SELECT sub_region_code, date, predicted_demand, date_trunc('day', date)::TIMESTAMP AS day FROM n WHERE predicted_demand IS NOT NULL""",
)
def prediction_history(spark, sf_dir):
    """Two runs append to the history: all but the newest hour, then the newest hour."""
    path = scratch_path(spark, "predictions")
    forecast = seasonal_naive(hourly(spark, sf_dir), 24)
    last = newest(forecast)
    sinks.keep_predictions(forecast.where(F.col("date") < last), path)
    sinks.keep_predictions(forecast.where(F.col("date") >= last), path)
    return spark.read.parquet(path)


@query(
    "b11_run_log",
    f"""WITH {NAIVE} SELECT 'seasonal-naive' AS run, sub_region_code AS step, '7' AS lag,
      round(sqrt(avg((demand - predicted_demand) ** 2)), 3) AS rmse FROM pairs GROUP BY sub_region_code""",
)
def run_log(spark, sf_dir):
    base = daily(spark, sf_dir)
    path = scratch_path(spark, "runs")
    pairs = base.join(seasonal_naive(base, 7), ["sub_region_code", "date"])
    scores = regression_metrics(pairs, "demand", "predicted_demand", ["sub_region_code"])
    rows = scores.select(
        F.lit("seasonal-naive").alias("run"),
        F.col("sub_region_code").alias("step"),
        F.create_map(F.lit("lag"), F.lit("7")).alias("params"),
        F.create_map(F.lit("rmse"), F.col("rmse")).alias("metrics"),
        F.current_timestamp().alias("logged_at"),
    )
    sinks.append_runs(rows, path)
    log = spark.read.schema(schema.RUNS_DDL).parquet(path)
    return log.select("run", "step", F.col("params.lag").alias("lag"), F.round("metrics.rmse", 3).alias("rmse"))


@query(
    "b11_repeated_run",
    f"""WITH {NAIVE}, g AS (SELECT sub_region_code, demand - predicted_demand AS off FROM pairs)
    SELECT run_id, 'seasonal-naive' AS run, sub_region_code AS step, round(sqrt(avg(off ** 2)), 3) AS rmse
    FROM g, (VALUES ('first'), ('second')) v(run_id) GROUP BY 1, 3""",
)
def repeated_run(spark, sf_dir):
    """Two runs of the same name; the first stopped after a part of its rows and was then repeated in full."""
    base = daily(spark, sf_dir)
    path = scratch_path(spark, "logged-runs")
    scored = base.join(seasonal_naive(base, 7), ["sub_region_code", "date"])
    rows = regression_metrics(scored, "demand", "predicted_demand", ["sub_region_code"]).select(
        F.lit("seasonal-naive").alias("run"),
        F.col("sub_region_code").alias("step"),
        F.create_map(F.lit("lag"), F.lit("7")).alias("params"),
        F.create_map(F.lit("rmse"), F.col("rmse")).alias("metrics"),
        F.current_timestamp().alias("logged_at"),
    )
    sinks.log_runs(rows.where("step <> 'R'"), path, "first")
    for run_id in ("second", "first"):
        sinks.log_runs(rows, path, run_id)
    log = spark.read.schema(schema.RUNS_DDL).parquet(path)
    return log.select("run_id", "run", "step", F.round("metrics.rmse", 3).alias("rmse"))


@query(
    "b6_metrics_whole",
    f"""WITH {NAIVE}, e AS (SELECT demand, demand - predicted_demand AS off FROM pairs),
    m AS (SELECT avg(off ** 2) AS mse, avg(abs(off)) AS mae, avg(abs(off) / greatest(abs(demand), 2.220446049250313e-16)) * 100 AS mape,
      1 - sum(off ** 2) / (var_pop(demand) * count(*)) AS r2, count(*) AS n FROM e)
    SELECT round(mse, 3) AS mse, round(mae, 3) AS mae, round(mape, 3) AS mape, round(sqrt(mse), 3) AS rmse, round(r2, 5) AS r2_score,
      round({schema.BASELINE_MAPE}::DOUBLE, 3) AS baseline_mape,
      round(({schema.BASELINE_MAPE} - mape) / {schema.BASELINE_MAPE} * 100, 3) AS forecast_improvement_percent, n AS n_samples FROM m""",
)
def metrics_whole(spark, sf_dir):
    """Every key of the written document."""
    base = daily(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    scored = base.join(seasonal_naive(base, 7), ["sub_region_code", "date"])
    sinks.write_document(regression_metrics(scored, "demand", "predicted_demand"), path)
    read = sources.read_document(spark, path, schema.METRICS_DDL)
    places = {"n_samples": 0, "r2_score": 5}
    return read.select(*[F.round(c, places.get(c, 3)).alias(c) for c in read.columns])


GATED = {"documents": "lang", "events": "value", "orders": "o_totalprice", "embeddings": "label"}


@query(
    "q6_status_gate",
    " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, CASE WHEN avg(CAST({c} IS NULL AS INTEGER)) > 0.05 THEN 'refused' ELSE 'kept' END AS outcome FROM {t}"
        for t, c in GATED.items()
    ),
)
def status_gate(spark, sf_dir):
    """Which tables pass the gate that stops a build when a column misses more than 5 % of its values."""
    outcomes = []
    for name, column in GATED.items():
        df = table(spark, sf_dir, name)
        try:
            require_valid(df, validation_status(quality_report(df, columns=[column])))
            outcomes.append((name, "kept"))
        except ValueError:
            outcomes.append((name, "refused"))
    return spark.createDataFrame(outcomes, "tbl string, outcome string")


@query(
    "j12_strip_zone",
    """SELECT hour(CAST(ts AS TIMESTAMP)) AS wall_hour, 'timestamp_ntz' AS kind, count(*) AS n, min(CAST(ts AS TIMESTAMP)) AS first
    FROM events GROUP BY 1""",
)
def strip_zone(spark, sf_dir):
    """The UTC wall clock stays as it is when the zone goes."""
    stripped = table(spark, sf_dir, "events").select(naive(F.col("ts")).alias("wall"))
    kind = dict(stripped.dtypes)["wall"]
    return stripped.groupBy(F.hour("wall").cast("long").alias("wall_hour")).agg(
        F.lit(kind).alias("kind"), F.count("*").alias("n"), F.min("wall").alias("first")
    )


@query(
    "b12_keyed_upsert",
    f"""WITH {HOURLY}, fresh AS (
      SELECT sub_region_code, date, demand * 2 AS demand FROM hourly WHERE date >= (SELECT max(date) FROM hourly) - INTERVAL 5 DAY)
    SELECT coalesce(f.sub_region_code, h.sub_region_code) AS sub_region_code, coalesce(f.date, h.date) AS date,
           coalesce(f.demand, h.demand) AS demand, date_trunc('day', coalesce(f.date, h.date))::TIMESTAMP AS day
    FROM hourly h FULL JOIN fresh f ON h.sub_region_code = f.sub_region_code AND h.date = f.date""",
)
def keyed_upsert(spark, sf_dir):
    """The last five days arrive again with doubled values."""
    path = scratch_path(spark, "keyed")
    base = hourly(spark, sf_dir)
    keys = ["sub_region_code", "date"]
    sinks.upsert_keyed(base, path, keys)
    fresh = base.where(F.col("date") >= newest(base) - F.expr("INTERVAL 5 DAYS")).withColumn("demand", F.col("demand") * 2)
    return sinks.upsert_keyed(fresh, path, keys)


DOUBLED = """fresh AS (
      SELECT sub_region_code, date, demand * 2 AS demand FROM hourly WHERE date >= (SELECT max(date) FROM hourly) - INTERVAL 5 DAY),
    merged AS (SELECT coalesce(f.sub_region_code, h.sub_region_code) AS sub_region_code, coalesce(f.date, h.date) AS date,
           coalesce(f.demand, h.demand) AS demand
    FROM hourly h FULL JOIN fresh f ON h.sub_region_code = f.sub_region_code AND h.date = f.date)"""


@query("s5_stream_upsert", f"WITH {HOURLY}, {DOUBLED} SELECT *, date_trunc('day', date)::TIMESTAMP AS day FROM merged")
def stream_upsert(spark, sf_dir):
    """All hours arrive, then the last five days with doubled values; then the first batch is sent once more."""
    landing, path, state = (scratch_path(spark, n) for n in ("incoming", "readings", "intake"))
    ddl, keys = "sub_region_code string, date timestamp, demand double", ["sub_region_code", "date"]
    base = hourly(spark, sf_dir)
    base.write.mode("append").parquet(landing)
    streaming.keep_keyed(streaming.read_stream(spark, landing, ddl), path, state, keys)
    fresh = base.where(F.col("date") >= newest(base) - F.expr("INTERVAL 5 DAYS")).withColumn("demand", F.col("demand") * 2)
    fresh.write.mode("append").parquet(landing)
    streaming.keep_keyed(streaming.read_stream(spark, landing, ddl), path, state, keys)
    streaming.keyed_writer(path, f"{state}/ledger", keys)(base, 0)
    return spark.read.parquet(path)


@query(
    "s6_latest_vectors",
    f"""WITH {DAILY}, x AS (
      SELECT sub_region_code, date, CASE WHEN date >= (SELECT max(date) FROM daily) - INTERVAL 5 DAY THEN demand * 2 ELSE demand END AS demand,
        row_number() OVER (PARTITION BY sub_region_code ORDER BY date DESC) AS rn FROM daily)
    SELECT sub_region_code, max(date) AS date, CAST(count(*) AS INTEGER) AS n_lags, sum(demand) AS lag_sum,
      max(CASE WHEN rn = 1 THEN demand END) AS lag_newest, max(CASE WHEN rn = 336 THEN demand END) AS lag_middle,
      max(CASE WHEN rn = 672 THEN demand END) AS lag_oldest
    FROM x WHERE rn <= 672 GROUP BY 1""",
)
def latest_vectors(spark, sf_dir):
    """Days with even numbers arrive first, so that the others are late, and then the last five days with doubled values."""
    landing, path, state = (scratch_path(spark, n) for n in ("incoming", "latest", "latest-state"))
    base = daily(spark, sf_dir)
    even = F.day("date") % 2 == 0
    fresh = base.where(F.col("date") >= newest(base) - F.expr("INTERVAL 5 DAYS")).withColumn("demand", F.col("demand") * 2)
    for part in (base.where(even), base.where(~even), fresh):
        part.write.mode("append").parquet(landing)
        readings = streaming.read_stream(spark, landing, "sub_region_code string, date timestamp, demand double")
        out = streaming.keep_latest(streaming.latest_vectors(readings, 672, covariates=[]), path, state, fold=2)
    return array_scalars(out, 672)


@query("b4_feature_store", f"WITH {HOURLY}, {DOUBLED} SELECT *, date_trunc('day', date)::TIMESTAMP AS day FROM merged")
def feature_store(spark, sf_dir):
    """All hours go into a store by day and bucket, then the last five days arrive again with doubled values."""
    path = scratch_path(spark, "store")
    base = hourly(spark, sf_dir)
    sinks.write_store(base, path)
    fresh = base.where(F.col("date") >= newest(base) - F.expr("INTERVAL 5 DAYS")).withColumn("demand", F.col("demand") * 2)
    return sinks.upsert_store(fresh, path)


@query(
    "e2_stored_actuals",
    f"""WITH {HOURLY}, n AS (SELECT *, lag(demand, 24) OVER (PARTITION BY sub_region_code ORDER BY date) AS predicted_demand FROM hourly)
    SELECT sub_region_code, predicted_demand, date, demand FROM n WHERE predicted_demand IS NOT NULL
      AND date BETWEEN date_trunc('day', (SELECT max(date) FROM hourly)) - INTERVAL 12 DAY AND date_trunc('day', (SELECT max(date) FROM hourly))""",
)
def stored_actuals(spark, sf_dir):
    """Predictions and actuals from two stores of the same buckets: no side is shuffled, only the days of the range are read."""
    actuals, predictions = scratch_path(spark, "actuals"), scratch_path(spark, "predictions")
    base = hourly(spark, sf_dir)
    stored = sinks.write_store(base, actuals)
    predicted = sinks.write_store(seasonal_naive(base, 24), predictions, buckets=sinks.store_buckets(spark, actuals))
    return plans.monitor(predicted, stored, newest(base), days=12)


EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark, sf_dir):
    stream = streaming.read_stream(spark, sf_dir, EVENTS_DDL, glob="events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "s1_stream_dedupe",
    "SELECT DISTINCT event_type AS sub_region_code, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date FROM events",
)
def stream_dedupe(spark, sf_dir):
    readings = event_stream(spark, sf_dir).select(
        F.col("event_type").alias("sub_region_code"), F.date_trunc("hour", "ts").alias("date"), "event_id"
    )
    unique = streaming.drop_duplicate_readings(readings).select("sub_region_code", "date")
    return streaming.drain(unique, "s1")


@query(
    "s2_stream_static",
    f"""WITH {SLOTS} SELECT event_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS date, value AS demand, v AS temperature_2m
    FROM events JOIN means ON date_trunc('hour', ts) = means.date""",
)
def stream_static(spark, sf_dir):
    static = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("date")).agg(
        mean_of("value").alias("temperature_2m")
    )
    readings = event_stream(spark, sf_dir).select(
        "event_id", F.date_trunc("hour", "ts").alias("date"), F.col("value").alias("demand")
    )
    return streaming.drain(streaming.enrich_stream(readings, static), "s2")


@query(
    "s3_stream_join",
    """SELECT l_orderkey AS sub_region_code, l_shipdate AS date, l_extendedprice AS demand, o_totalprice AS predicted_demand
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate = o_orderdate + INTERVAL 30 DAY""",
)
def stream_join(spark, sf_dir):
    """Orders predict a shipment 30 days on; line items are the actuals."""
    items = streaming.read_stream(
        spark, sf_dir, "l_orderkey bigint, l_extendedprice double, l_shipdate timestamp_ntz", glob="lineitem.parquet"
    ).select(
        F.col("l_orderkey").alias("sub_region_code"),
        F.col("l_shipdate").cast("timestamp").alias("date"),
        F.col("l_extendedprice").alias("demand"),
    )
    orders = streaming.read_stream(
        spark, sf_dir, "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz", glob="orders.parquet"
    ).select(
        F.col("o_orderkey").alias("sub_region_code"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 30 DAYS")).alias("date"),
        F.col("o_totalprice").alias("predicted_demand"),
    )
    with streaming.state_on_disk(spark):
        return streaming.drain(streaming.match_predictions(orders, items), "s3")


@query(
    "s4_stream_hourly",
    f"WITH {HOURLY} SELECT * FROM hourly WHERE date + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY",
)
def stream_hourly(spark, sf_dir):
    """Hours the watermark has passed; the last two days stay open, as later events may still join them."""
    readings = event_stream(spark, sf_dir).select(
        F.col("event_type").alias("sub_region_code"), F.col("ts").alias("date"), F.col("value").alias("demand")
    )
    return streaming.drain(streaming.hourly_totals(readings, scale=2), "s4")
