"""Aggregates, metrics, monitoring, top lists and presentation data."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline.catalog.common import DAILY, daily, query, table
from hourline.catalog.cleaning import ZONE_LIST
from hourline.functions import color_scale, exact_sum
from hourline.operators import present, profile
from hourline.operators.clean import newest
from hourline.operators.joins import predictions_vs_actuals
from hourline.operators.metrics import regression_cube, regression_metrics
from hourline.operators.windows import seasonal_naive
from hourline.plans import monitor, monitoring_errors

NAIVE = f"""{DAILY}, naive AS (
  SELECT sub_region_code, date, demand,
         lag(demand, 7) OVER (PARTITION BY sub_region_code ORDER BY date) AS predicted_demand FROM daily),
pairs AS (SELECT * FROM naive WHERE predicted_demand IS NOT NULL)"""

METRICS = """round(avg((demand - predicted_demand) ** 2), 3) AS mse, round(avg(abs(demand - predicted_demand)), 4) AS mae,
  round(avg(abs(demand - predicted_demand) / greatest(abs(demand), 2.220446049250313e-16)) * 100, 4) AS mape,
  round(sqrt(avg((demand - predicted_demand) ** 2)), 4) AS rmse,
  round(1 - sum((demand - predicted_demand) ** 2) / (var_pop(demand) * count(*)), 6) AS r2_score"""


def pairs(spark, sf_dir):
    base = daily(spark, sf_dir)
    return predictions_vs_actuals(seasonal_naive(base, 7), base)


def rounded(df):
    digits = {"mse": 3, "mae": 4, "mape": 4, "rmse": 4, "r2_score": 6, "forecast_improvement_percent": 3}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items() if c in df.columns})


@query("e2_pred_actual", f"WITH {NAIVE} SELECT sub_region_code, date, predicted_demand, demand FROM pairs")
def pred_actual(spark, sf_dir):
    return pairs(spark, sf_dir)


@query("f4_metrics", f"WITH {NAIVE} SELECT {METRICS}, count(*) AS n_samples FROM pairs")
def metrics(spark, sf_dir):
    out = regression_metrics(pairs(spark, sf_dir), "demand", "predicted_demand")
    return rounded(out).drop("baseline_mape", "forecast_improvement_percent")


@query(
    "f4_metrics_by_zone",
    f"WITH {NAIVE} SELECT sub_region_code, {METRICS}, count(*) AS n_samples FROM pairs GROUP BY 1",
)
def metrics_by_zone(spark, sf_dir):
    out = regression_metrics(pairs(spark, sf_dir), "demand", "predicted_demand", ["sub_region_code"])
    return rounded(out).drop("baseline_mape", "forecast_improvement_percent")


@query(
    "f4_rollup",
    f"""WITH {NAIVE}, m AS (SELECT *, CAST(month(date) AS BIGINT) AS month FROM pairs)
    SELECT sub_region_code, month, CAST(GROUPING_ID(sub_region_code, month) AS BIGINT) AS grouping_id, {METRICS}, count(*) AS n_samples
    FROM m GROUP BY CUBE (sub_region_code, month)""",
)
def metrics_cube(spark, sf_dir):
    """Errors by zone and month, by zone, by month and over all."""
    by_month = pairs(spark, sf_dir).withColumn("month", F.month("date").cast("bigint"))
    out = regression_cube(by_month, "demand", "predicted_demand", ["sub_region_code", "month"])
    return rounded(out).drop("baseline_mape", "forecast_improvement_percent")


@query(
    "f5_improvement",
    f"""WITH {NAIVE}, m AS (SELECT avg(abs(demand - predicted_demand) / greatest(abs(demand), 2.220446049250313e-16)) * 100 AS mape, count(*) AS n FROM pairs)
    SELECT CAST(10 AS DOUBLE) AS baseline_mape, round((10 - mape) / 10 * 100, 3) AS forecast_improvement_percent, n AS n_samples FROM m""",
)
def improvement(spark, sf_dir):
    out = rounded(regression_metrics(pairs(spark, sf_dir), "demand", "predicted_demand"))
    return out.select("baseline_mape", "forecast_improvement_percent", "n_samples")


@query("f2_date_bounds", f"WITH {DAILY} SELECT min(date) AS first, max(date) AS last FROM daily")
def date_bounds(spark, sf_dir):
    return profile.date_bounds(table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("f3_distinct_zones", "SELECT DISTINCT event_type AS sub_region_code FROM events")
def distinct_zones(spark, sf_dir):
    return profile.distinct_keys(table(spark, sf_dir, "events").withColumnRenamed("event_type", "sub_region_code"))


@query(
    "f9_table_profile",
    """SELECT count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns, min(ts) AS first, max(ts) AS last,
      count(DISTINCT event_type) AS n_zones FROM events""",
)
def table_profile(spark, sf_dir):
    return profile.table_profile(table(spark, sf_dir, "events"), "event_type", "ts")


@query(
    "f9_profile_by_month",
    """SELECT CAST(date_trunc('month', ts) AS TIMESTAMP) AS month, count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns, min(ts) AS first,
      max(ts) AS last, count(DISTINCT user_id) AS n_zones FROM events GROUP BY 1""",
)
def profile_by_month(spark, sf_dir):
    """Each month's rows and users."""
    months = profile.table_profile(table(spark, sf_dir, "events"), "user_id", "ts", by=[F.date_trunc("month", "ts")])
    return months.withColumnRenamed("_by0", "month")


@query(
    "h6_sorted_codes",
    """SELECT CAST(c_nationkey AS BIGINT) AS sub_region_code FROM customer
    INTERSECT SELECT CAST(s_nationkey AS BIGINT) FROM supplier ORDER BY 1""",
)
def sorted_codes(spark, sf_dir):
    from hourline.operators.clean import common_codes

    code = lambda name, column: table(spark, sf_dir, name).select(F.col(column).cast("bigint").alias("sub_region_code"))
    return common_codes(code("customer", "c_nationkey"), code("supplier", "s_nationkey")).orderBy("sub_region_code")


PREDICTED = """predicted AS (SELECT CAST(c_nationkey AS BIGINT) AS sub_region_code,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS predicted_demand FROM customer GROUP BY 1)"""


def predicted(spark, sf_dir):
    """One value per code, some of which have no zone."""
    return table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("bigint").alias("sub_region_code")).agg(
        exact_sum(F.col("c_acctbal"), 2).alias("predicted_demand")
    )


@query(
    "f8_argmax",
    f"""WITH {PREDICTED} SELECT sub_region_code, predicted_demand, coalesce(name, 'Zone ' || sub_region_code) AS zone_name
    FROM predicted LEFT JOIN {ZONE_LIST} ON sub_region_code = code ORDER BY predicted_demand DESC, sub_region_code LIMIT 1""",
)
def argmax(spark, sf_dir):
    return present.peak_zone(predicted(spark, sf_dir)).select("sub_region_code", "predicted_demand", "zone_name")


@query(
    "h3_topk",
    f"WITH {PREDICTED} SELECT sub_region_code, predicted_demand, CAST(trunc(predicted_demand) AS BIGINT) AS whole_mw FROM predicted ORDER BY predicted_demand DESC, sub_region_code LIMIT 6",
)
def topk(spark, sf_dir):
    return present.top_zones(predicted(spark, sf_dir))


@query(
    "h2_zone_date_order",
    f"WITH {DAILY} SELECT sub_region_code, date, demand FROM daily ORDER BY sub_region_code, date",
)
def zone_date_order(spark, sf_dir):
    return profile.by_series(daily(spark, sf_dir))


@query(
    "h4_tail_rows",
    f"WITH {DAILY} SELECT sub_region_code, date, demand FROM daily ORDER BY date DESC, sub_region_code DESC LIMIT 250",
)
def tail_rows(spark, sf_dir):
    from hourline.operators.clean import tail_rows as tail

    return tail(daily(spark, sf_dir), 250)


@query(
    "c13_response_items",
    f"""WITH {PREDICTED}, m AS (SELECT max(o_orderdate) AS d FROM orders)
    SELECT CAST(sub_region_code AS INTEGER) AS sub_region_code, coalesce(name, 'Zone ' || sub_region_code) AS zone_name,
      predicted_demand AS predicted_demand_mw, strftime(d, '%Y-%m-%d %H:%M:%S') || 'Z' AS date
    FROM predicted, m LEFT JOIN {ZONE_LIST} ON sub_region_code = code""",
)
def response_items(spark, sf_dir):
    stamp = newest(table(spark, sf_dir, "orders"), "o_orderdate")
    return present.response_items(predicted(spark, sf_dir).withColumn("date", stamp))


@query(
    "c14_color_scale",
    """WITH m AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer),
    s AS (SELECT c_custkey, (c_acctbal - lo) / (hi - lo) AS f FROM customer, m)
    SELECT c_custkey, CAST(trunc(f * 255) AS INTEGER) AS red, CAST(trunc((1 - f) * 200) AS INTEGER) AS green,
      CAST(50 AS INTEGER) AS blue, CAST(200 AS INTEGER) AS alpha FROM s""",
)
def color(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    bounds = c.agg(F.struct(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))).scalar()
    rgba = c.withColumn("b", bounds).withColumn("rgba", color_scale(F.col("c_acctbal"), F.col("b.lo"), F.col("b.hi")))
    return rgba.select("c_custkey", *[F.col("rgba")[i].alias(n) for i, n in enumerate(["red", "green", "blue", "alpha"])])


@query(
    "c15_map_points",
    f"""WITH {PREDICTED}, m AS (SELECT min(predicted_demand) AS lo, max(predicted_demand) AS hi FROM predicted)
    SELECT sub_region_code, coalesce(name, 'Zone ' || sub_region_code) AS zone_name, coalesce(CAST(lat AS DOUBLE), 42.0) AS latitude,
      predicted_demand * 5 AS radius, CAST(trunc(CASE WHEN hi <> lo THEN (predicted_demand - lo) / (hi - lo) ELSE 0.5 END * 255) AS INTEGER) AS red
    FROM predicted, m LEFT JOIN {ZONE_LIST} ON sub_region_code = code""",
)
def map_points(spark, sf_dir):
    out = present.map_points(predicted(spark, sf_dir))
    return out.select("sub_region_code", "zone_name", "latitude", "radius", F.col("fill_color")[0].alias("red"))


@query(
    "f13_best_candidate",
    """WITH s AS (SELECT o_orderpriority AS family, CAST(dayofweek(o_orderdate) AS INTEGER) AS candidate,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS rmse
      FROM orders GROUP BY o_orderpriority, dayofweek(o_orderdate), month(o_orderdate)),
    m AS (SELECT candidate, family, round(avg(rmse), 4) AS mean_rmse FROM s GROUP BY 1, 2)
    SELECT candidate, family, mean_rmse FROM m ORDER BY mean_rmse, candidate LIMIT 1""",
)
def best_candidate(spark, sf_dir):
    """The scoring table shape with months as folds."""
    from hourline.operators.learn import best_candidate as best

    scores = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("family"),
        (F.dayofweek("o_orderdate") - 1).alias("candidate"),
        F.month("o_orderdate").alias("fold"),
    ).agg((exact_sum(F.col("o_totalprice"), 2) / F.count(F.lit(1))).alias("rmse"))
    won = best(scores.withColumn("params", F.lit("{}")))
    return won.select("candidate", "family", F.round("mean_rmse", 4).alias("mean_rmse"))


@query(
    "b11_tuning_log",
    """WITH s AS (SELECT o_orderpriority AS family, CAST(dayofweek(o_orderdate) AS INTEGER) AS candidate,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS rmse
      FROM orders GROUP BY o_orderpriority, dayofweek(o_orderdate), month(o_orderdate)),
    m AS (SELECT family, candidate, avg(rmse) AS mean FROM s GROUP BY 1, 2)
    SELECT family, candidate, round(mean, 4) AS cv_best_rmse FROM m
    QUALIFY row_number() OVER (PARTITION BY family ORDER BY mean, candidate) = 1""",
)
def tuning_log(spark, sf_dir):
    """What the training job logs per family, from the same shape of scores."""
    from hourline.operators.learn import best_per_family

    scores = table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("family"),
        (F.dayofweek("o_orderdate") - 1).alias("candidate"),
        F.month("o_orderdate").alias("fold"),
    ).agg((exact_sum(F.col("o_totalprice"), 2) / F.count(F.lit(1))).alias("rmse"))
    best = best_per_family(scores.withColumn("params", F.lit("{}")))
    return best.select("family", "candidate", F.round("cv_best_rmse", 4).alias("cv_best_rmse"))


@query(
    "z12_monitoring",
    f"""WITH {NAIVE}, m AS (SELECT max(date) AS today FROM daily)
    SELECT sub_region_code, predicted_demand, date, demand FROM pairs, m WHERE date BETWEEN today - INTERVAL 1 DAY AND today""",
)
def monitoring(spark, sf_dir):
    base = daily(spark, sf_dir)
    return monitor(seasonal_naive(base, 7), base, newest(base) + F.expr("INTERVAL 15 HOURS"))


@query(
    "z13_monitoring_errors",
    f"""WITH {NAIVE}, m AS (SELECT max(date) AS today FROM daily)
    SELECT sub_region_code, {METRICS}, count(*) AS n_samples FROM pairs, m WHERE date BETWEEN today - INTERVAL 60 DAY AND today GROUP BY 1""",
)
def errors(spark, sf_dir):
    base = daily(spark, sf_dir)
    monitored = monitor(seasonal_naive(base, 7), base, newest(base), days=60)
    return rounded(monitoring_errors(monitored)).drop("baseline_mape", "forecast_improvement_percent")


@query(
    "f14_matched_zones",
    """SELECT count(*) AS n FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)""",
)
def matched_zones(spark, sf_dir):
    from hourline.operators.clean import common_codes

    code = lambda name, column: table(spark, sf_dir, name).select(F.col(column).alias("sub_region_code"))
    return common_codes(code("customer", "c_nationkey"), code("supplier", "s_nationkey")).agg(F.count(F.lit(1)).alias("n"))
