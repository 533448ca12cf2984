"""Drift between the last 29 days and the year before them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from hourline import sinks, sources
from hourline.catalog.common import FEATURES, features, query, table
from hourline.operators import drift, sketches
from hourline.operators.ordered import quantiles
from hourline.plans import detect_drift, roll_drift, roll_summary
from hourline.session import scratch_path, stage

COLUMNS = ["demand", "temperature_2m", "hour", "day_of_week", "month", "is_weekend", "is_holiday"]

PERIODS = f"""{FEATURES}, m AS (SELECT max(date) AS last FROM features),
labelled AS (SELECT * FROM (SELECT f.*, CASE WHEN date BETWEEN last - INTERVAL 365 DAY AND last - INTERVAL 30 DAY THEN 'ref'
    WHEN date >= last - INTERVAL 29 DAY THEN 'cur' END AS period FROM features f, m) WHERE period IS NOT NULL)"""

LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", period, CAST({c} AS DOUBLE) AS x FROM labelled" for c in COLUMNS
) + ")"

COUNTS = f"""{PERIODS}, {LONG},
counts AS (SELECT "column", x, count(*) FILTER (WHERE period = 'ref') AS n_ref, count(*) FILTER (WHERE period = 'cur') AS n_cur
  FROM long GROUP BY 1, 2),
cdf AS (SELECT *, sum(n_ref) OVER (PARTITION BY "column") AS t_ref, sum(n_cur) OVER (PARTITION BY "column") AS t_cur,
    sum(n_ref) OVER (PARTITION BY "column" ORDER BY x) AS c_ref, sum(n_cur) OVER (PARTITION BY "column" ORDER BY x) AS c_cur,
    lead(x) OVER (PARTITION BY "column" ORDER BY x) AS x_next FROM counts),
dev AS (SELECT "column", stddev_pop(x) AS s, count(DISTINCT x) AS d FROM long WHERE period = 'ref' GROUP BY 1),
numeric AS (SELECT "column", sum(abs(c_ref / t_ref - c_cur / t_cur) * coalesce(x_next - x, 0)) AS w,
    max(abs(c_ref / t_ref - c_cur / t_cur)) AS ks FROM cdf GROUP BY 1),
shares AS (SELECT "column", t_ref, t_cur, n_ref, n_cur, n_ref / t_ref AS p, n_cur / t_cur AS q FROM cdf),
js AS (SELECT "column", sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js,
    sum(CASE WHEN n_ref > 0 THEN (n_cur - n_ref * t_cur / t_ref) ** 2 / (n_ref * t_cur / t_ref) ELSE 'inf'::DOUBLE END) AS chi2,
    CAST(max(t_ref) AS BIGINT) AS t_ref, CAST(max(t_cur) AS BIGINT) AS t_cur FROM shares GROUP BY 1)"""


def labelled(spark, sf_dir):
    return drift.label_periods(stage(features(spark, sf_dir), "features"))


def staged_counts(spark, sf_dir):
    return stage(drift.value_counts(labelled(spark, sf_dir), COLUMNS), "value-counts")


@query("l1_periods", f"WITH {PERIODS} SELECT period, sub_region_code, date, demand FROM labelled")
def periods(spark, sf_dir):
    return labelled(spark, sf_dir).select("period", "sub_region_code", "date", "demand")


@query("l2_value_counts", f'WITH {COUNTS} SELECT "column", x, n_ref, n_cur FROM counts')
def value_counts(spark, sf_dir):
    return drift.value_counts(labelled(spark, sf_dir), COLUMNS)


@query(
    "l3_wasserstein",
    f'WITH {COUNTS} SELECT "column", round(w, 5) AS wasserstein, round(w / greatest(s, 0.001), 6) AS wasserstein_normed FROM numeric JOIN dev USING ("column")',
)
def wasserstein(spark, sf_dir):
    out = drift.numeric_distances(staged_counts(spark, sf_dir))
    return out.select("column", F.round("wasserstein", 5).alias("wasserstein"), F.round("wasserstein_normed", 6).alias("wasserstein_normed"))


WHOLE_LONG = "SELECT CASE WHEN l_linestatus = 'O' THEN 'ref' ELSE 'cur' END AS period, l_extendedprice AS x FROM lineitem"


@query(
    "l3_wasserstein_sliced",
    f"""WITH long AS ({WHOLE_LONG}),
    c AS (SELECT x, count(*) FILTER (WHERE period = 'ref') AS r, count(*) FILTER (WHERE period = 'cur') AS u FROM long GROUP BY 1),
    f AS (SELECT x, sum(r) OVER (ORDER BY x) / sum(r) OVER () AS fr, sum(u) OVER (ORDER BY x) / sum(u) OVER () AS fu, lead(x) OVER (ORDER BY x) AS nx FROM c)
    SELECT 'l_extendedprice' AS "column", round(sum(abs(fr - fu) * coalesce(nx - x, 0)), 4) AS wasserstein, round(max(abs(fr - fu)), 6) AS ks FROM f""",
)
def wasserstein_sliced(spark, sf_dir):
    """A column with nearly as many values as rows, its running totals cut into 32 slices."""
    items = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", "ref").otherwise("cur").alias("period"), "l_extendedprice"
    )
    counts = stage(drift.value_counts(items, ["l_extendedprice"]), "value-counts")
    out = drift.numeric_distances(counts, splits=32)
    return out.select("column", F.round("wasserstein", 4).alias("wasserstein"), F.round("ks", 6).alias("ks"))


@query("l4_js", f'WITH {COUNTS} SELECT "column", round(js, 6) AS js_distance FROM js')
def js(spark, sf_dir):
    out = drift.category_distances(staged_counts(spark, sf_dir))
    return out.select("column", F.round("js_distance", 6).alias("js_distance"))


@query(
    "l4_js_text",
    """WITH long AS (SELECT CASE WHEN l_linestatus = 'O' THEN 'ref' ELSE 'cur' END AS period, l_returnflag AS x FROM lineitem),
    c AS (SELECT x, count(*) FILTER (WHERE period = 'ref') AS r, count(*) FILTER (WHERE period = 'cur') AS u FROM long GROUP BY 1),
    s AS (SELECT r / sum(r) OVER () AS p, u / sum(u) OVER () AS q FROM c)
    SELECT 'l_returnflag' AS "column", round(sqrt(sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2), 6) AS js_distance FROM s""",
)
def js_text(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", "ref").otherwise("cur").alias("period"), "l_returnflag"
    )
    out = drift.category_distances(drift.value_counts(items, ["l_returnflag"], "string"))
    return out.select("column", F.round("js_distance", 6).alias("js_distance"))


@query(
    "l5_ks",
    f"""WITH {COUNTS}, lam AS (SELECT "column", ks, sqrt(t_ref::DOUBLE * t_cur / (t_ref + t_cur)) AS root FROM numeric JOIN js USING ("column")),
    l AS (SELECT "column", ks, (root + 0.12 + 0.11 / root) * ks AS lam FROM lam)
    SELECT "column", round(ks, 6) AS ks, round(CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
      2 * list_sum(list_transform(range(1, 101), lambda j: (-1.0) ** (j - 1) * exp(-2 * (j * lam) ** 2))))) END, 6) AS p_value FROM l""",
)
def ks(spark, sf_dir):
    counts = staged_counts(spark, sf_dir)
    sizes = drift.category_distances(counts).select("column", "total_ref", "total_cur", "categories")
    out = drift.numeric_distances(counts).join(sizes, "column")
    p = drift._p_value(F.lit("ks_asymptotic"), F.col("ks"), F.col("total_ref"), F.col("total_cur"), F.col("categories"))
    return out.select("column", F.round("ks", 6).alias("ks"), F.round(p, 6).alias("p_value"))


@query("l5_chi_square", f'WITH {COUNTS} SELECT "column", round(chi2, 4) AS chi2, t_ref AS total_ref, t_cur AS total_cur FROM js')
def chi_square(spark, sf_dir):
    out = drift.category_distances(staged_counts(spark, sf_dir))
    return out.select("column", F.round("chi2", 4).alias("chi2"), "total_ref", "total_cur")


REPORT = f"""{COUNTS}, report AS (
  SELECT "column", CASE WHEN d > 5 THEN 'wasserstein' ELSE 'jensenshannon' END AS method,
    CASE WHEN d > 5 THEN w / greatest(s, 0.001) ELSE js END AS score FROM numeric JOIN js USING ("column") JOIN dev USING ("column"))"""


@query(
    "l6_drift_report",
    f'WITH {REPORT} SELECT "column", method, round(score, 6) AS score, score >= 0.1 AS drifted FROM report',
)
def report(spark, sf_dir):
    """The tests for large references, whatever the size."""
    out = drift.drift_report(labelled(spark, sf_dir).drop("sub_region_code", "date"), tests="distance")
    return out.select("column", "method", F.round("score", 6).alias("score"), "drifted")


def full_report(small: str) -> str:
    """The report with the choice of tests by size; ``small`` is the largest size that counts as small."""
    return f"""{COUNTS}, first AS (SELECT "column", min_by(n_ref, x) AS a, min_by(n_cur, x) AS b, sum(n_ref)::DOUBLE AS n1, sum(n_cur)::DOUBLE AS n2
      FROM counts GROUP BY 1),
    ztest AS (SELECT "column", (a + b) / (n1 + n2) AS pooled, coalesce((a / n1 - b / n2)
      / nullif(sqrt((a + b) / (n1 + n2) * (1 - (a + b) / (n1 + n2)) * (1 / n1 + 1 / n2)), 0), 0) AS z FROM first),
    picked AS (SELECT "column", t_ref AS n_ref, t_cur AS n_cur, js, chi2, ks, z, w / greatest(s, 0.001) AS wn,
      sqrt(t_ref::DOUBLE * t_cur / (t_ref + t_cur)) AS root,
      CASE WHEN t_ref > {small} AND d > 5 THEN 'wasserstein' WHEN t_ref > {small} THEN 'jensenshannon'
        WHEN d > 5 THEN 'ks' WHEN d > 2 THEN 'chisquare' ELSE 'z' END AS method
      FROM numeric JOIN js USING ("column") JOIN dev USING ("column") JOIN ztest USING ("column")),
    full_report AS (SELECT "column", method, n_ref, n_cur,
      round(CASE method WHEN 'wasserstein' THEN wn WHEN 'jensenshannon' THEN js WHEN 'ks' THEN ks WHEN 'chisquare' THEN chi2 ELSE z END, 6) AS statistic,
      CASE method WHEN 'wasserstein' THEN wn >= 0.1 WHEN 'jensenshannon' THEN js >= 0.1
        WHEN 'ks' THEN 2 * list_sum(list_transform(range(1, 101), lambda j: (-1.0) ** (j - 1) * exp(-2 * (j * greatest(0.2, (root + 0.12 + 0.11 / root) * ks)) ** 2))) < 0.05
        WHEN 'z' THEN abs(z) > 1.959963984540054 END AS drifted FROM picked)"""


@query("l5_small_reference_report", f"""WITH {full_report("1e18")} SELECT "column", method, statistic, drifted FROM full_report""")
def small_reference_report(spark, sf_dir):
    """The tests for small references, whatever the size: p-values instead of distances."""
    out = drift.drift_report(labelled(spark, sf_dir).drop("sub_region_code", "date"), tests="p_value")
    return out.select("column", "method", F.round("statistic", 6).alias("statistic"), "drifted")


@query(
    "l7_dataset_drift",
    f"""WITH {REPORT} SELECT count(*) AS number_of_columns, count(*) FILTER (WHERE score >= 0.1) AS number_of_drifted_columns,
      round(avg(CAST(score >= 0.1 AS INT)), 6) AS share_of_drifted_columns, avg(CAST(score >= 0.1 AS INT)) >= 0.5 AS dataset_drift FROM report""",
)
def dataset(spark, sf_dir):
    full = drift.drift_report(labelled(spark, sf_dir).drop("sub_region_code", "date"), tests="distance")
    return drift.dataset_drift(full).withColumn("share_of_drifted_columns", F.round("share_of_drifted_columns", 6))


def _days(spark, sf_dir):
    rows = stage(features(spark, sf_dir), "features")
    last = rows.agg(F.to_date(F.max("date"))).first()[0]
    return rows, last


@query("l8_rolled_counts", f'WITH {COUNTS} SELECT "column", x, n_ref, n_cur FROM counts')
def rolled_counts(spark, sf_dir):
    """Value counts of the periods a day, then forty days, before the newest one, moved on to it by daily counts."""
    rows, last = _days(spark, sf_dir)
    daily = stage(drift.daily_counts(rows, COLUMNS), "daily-counts")
    day = lambda n: str(last - timedelta(days=n))
    counts = drift.period_counts(daily, day(41))
    for before, after in ((41, 1), (1, 0)):
        counts = stage(drift.roll_counts(counts, daily, day(before), day(after)), "period-counts")
    return counts


@query("l8_rolled_report", f'WITH {REPORT} SELECT "column", method, round(score, 6) AS score, score >= 0.1 AS drifted FROM report')
def rolled_report(spark, sf_dir):
    """The report as of the day before, kept, then moved on with the rows of the newest day alone."""
    rows, last = _days(spark, sf_dir)
    root = scratch_path(spark, "drift-days")
    newest_day = F.to_date("date") == F.lit(last)
    roll_drift(spark, rows.where(~newest_day), COLUMNS, root, str(last - timedelta(days=1)))
    out = roll_drift(spark, rows.where(newest_day), COLUMNS, root, str(last))
    return out.select("column", "method", F.round("score", 6).alias("score"), "drifted")


SUMMARY = """SELECT period, count(*) AS n_values, 0::BIGINT AS n_missing, count(DISTINCT demand) AS n_distinct, min(demand) AS min,
  round(quantile_cont(demand, 0.25), 6) AS p25, round(quantile_cont(demand, 0.5), 6) AS p50, round(quantile_cont(demand, 0.75), 6) AS p75,
  max(demand) AS max, round(avg(demand), 6) AS mean, round(stddev_samp(demand), 6) AS stddev FROM labelled GROUP BY 1"""


@query(
    "f10_summary",
    f"""WITH {PERIODS}, s AS ({SUMMARY}), c AS (SELECT period, demand, count(*) AS n FROM labelled GROUP BY 1, 2),
    t AS (SELECT period, demand AS most_common, n AS most_common_count FROM c
          QUALIFY row_number() OVER (PARTITION BY period ORDER BY n DESC, demand) = 1)
    SELECT * FROM s JOIN t USING (period)""",
)
def summary(spark, sf_dir):
    out = drift.column_summary(labelled(spark, sf_dir), "demand")
    return out.withColumns({c: F.round(c, 6) for c in ("p25", "p50", "p75", "mean", "stddev")})


@query(
    "f10_quantiles_sliced",
    """SELECT p, round(quantile_cont(l_extendedprice, p), 6) AS quantile FROM lineitem, (VALUES (0.25), (0.5), (0.75)) t(p) GROUP BY p"""
    .replace("quantile_cont(l_extendedprice, p)", "CASE p WHEN 0.25 THEN quantile_cont(l_extendedprice, 0.25) WHEN 0.5 THEN quantile_cont(l_extendedprice, 0.5) ELSE quantile_cont(l_extendedprice, 0.75) END")
    .replace("SELECT p,", "SELECT CAST(p AS DOUBLE) AS p,"),
)
def quantiles_sliced(spark, sf_dir):
    """Exact quantiles over whole prices from running counts."""
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_extendedprice").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "price-counts")
    return quantiles(counts, "x", "n", [0.25, 0.5, 0.75]).withColumn("quantile", F.round("quantile", 6))


SKETCHED = ["l_extendedprice", "l_quantity"]


@query(
    "f10_sketched_summary",
    """WITH m AS (SELECT CAST(max(l_shipdate) AS DATE) AS last FROM lineitem),
    labelled AS (SELECT CASE WHEN last - CAST(l_shipdate AS DATE) >= 30 THEN 'ref' ELSE 'cur' END AS period, l_extendedprice, l_quantity
      FROM lineitem, m),
    long AS ("""
    + " UNION ALL ".join(f"""SELECT period, '{c}' AS "column", CAST({c} AS DOUBLE) AS x FROM labelled""" for c in SKETCHED)
    + """)
    SELECT period, "column", count(x) AS n_values, count(*) - count(x) AS n_missing, min(x) AS min, max(x) AS max, round(avg(x), 4) AS mean,
      round(stddev_samp(x), 4) AS stddev, true AS quartiles_within, true AS distinct_within FROM long GROUP BY 1, 2""",
)
def sketched_summary(spark, sf_dir):
    """Prices and quantities by ship day: all but the newest day kept as sketches, then the newest day added.

    The estimates are held against the exact ranks and counts: quartiles within twice the stated rank error, numbers of
    different values within four standard errors.
    """
    items = table(spark, sf_dir, "lineitem").select("l_shipdate", *SKETCHED)
    last = items.agg(F.to_date(F.max("l_shipdate"))).first()[0]
    newest_day = F.to_date("l_shipdate") == F.lit(last)
    root, span = scratch_path(spark, "sketches"), {"time": "l_shipdate", "reference_days": 20_000}
    roll_summary(spark, items.where(~newest_day), SKETCHED, root, str(last - timedelta(days=1)), **span)
    found = stage(roll_summary(spark, items.where(newest_day), SKETCHED, root, str(last), **span), "sketched-summary")
    labelled = items.withColumn("period", drift.period_of(F.to_date("l_shipdate"), str(last), 20_000, 30, 29))
    gaps = sketches.rank_gaps(found, labelled, SKETCHED).groupBy("period", "column").agg(F.max("gap").alias("gap"))
    long = labelled.unpivot("period", [F.col(c).cast("double").alias(c) for c in SKETCHED], "column", "x")
    exact = long.groupBy("period", "column").agg(F.countDistinct("x").alias("exact"))
    checked = found.join(gaps, ["period", "column"], "left").join(exact, ["period", "column"])
    return checked.select(
        "period", "column", "n_values", "n_missing", "min", "max", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
        (F.col("gap") <= 2 * sketches.rank_error()).alias("quartiles_within"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 4 * sketches.distinct_error() * F.col("exact") + 1).alias("distinct_within"),
    )


@query(
    "b9_drift_document",
    f"""WITH {REPORT} SELECT count(*) AS number_of_columns, count(*) FILTER (WHERE score >= 0.1) AS number_of_drifted_columns FROM report""",
)
def drift_document(spark, sf_dir):
    return _written_document(spark, sf_dir).select("number_of_columns", "number_of_drifted_columns")


@query(
    "b9_document_columns",
    f"""WITH {REPORT} SELECT "column", method, round(score, 6) AS score, 0.1::DOUBLE AS threshold, score >= 0.1 AS drifted FROM report""",
)
def document_columns(spark, sf_dir):
    """Every column's entry as the written document holds it."""
    found = _written_document(spark, sf_dir).select(F.inline("columns"))
    return found.select("column", "method", F.round("score", 6).alias("score"), "threshold", "drifted")


@query(
    "b9_document_summary",
    f"""WITH {PERIODS}, s AS ({SUMMARY}), c AS (SELECT period, demand, count(*) AS n FROM labelled GROUP BY 1, 2),
    t AS (SELECT period, demand AS most_common, n AS most_common_count FROM c
          QUALIFY row_number() OVER (PARTITION BY period ORDER BY n DESC, demand) = 1)
    SELECT * FROM s JOIN t USING (period)""",
)
def document_summary(spark, sf_dir):
    """The summary of both periods as the written document holds it."""
    found = _written_document(spark, sf_dir).select(F.inline("summary"))
    return found.withColumns({c: F.round(c, 6) for c in ("p25", "p50", "p75", "mean", "stddev")})


def _written_document(spark, sf_dir):
    path = scratch_path(spark, "drift")
    labelled_rows = labelled(spark, sf_dir)
    full = stage(drift.drift_report(labelled_rows.drop("sub_region_code", "date"), tests="distance"), "drift-report")
    sinks.write_document(drift.drift_document(full, drift.column_summary(labelled_rows, "demand")), path)
    return sources.read_document(spark, path)


@query("drift_run", f"""WITH {full_report("1000")} SELECT "column", method, statistic, drifted, n_ref, n_cur FROM full_report""")
def drift_run(spark, sf_dir):
    """The whole drift run with the default choice of tests."""
    stored = stage(features(spark, sf_dir).drop("sub_region_code"), "features")
    _, full, _ = detect_drift(stored, tests="by_size")
    return full.select("column", "method", F.round("statistic", 6).alias("statistic"), "drifted", "n_ref", "n_cur")
