"""Distribution drift between a baseline and a current period.

All tests start from one table of value counts per column: the raw rows are read once, a value that fills a third of
the table is a single row after the map-side combine, and every statistic is then a sum over counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline import schema
from hourline.operators.clean import newest
from hourline.operators.ordered import quantiles, running_totals
from hourline.session import stage

# Fixed values of the default tests.
SMALL_REFERENCE = 1000
FEW_VALUES = 5
EXACT_SIZE = 10_000
DISTANCE_LIMIT = 0.1
P_LIMIT = 0.05
MIN_SCALE = 0.001
DATASET_SHARE = 0.5

NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}


def label_periods(
    df: DataFrame,
    time: str = schema.TIME,
    reference_days: int = 365,
    gap_days: int = 30,
    current_days: int = 29,
    whole_days: bool = False,
) -> DataFrame:
    """Add ``period``: ``ref`` for [max−365d, max−30d], ``cur`` for [max−29d, max]; rows in neither are left out.

    With ``whole_days`` the times are days, so that a day lies in one period or in none.
    """
    last = newest(df, time)
    days = lambda n: F.make_dt_interval(F.lit(n))
    at = F.col(time)
    if whole_days:
        at, last = F.date_trunc("day", at), F.date_trunc("day", last)
    period = F.when(at.between(last - days(reference_days), last - days(gap_days)), "ref").when(
        at >= last - days(current_days), "cur"
    )
    return df.withColumn("period", period).where(F.col("period").isNotNull())


def typed_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and text columns; timestamps take no part."""
    numeric = [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]
    return numeric, [c for c, t in df.dtypes if t == "string" and c not in ("date_str", "period")]


def value_counts(df: DataFrame, columns: list[str], kind: str = "double") -> DataFrame:
    """(column, x, n_ref, n_cur) over the labelled table; missing and infinite values are left out."""
    x = F.col("x")
    usable = x.isNotNull()
    if kind == "double":
        usable = usable & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    long = df.select("period", *[F.col(c).cast(kind).alias(c) for c in columns]).unpivot("period", columns, "column", "x")
    return (
        long.where(usable)
        .groupBy("column", "x")
        .agg(
            F.count_if(F.col("period") == "ref").alias("n_ref"),
            F.count_if(F.col("period") == "cur").alias("n_cur"),
        )
    )


def daily_counts(df: DataFrame, columns: list[str], time: str = schema.TIME, kind: str = "double") -> DataFrame:
    """(day, column, x, n): the value counts of every day; missing and infinite values are left out.

    Counts of days add up to the counts of any period of whole days, so that a period that moves on needs the days that
    enter and leave it and no rows.
    """
    days = df.withColumn("day", F.to_date(time)).where(F.col("day").isNotNull())
    long = days.select("day", *[F.col(c).cast(kind).alias(c) for c in columns]).unpivot("day", columns, "column", "x")
    usable = F.col("x").isNotNull()
    if kind == "double":
        usable = usable & ~F.isnan("x") & (F.abs("x") != F.lit(float("inf")))
    return long.where(usable).groupBy("day", "column", "x").agg(F.count("*").alias("n"))


def period_of(day: Column, last: str, reference_days: int, gap_days: int, current_days: int) -> Column:
    age = F.date_diff(F.lit(last).cast("date"), day)
    return F.when(age.between(gap_days, reference_days), "ref").when(age.between(0, current_days), "cur")


def period_counts(daily: DataFrame, last: str, reference_days: int = 365, gap_days: int = 30, current_days: int = 29) -> DataFrame:
    """(column, x, n_ref, n_cur) of the two periods that end with the day ``last``, summed over daily counts."""
    in_range = F.col("day").between(F.date_sub(F.lit(last).cast("date"), reference_days), F.lit(last).cast("date"))
    return _signed(daily.where(in_range), period_of(F.col("day"), last, reference_days, gap_days, current_days), F.lit(None))


def roll_counts(
    counts: DataFrame, daily: DataFrame, before: str, last: str, reference_days: int = 365, gap_days: int = 30, current_days: int = 29
) -> DataFrame:
    """The period counts that end with ``last``, from those that ended with ``before``: days that enter a period are added,
    days that leave it taken off. Only those days' counts are read, as many at each end of a period as it moved on by."""
    old, new = (period_of(F.col("day"), d, reference_days, gap_days, current_days) for d in (before, last))
    # The days that changed, as ranges that reach the scan: at each end of a period those it moved over, either way.
    moved = lambda n, by: F.col("day").between(F.date_sub(F.least(a, b), n + by), F.date_sub(F.greatest(a, b), n))
    a, b = F.lit(before).cast("date"), F.lit(last).cast("date")
    near = moved(reference_days, 1) | moved(gap_days, 1) | moved(current_days, 1) | moved(-1, 1)
    changed = daily.where(near).where(~old.eqNullSafe(new))
    delta = _signed(changed, new, old)
    both = counts.select("column", "x", "n_ref", "n_cur").unionByName(delta)
    summed = both.groupBy("column", "x").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    return summed.where("n_ref <> 0 OR n_cur <> 0")


def _signed(daily: DataFrame, entered: Column, left: Column) -> DataFrame:
    """Counts of the days by the period they have entered, less those by the period they have left."""
    n = F.col("n")
    part = lambda p: F.sum(F.when(entered == p, n).otherwise(0) - F.when(left == p, n).otherwise(0))
    out = daily.groupBy("column", "x").agg(part("ref").cast("long").alias("n_ref"), part("cur").cast("long").alias("n_cur"))
    return out.where("n_ref <> 0 OR n_cur <> 0")


def _with_totals(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("column").agg(
        F.sum("n_ref").alias("total_ref"),
        F.sum("n_cur").alias("total_cur"),
        F.count_if(F.col("n_ref") > 0).alias("distinct_ref"),
        F.min("x").alias("x_least"),
    )
    # One row per column of the table.
    return counts.join(F.broadcast(totals), "column")


def _share(n: str, total: str) -> Column:
    return F.col(n) / F.nullif(F.col(total), F.lit(0))


def category_distances(counts: DataFrame) -> DataFrame:
    """Per column: Jensen–Shannon distance of the value shares, chi-square and two-proportion statistics."""
    p, q = _share("n_ref", "total_ref"), _share("n_cur", "total_cur")
    half = (p + q) / 2
    kl = lambda a: F.when(a > 0, a * F.ln(a / half)).otherwise(F.lit(0.0))
    expected = F.col("n_ref") * (F.col("total_cur") / F.nullif(F.col("total_ref"), F.lit(0)))
    miss = F.col("n_cur") - expected
    chi2 = F.when(expected > 0, miss * miss / F.nullif(expected, F.lit(0.0))).otherwise(F.lit(float("inf")))
    is_least = F.col("x") == F.col("x_least")
    by_column = _with_totals(counts).groupBy("column", "total_ref", "total_cur", "distinct_ref").agg(
        F.sqrt(F.greatest(F.sum((kl(p) + kl(q)) / 2), F.lit(0.0))).alias("js_distance"),
        F.sum(chi2).alias("chi2"),
        F.count(F.lit(1)).alias("categories"),
        F.sum(F.when(is_least, F.col("n_ref")).otherwise(0)).alias("_one_ref"),
        F.sum(F.when(is_least, F.col("n_cur")).otherwise(0)).alias("_one_cur"),
    )
    n1, n2 = F.col("total_ref"), F.col("total_cur")
    pooled = (F.col("_one_ref") + F.col("_one_cur")) / F.nullif(n1 + n2, F.lit(0))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.nullif(n1, F.lit(0)) + 1 / F.nullif(n2, F.lit(0))))
    gap = F.col("_one_ref") / F.nullif(n1, F.lit(0)) - F.col("_one_cur") / F.nullif(n2, F.lit(0))
    return by_column.withColumn("z", F.coalesce(gap / F.nullif(spread, F.lit(0.0)), F.lit(0.0))).drop("_one_ref", "_one_cur")


def numeric_distances(counts: DataFrame, splits: int | None = None) -> DataFrame:
    """Per column: Wasserstein distance over the reference's deviation, and the Kolmogorov–Smirnov statistic."""
    totals = _with_totals(counts)
    means = totals.groupBy("column").agg(
        (F.sum(F.col("n_ref") * F.col("x")) / F.nullif(F.sum("n_ref"), F.lit(0))).alias("mean_ref")
    )
    # One row per column of the table.
    running = running_totals(totals, "x", ["n_ref", "n_cur"], by="column", following="x_next", splits=splits)
    running = running.join(F.broadcast(means), "column")
    cdf = lambda s: (F.col(f"n_{s}_before") + F.col(f"n_{s}")) / F.nullif(F.col(f"total_{s}"), F.lit(0))
    gap = F.abs(cdf("ref") - cdf("cur"))
    width = F.coalesce(F.col("x_next") - F.col("x"), F.lit(0.0))
    off = F.col("x") - F.col("mean_ref")
    variance = F.sum(F.col("n_ref") * off * off) / F.nullif(F.sum("n_ref"), F.lit(0))
    return running.groupBy("column").agg(
        F.sum(gap * width).alias("wasserstein"),
        F.max(gap).alias("ks"),
        F.sqrt(variance).alias("stddev_ref"),
    ).withColumn("wasserstein_normed", F.col("wasserstein") / F.greatest(F.col("stddev_ref"), F.lit(MIN_SCALE)))


def ks_tail(d: float, n_ref: float, n_cur: float) -> float:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov–Smirnov statistic."""
    root = math.sqrt(n_ref * n_cur / (n_ref + n_cur))
    lam = (root + 0.12 + 0.11 / root) * d
    if lam < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (j - 1) * math.exp(-2 * (j * lam) ** 2) for j in range(1, 101))))


def ks_exact(d: float, n_ref: int, n_cur: int) -> float:
    """Two-sided p-value of the two-sample Kolmogorov–Smirnov statistic ``d``, for samples without ties.

    All orders of the two samples are equally likely: they are the lattice paths from corner to corner, and those that stay
    within ``d`` of the diagonal have a smaller statistic. A row of the lattice is a running sum of the row before, inside
    the places that are allowed; rows are scaled, so that counts of any size stay finite. Good to about 1e-9.
    """
    n, m = int(n_ref), int(n_cur)
    lcm = math.lcm(n, m)
    reach = round(d * lcm)
    if reach <= 0:
        return 1.0
    up, right = lcm // n, lcm // m
    places = np.arange(m + 1)
    counts = (places * right < reach).astype(float)
    scale = 0.0
    for i in range(1, n + 1):
        allowed = np.abs(i * up - places * right) < reach
        if not allowed.any():
            return 1.0
        first = int(np.argmax(allowed))
        counts[:first] = 0.0
        counts = np.where(allowed, np.cumsum(np.where(allowed, counts, 0.0)), 0.0)
        most = counts.max()
        if most == 0.0:
            return 1.0
        counts /= most
        scale += math.log(most)
    if counts[m] == 0.0:
        return 1.0
    paths = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return min(1.0, max(0.0, -math.expm1(math.log(counts[m]) + scale - paths)))


def chi2_tail(stat: float, dof: int) -> float:
    """P(chi-square with ``dof`` degrees of freedom ≥ stat), by the recurrence over dof in steps of two."""
    if dof < 1 or stat <= 0:
        return 1.0
    if math.isinf(stat):
        return 0.0
    half = stat / 2
    tail, k = (math.erfc(math.sqrt(half)), 1) if dof % 2 else (math.exp(-half), 2)
    while k < dof:
        tail += math.exp(k / 2 * math.log(half) - half - math.lgamma(k / 2 + 1))
        k += 2
    return min(1.0, tail)


def z_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


@F.pandas_udf(T.DoubleType())
def _p_value(
    method: pd.Series, stat: pd.Series, n_ref: pd.Series, n_cur: pd.Series, categories: pd.Series
) -> pd.Series:
    def one(m, s, a, b, k):
        if m == "ks" and max(a, b) <= EXACT_SIZE:
            return ks_exact(s, a, b)
        if m in ("ks", "ks_asymptotic"):
            return ks_tail(s, a, b)
        if m == "chisquare":
            return chi2_tail(s, int(k) - 1)
        return z_tail(s) if m == "z" else None

    return pd.Series([one(*row) for row in zip(method, stat, n_ref, n_cur, categories)], dtype="float64")


def drift_report(
    labelled: DataFrame,
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    tests: str = "distance",
    splits: int | None = None,
) -> DataFrame:
    """(column, method, score, threshold, drifted) plus the sizes, one row per column.

    ``tests="distance"``: normed Wasserstein, or Jensen–Shannon for text and for numbers with at most five distinct
    values. ``"p_value"``: Kolmogorov–Smirnov, chi-square, or a two-proportion z test when there are two categories.
    ``"by_size"`` takes p-values up to 1000 reference values and distances beyond, so a score's meaning follows the size.
    """
    if tests not in ("distance", "p_value", "by_size"):
        raise ValueError(f"tests must be distance, p_value or by_size, not {tests!r}")
    found_numeric, found_text = typed_columns(labelled)
    numeric = found_numeric if numeric is None else numeric
    categorical = found_text if categorical is None else categorical
    numbers = stage(value_counts(labelled, numeric), "value-counts") if numeric else None
    return counts_report(numbers, value_counts(labelled, categorical, "string") if categorical else None, tests, splits)


def counts_report(numbers: DataFrame | None, texts: DataFrame | None = None, tests: str = "distance", splits: int | None = None) -> DataFrame:
    """The report of ``drift_report`` from value counts of number and of text columns, which may come from daily counts.

    ``numbers`` is read more than once: give a written table.
    """
    parts = []
    if numbers is not None:
        # Both sides have one row per column of the table.
        parts.append(category_distances(numbers).join(numeric_distances(numbers, splits), "column", "left"))
    if texts is not None:
        text = category_distances(texts)
        parts.append(text.withColumns({"ks": F.lit(None).cast("double"), "wasserstein_normed": F.lit(None).cast("double")}))
    stats = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)

    few = F.col("wasserstein_normed").isNull() | (F.col("distinct_ref") <= FEW_VALUES)
    small = F.col("total_ref") <= SMALL_REFERENCE if tests == "by_size" else F.lit(tests == "p_value")
    method = (
        F.when(~small & ~few, "wasserstein")
        .when(~small, "jensenshannon")
        .when(~few, "ks")
        .when(F.col("distinct_ref") > 2, "chisquare")
        .otherwise("z")
    )
    stat = (
        F.when(F.col("method") == "wasserstein", F.col("wasserstein_normed"))
        .when(F.col("method") == "jensenshannon", F.col("js_distance"))
        .when(F.col("method") == "ks", F.col("ks"))
        .when(F.col("method") == "chisquare", F.col("chi2"))
        .otherwise(F.col("z"))
    )
    scored = stats.withColumn("method", method).withColumn("statistic", stat)
    by_distance = F.col("method").isin("wasserstein", "jensenshannon")
    p = _p_value("method", "statistic", "total_ref", "total_cur", "categories")
    scored = scored.withColumn("p_value", p)
    return scored.select(
        "column",
        "method",
        "statistic",
        F.when(by_distance, F.col("statistic")).otherwise(F.col("p_value")).alias("score"),
        F.when(by_distance, F.lit(DISTANCE_LIMIT)).otherwise(F.lit(P_LIMIT)).alias("threshold"),
        F.coalesce(
            F.when(by_distance, F.col("statistic") >= DISTANCE_LIMIT).otherwise(F.col("p_value") < P_LIMIT), F.lit(False)
        ).alias("drifted"),
        F.col("total_ref").alias("n_ref"),
        F.col("total_cur").alias("n_cur"),
    )


def dataset_drift(report: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """One row: columns, drifted columns, their share, and the verdict (false for an empty report)."""
    return report.agg(
        F.count(F.lit(1)).alias("number_of_columns"),
        F.count_if("drifted").alias("number_of_drifted_columns"),
        F.avg(F.col("drifted").cast("double")).alias("share_of_drifted_columns"),
        F.coalesce(F.avg(F.col("drifted").cast("double")) >= share, F.lit(False)).alias("dataset_drift"),
    )


def column_summary(labelled: DataFrame, column: str, splits: int | None = None) -> DataFrame:
    """Per period: count, missing, distinct, min, quartiles, max, mean, deviation and the most common value."""
    x = F.col(column).cast("double")
    missing = x.isNull() | F.isnan(x)
    counts = stage(
        labelled.select("period", F.when(~missing, x).alias("x")).groupBy("period", "x").agg(F.count(F.lit(1)).alias("n")),
        "column-summary",
    )
    present = counts.where(F.col("x").isNotNull())
    basic = present.groupBy("period").agg(
        F.sum("n").alias("n_values"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        (F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("mean"),
        F.max("n").alias("most_common_count"),
    )
    centred = present.join(F.broadcast(basic.select("period", "mean", "n_values", "most_common_count")), "period")
    off = F.col("x") - F.col("mean")
    deviation = centred.groupBy("period").agg(
        F.sqrt(F.sum(F.col("n") * off * off) / F.nullif(F.max("n_values") - 1, F.lit(0))).alias("stddev"),
        F.min(F.when(F.col("n") == F.col("most_common_count"), F.col("x"))).alias("most_common"),
    )
    nulls = counts.groupBy("period").agg(F.coalesce(F.sum(F.when(F.col("x").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"))
    points = quantiles(present, "x", "n", [0.25, 0.5, 0.75], by="period").groupBy("period").agg(
        *[F.max(F.when(F.col("p") == p, F.col("quantile"))).alias(name) for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    )
    # All four have one row per period.
    return basic.join(deviation, "period").join(nulls, "period").join(points, "period").select(
        "period", "n_values", "n_missing", "n_distinct", "min", "p25", "p50", "p75", "max", "mean", "stddev",
        "most_common", "most_common_count",
    )


def drift_document(report: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """The whole result as one nested row for the JSON sink; its size is that of the column list."""
    verdict = dataset_drift(report)
    columns = report.agg(F.sort_array(F.collect_list(F.struct("column", "method", "score", "threshold", "drifted"))).alias("c"))
    out = verdict.withColumn("columns", columns.scalar())
    if summary is not None:
        rows = summary.agg(F.sort_array(F.collect_list(F.struct(*summary.columns))).alias("s"))
        out = out.withColumn("summary", rows.scalar())
    return out
