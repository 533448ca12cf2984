"""Column summaries of columns with too many different values for exact counts.

A day is kept as one row per column: counts, extremes and moments, a KLL sketch of the order and an HLL sketch of the
different values. Days merge into any period of whole days, so no row is read twice and what is kept does not grow with
the rows. Counts, extremes, mean and deviation are those of ``drift.column_summary``; only quartiles and the number of
different values are estimates, as far off as ``rank_error`` and ``distinct_error`` state. The exact form stays the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourline import schema
from hourline.operators.drift import period_of

KLL_K = 200
HLL_LG = 12
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def rank_error(k: int = KLL_K) -> float:
    """How far the rank of an estimated quantile may lie from the one asked for, as a share, in 99 of 100 cases."""
    return 2.296 / k**0.9723


def distinct_error(lg: int = HLL_LG) -> float:
    """The relative standard error of an estimated number of different values."""
    return 1.04 / 2 ** (lg / 2)


def daily_sketches(df: DataFrame, columns: list[str], time: str = schema.TIME, k: int = KLL_K, lg: int = HLL_LG) -> DataFrame:
    """One row per day and column; null and NaN are missing. Rows without a time have no day and are left out.

    Sketches are built before the shuffle, so a day or column that holds most of the rows is one row per map task.
    """
    days = df.withColumn("day", F.to_date(time)).where(F.col("day").isNotNull())
    long = days.select("day", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot("day", columns, "column", "x")
    # Negative zero equals zero but has other bits.
    x = F.when(F.col("x").isNotNull() & ~F.isnan("x"), F.col("x") + F.lit(0.0))
    return (
        long.withColumn("x", x)
        .groupBy("day", "column")
        .agg(
            F.count("x").alias("n_values"),
            F.count_if(F.col("x").isNull()).alias("n_missing"),
            F.min("x").alias("min"),
            F.max("x").alias("max"),
            F.avg("x").alias("mean"),
            (F.var_pop("x") * F.count("x")).alias("spread"),
            F.kll_sketch_agg_double("x", k).alias("order_sketch"),
            F.hll_sketch_agg(F.col("x").cast("string"), lg).alias("distinct_sketch"),
        )
    )


def period_sketches(daily: DataFrame, last: str, reference_days: int = 365, gap_days: int = 30, current_days: int = 29) -> DataFrame:
    """The days of the two periods that end with the day ``last`` merged, one row per period and column.

    Only the days of the periods are read. Squared deviations of a day's rows from the mean of their period are those
    from the day's mean plus that mean's own, which loses no digits as a difference of sums of squares would.
    """
    end = F.lit(last).cast("date")
    inside = daily.where(F.col("day").between(F.date_sub(end, max(reference_days, current_days)), end))
    labelled = inside.withColumn("period", period_of(F.col("day"), last, reference_days, gap_days, current_days))
    labelled = labelled.where(F.col("period").isNotNull())
    # One row per day of a period and column: as many rows as a period has days.
    of_period = Window.partitionBy("period", "column")
    mean = F.sum(F.col("mean") * F.col("n_values")).over(of_period) / F.nullif(F.sum("n_values").over(of_period), F.lit(0))
    off = F.col("mean") - F.col("whole_mean")
    return (
        labelled.withColumn("whole_mean", mean)
        .groupBy("period", "column")
        .agg(
            F.sum("n_values").alias("n_values"),
            F.sum("n_missing").alias("n_missing"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.first("whole_mean").alias("mean"),
            F.sum(F.col("spread") + F.col("n_values") * off * off).alias("spread"),
            F.kll_merge_agg_double("order_sketch").alias("order_sketch"),
            F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        )
    )


def sketched_summary(periods: DataFrame) -> DataFrame:
    """Per period and column: counts, estimated number of different values, extremes, estimated quartiles, mean, deviation.

    A column without a value in a period has nulls for all but its counts.
    """
    some = F.col("n_values") > 0
    quartiles = [F.when(some, F.kll_sketch_get_quantile_double("order_sketch", F.lit(p))).alias(name) for name, p in QUARTILES.items()]
    return periods.select(
        "period",
        "column",
        "n_values",
        "n_missing",
        F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"),
        "min",
        *quartiles,
        "max",
        "mean",
        F.sqrt(F.col("spread") / F.nullif(F.col("n_values") - 1, F.lit(0))).alias("stddev"),
    )


def rank_gaps(summary: DataFrame, labelled: DataFrame, columns: list[str]) -> DataFrame:
    """How far each estimated quartile's rank is off, measured on the labelled rows it was estimated for.

    A value that occurs often holds a range of ranks, (share below, share up to it); the gap is the distance to that
    range. The summary has one row per period and column.
    """
    estimates = summary.unpivot(["period", "column"], list(QUARTILES), "point", "q")
    long = labelled.select("period", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot("period", columns, "column", "x")
    met = long.where(F.col("x").isNotNull() & ~F.isnan("x")).join(F.broadcast(estimates), ["period", "column"])
    p = F.element_at(F.create_map(*[F.lit(v) for pair in QUARTILES.items() for v in pair]), F.col("point"))
    shares = met.groupBy("period", "column", "point").agg(
        F.avg((F.col("x") < F.col("q")).cast("double")).alias("below"), F.avg((F.col("x") <= F.col("q")).cast("double")).alias("up_to")
    )
    return shares.select("period", "column", "point", F.greatest(F.col("below") - p, p - F.col("up_to"), F.lit(0.0)).alias("gap"))
