"""Lag windows, positions and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline import schema
from hourline.catalog.common import DAILY, FEATURES, HOURLY, daily, features, hourly, query
from hourline.operators import windows
from hourline.operators.ordered import number_rows

Z = "PARTITION BY sub_region_code ORDER BY date"


def flat(df, seq_len):
    """Scalars that pin an array down: its size, sum, both ends and one place inside."""
    total = F.aggregate("demand_lags", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return df.withColumns(
        {
            "n_lags": F.size("demand_lags"),
            "lag_sum": total,
            "lag_newest": windows.lag(1),
            "lag_middle": windows.lag(seq_len // 2),
            "lag_oldest": windows.lag(seq_len),
        }
    ).drop("demand_lags")


def flat_sql(seq_len, columns=""):
    return f"""{columns} {seq_len} AS n_lags, sum(demand) OVER w AS lag_sum, lag(demand, 1) OVER ({Z}) AS lag_newest,
      lag(demand, {seq_len // 2}) OVER ({Z}) AS lag_middle, lag(demand, {seq_len}) OVER ({Z}) AS lag_oldest,
      row_number() OVER ({Z}) AS rn"""


def frame(seq_len):
    return f"WINDOW w AS ({Z} ROWS BETWEEN {seq_len} PRECEDING AND 1 PRECEDING)"


COLS = "sub_region_code, date, demand AS target_demand_next_hour, n_lags, lag_sum, lag_newest, lag_middle, lag_oldest"


@query("g_row_numbers", f"WITH {DAILY} SELECT sub_region_code, date, row_number() OVER ({Z}) AS rn FROM daily")
def row_numbers(spark, sf_dir):
    return number_rows(daily(spark, sf_dir)).select("sub_region_code", "date", F.col("rn").cast("bigint").alias("rn"))


@query(
    "g1_lag_window",
    f"""WITH {DAILY}, x AS (SELECT sub_region_code, date, demand, {flat_sql(672)} FROM daily {frame(672)})
    SELECT {COLS} FROM x WHERE rn > 672""",
)
def lag_window(spark, sf_dir):
    return flat(windows.lag_windows(daily(spark, sf_dir), 672, covariates=[]), 672)


@query(
    "g1_lag_window_hourly",
    f"""WITH {HOURLY}, x AS (SELECT sub_region_code, date, demand, {flat_sql(24)} FROM hourly {frame(24)})
    SELECT sub_region_code, date, demand AS target_demand_next_hour, n_lags, round(lag_sum, 4) AS lag_sum, lag_newest, lag_middle, lag_oldest
    FROM x WHERE rn > 24""",
)
def lag_window_hourly(spark, sf_dir):
    out = windows.lag_windows(hourly(spark, sf_dir), 24, covariates=[], chunk_rows=100)
    return flat(out, 24).withColumn("lag_sum", F.round("lag_sum", 4))


@query(
    "d7_stride",
    f"""WITH {DAILY}, x AS (SELECT sub_region_code, date, demand, {flat_sql(96)} FROM daily {frame(96)})
    SELECT {COLS} FROM x WHERE rn > 96 AND (rn - 97) % 24 = 0""",
)
def stride(spark, sf_dir):
    return flat(windows.lag_windows(daily(spark, sf_dir), 96, step=24, covariates=[]), 96)


@query(
    "g3_target_covariates",
    f"""WITH {FEATURES}, x AS (SELECT *, row_number() OVER ({Z}) AS rn, lag(demand, 1) OVER ({Z}) AS lag_newest FROM features)
    SELECT sub_region_code, date, temperature_2m, hour, day_of_week, month, is_weekend, is_holiday,
           demand AS target_demand_next_hour, lag_newest FROM x WHERE rn > 28""",
)
def target_covariates(spark, sf_dir):
    out = windows.lag_windows(features(spark, sf_dir), 28)
    return out.withColumn("lag_newest", windows.lag(1)).drop("demand_lags")


@query(
    "g4_seasonal_mean",
    f"""WITH {DAILY}, x AS (SELECT sub_region_code, date, row_number() OVER ({Z}) AS rn,
      0.25 * (lag(demand, 168) OVER ({Z}) + lag(demand, 336) OVER ({Z}) + lag(demand, 504) OVER ({Z}) + lag(demand, 672) OVER ({Z})) AS average_demand_last_4_weeks
      FROM daily) SELECT sub_region_code, date, average_demand_last_4_weeks FROM x WHERE rn > 672""",
)
def seasonal_mean(spark, sf_dir):
    out = windows.seasonal_mean(windows.lag_windows(daily(spark, sf_dir), 672, covariates=[]))
    return out.select("sub_region_code", "date", "average_demand_last_4_weeks")


@query(
    "g4_narrow_lags",
    f"""WITH {DAILY}, x AS (SELECT *, row_number() OVER ({Z}) AS rn, lag(demand, 672) OVER ({Z}) AS demand_previous_672_hour,
      lag(demand, 168) OVER ({Z}) AS demand_previous_168_hour, lag(demand, 1) OVER ({Z}) AS demand_previous_1_hour FROM daily)
    SELECT sub_region_code, date, demand_previous_672_hour, demand_previous_168_hour, demand_previous_1_hour,
      demand AS target_demand_next_hour FROM x WHERE rn > 672""",
)
def narrow_lags(spark, sf_dir):
    return windows.lag_columns(daily(spark, sf_dir), [1, 168, 672], covariates=[])


MATRIX = DAILY.replace("l_returnflag AS sub_region_code", "concat(l_returnflag, l_linestatus, l_linenumber) AS sub_region_code")


@query(
    "g1_lag_matrix",
    f"""WITH {MATRIX}, x AS (SELECT *, row_number() OVER ({Z}) AS rn, lag(demand, 672) OVER ({Z}) AS lag_oldest,
      lag(demand, 336) OVER ({Z}) AS lag_middle, lag(demand, 1) OVER ({Z}) AS lag_newest FROM daily)
    SELECT sub_region_code, date, demand AS target_demand_next_hour, 672 AS n_lags, lag_oldest, lag_middle, lag_newest
    FROM x WHERE rn > 672""",
)
def lag_matrix(spark, sf_dir):
    """One series per return flag, line status and line number: about a hundred thousand rows at sf0.1."""
    key = F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string"))
    out = windows.lag_windows(daily(spark, sf_dir, key), 672, covariates=[])
    return out.select(
        "sub_region_code", "date", schema.TARGET, F.size("demand_lags").alias("n_lags"),
        windows.lag(672).alias("lag_oldest"), windows.lag(336).alias("lag_middle"), windows.lag(1).alias("lag_newest"),
    )


@query(
    "g5_index_ranges",
    f"""WITH {DAILY}, n AS (SELECT sub_region_code, count(*) AS n FROM daily GROUP BY 1)
    SELECT sub_region_code, i AS first, i + 100 AS mid, i + 101 AS last
    FROM (SELECT sub_region_code, unnest(range(0, n - 101, 7)) AS i FROM n)""",
)
def index_ranges(spark, sf_dir):
    return windows.window_ranges(daily(spark, sf_dir), 100, 7, "sub_region_code")


@query(
    "g6_latest_vector",
    f"""WITH {DAILY}, x AS (SELECT *, row_number() OVER (PARTITION BY sub_region_code ORDER BY date DESC) AS rn FROM daily)
    SELECT sub_region_code, max(date) AS date, CAST(count(*) AS INTEGER) AS n_lags, sum(demand) AS lag_sum,
      max(CASE WHEN rn = 1 THEN demand END) AS lag_newest, max(CASE WHEN rn = 336 THEN demand END) AS lag_middle,
      max(CASE WHEN rn = 672 THEN demand END) AS lag_oldest
    FROM x WHERE rn <= 672 GROUP BY 1""",
)
def latest_vector(spark, sf_dir):
    return flat(windows.latest_windows(daily(spark, sf_dir), 672, covariates=[]), 672)


@query(
    "g7_last_row",
    f"""WITH {FEATURES} SELECT sub_region_code, date, demand, temperature_2m, day_of_week, month FROM features
    QUALIFY row_number() OVER (PARTITION BY sub_region_code ORDER BY date DESC) = 1""",
)
def last_row(spark, sf_dir):
    return windows.last_rows(features(spark, sf_dir).select("sub_region_code", "date", "demand", "temperature_2m", "day_of_week", "month"))


@query(
    "g8_tail_n",
    f"""WITH {HOURLY} SELECT sub_region_code, date, demand FROM hourly
    QUALIFY row_number() OVER (PARTITION BY sub_region_code ORDER BY date DESC) <= 168""",
)
def tail_n(spark, sf_dir):
    return windows.tail_per_series(hourly(spark, sf_dir), 168)


@query(
    "g9_unpivot_history",
    f"""WITH {DAILY}, x AS (SELECT *, row_number() OVER (PARTITION BY sub_region_code ORDER BY date DESC) AS rn,
      max(date) OVER (PARTITION BY sub_region_code) AS last FROM daily)
    SELECT sub_region_code, last - to_hours(CAST(rn - 1 AS INTEGER)) AS hour, demand FROM x WHERE rn <= 672""",
)
def unpivot_history(spark, sf_dir):
    latest = windows.latest_windows(daily(spark, sf_dir), 672, covariates=[]).drop("n_lags")
    return windows.lag_history(latest)


@query(
    "z4_clock_lags",
    f"""WITH {HOURLY}, s AS (SELECT sub_region_code, min(date) AS start FROM hourly GROUP BY 1)
    SELECT h.sub_region_code, h.date, h.demand AS target_demand_next_hour, a.demand AS lag_newest, b.demand AS lag_day
    FROM hourly h JOIN s USING (sub_region_code)
    LEFT JOIN hourly a ON a.sub_region_code = h.sub_region_code AND a.date = h.date - INTERVAL 1 HOUR
    LEFT JOIN hourly b ON b.sub_region_code = h.sub_region_code AND b.date = h.date - INTERVAL 24 HOUR
    WHERE h.date >= start + INTERVAL 24 HOUR""",
)
def clock_lags(spark, sf_dir):
    out = windows.lag_windows(hourly(spark, sf_dir), 24, covariates=[], lag_mode="time", chunk_rows=100)
    return out.withColumns({"lag_newest": windows.lag(1), "lag_day": windows.lag(24)}).drop("demand_lags")


@query(
    "z4_clock_lags_finer",
    f"""WITH {HOURLY}, d AS (SELECT *, date_trunc('day', date) AS day FROM hourly
      QUALIFY row_number() OVER (PARTITION BY sub_region_code, date_trunc('day', date) ORDER BY date DESC) = 1),
    s AS (SELECT sub_region_code, min(day) AS start FROM d GROUP BY 1)
    SELECT h.sub_region_code, h.date, h.demand AS target_demand_next_hour, a.demand AS lag_newest, b.demand AS lag_third
    FROM d h JOIN s USING (sub_region_code)
    LEFT JOIN d a ON a.sub_region_code = h.sub_region_code AND a.day = h.day - INTERVAL 1 DAY
    LEFT JOIN d b ON b.sub_region_code = h.sub_region_code AND b.day = h.day - INTERVAL 3 DAY
    WHERE h.day >= start + INTERVAL 3 DAY""",
)
def clock_lags_finer(spark, sf_dir):
    """Hourly readings on a clock of days: the last reading of a day stands for it."""
    out = windows.lag_windows(hourly(spark, sf_dir), 3, covariates=[], lag_mode="time", grain_seconds=86400, chunk_rows=10)
    return out.withColumns({"lag_newest": windows.lag(1), "lag_third": windows.lag(3)}).drop("demand_lags")


@query(
    "z4_latest_clock",
    f"""WITH {HOURLY}, m AS (SELECT sub_region_code, min(date) AS first, max(date) AS date FROM hourly GROUP BY 1)
    SELECT m.sub_region_code, m.date, a.demand AS lag_newest, b.demand AS lag_third,
           CAST(least(24, date_diff('hour', m.first, m.date) + 1) AS INTEGER) AS n_lags,
           (SELECT count(*) FROM hourly h WHERE h.sub_region_code = m.sub_region_code AND h.date > m.date - INTERVAL 24 HOUR) AS readings
    FROM m JOIN hourly a ON a.sub_region_code = m.sub_region_code AND a.date = m.date
    LEFT JOIN hourly b ON b.sub_region_code = m.sub_region_code AND b.date = m.date - INTERVAL 2 HOUR""",
)
def latest_clock(spark, sf_dir):
    """The last day of every series by the clock: missing hours are null slots."""
    out = windows.latest_windows(hourly(spark, sf_dir), 24, covariates=[], lag_mode="time")
    held = F.size(F.filter("demand_lags", lambda x: x.isNotNull())).cast("long")
    return out.select("sub_region_code", "date", windows.lag(1).alias("lag_newest"), windows.lag(3).alias("lag_third"), "n_lags", held.alias("readings"))


def fold_sql(order):
    return f"""WITH {DAILY}, x AS (SELECT sub_region_code, date, row_number() OVER (ORDER BY {order}) - 1 AS ordinal,
      count(*) OVER () AS n FROM daily)
    SELECT sub_region_code, date, ordinal,
      CAST(greatest(0, floor((ordinal - (n - 3 * (n // 4))) / (n // 4)) + 1) AS INTEGER) AS fold FROM x"""


def folds(spark, sf_dir, order):
    out = windows.expanding_folds(daily(spark, sf_dir), 3, order)
    return out.select("sub_region_code", "date", F.col("ordinal").cast("bigint").alias("ordinal"), "fold")


@query("g10_folds_concat", fold_sql("sub_region_code, date"))
def folds_concat(spark, sf_dir):
    return folds(spark, sf_dir, "concat")


@query("g10_folds_time", fold_sql("date, sub_region_code"))
def folds_time(spark, sf_dir):
    return folds(spark, sf_dir, "time")


@query(
    "wide_lag_columns",
    f"""WITH {DAILY}, x AS (SELECT *, row_number() OVER ({Z}) AS rn,
      {", ".join(f"lag(demand, {k}) OVER ({Z}) AS demand_previous_{k}_hour" for k in range(28, 0, -1))} FROM daily)
    SELECT sub_region_code, date, {", ".join(f"demand_previous_{k}_hour" for k in range(28, 0, -1))},
      demand AS target_demand_next_hour FROM x WHERE rn > 28""",
)
def wide_lag_columns(spark, sf_dir):
    return windows.widen(windows.lag_windows(daily(spark, sf_dir), 28, covariates=[]), 28)


@query(
    "flagship_hourly_features",
    f"""WITH {HOURLY}, c AS (SELECT *, row_number() OVER ({Z}) AS rn,
      0.25 * (lag(demand, 6) OVER ({Z}) + lag(demand, 12) OVER ({Z}) + lag(demand, 18) OVER ({Z}) + lag(demand, 24) OVER ({Z})) AS average_demand_last_4_weeks,
      lag(demand, 1) OVER ({Z}) AS demand_previous_1_hour, lag(demand, 24) OVER ({Z}) AS demand_previous_24_hour FROM hourly)
    SELECT sub_region_code, date, CAST(hour(date) AS BIGINT) AS hour, CAST(isodow(date) - 1 AS BIGINT) AS day_of_week,
      CAST(isodow(date) >= 6 AS BIGINT) AS is_weekend, demand_previous_1_hour, demand_previous_24_hour,
      average_demand_last_4_weeks, demand AS target_demand_next_hour FROM c WHERE rn > 24""",
)
def flagship(spark, sf_dir):
    """Hourly demand → calendar columns → lag windows → seasonal mean."""
    from hourline.functions import calendar_columns

    calendar = calendar_columns(hourly(spark, sf_dir))
    out = windows.lag_windows(calendar, 24, covariates=["hour", "day_of_week", "is_weekend"])
    out = windows.seasonal_mean(out, season=6)
    return out.select(
        "sub_region_code", "date", "hour", "day_of_week", "is_weekend",
        windows.lag(1).alias("demand_previous_1_hour"),
        windows.lag(24).alias("demand_previous_24_hour"),
        "average_demand_last_4_weeks",
        schema.TARGET,
    )
