"""Lag windows per series.

A window is ``seq_len`` consecutive rows of one series. The rows are cut into chunks of bounded length, each chunk also
gets the last ``seq_len`` rows before it, and every window is then a ``slice`` of its chunk's array. A task therefore
holds a chunk, never a series, and no row is aggregated ``seq_len`` times as a sliding frame would do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hourline import schema
from hourline.operators.clean import require_columns, require_rows
from hourline.operators.joins import lookup_join
from hourline.operators.ordered import BUCKET_SECONDS, last_per_series, number_rows, running_totals, top_n
from hourline.session import shuffle_partitions

CHUNK_FACTOR = 4
LAGS = "demand_lags"


def check_seq_len(seq_len: int, season: int = schema.SEASON, weeks: int = 4) -> None:
    if seq_len < season * weeks:
        raise ValueError(f"{schema.TOO_SHORT} {season * weeks}: the mean of {weeks} seasons looks that far back")


def check_parameters(seq_len: int, cv_folds: int) -> None:
    if seq_len < 24:
        raise ValueError(f"{schema.TOO_SHORT} 24, not {seq_len}")
    if cv_folds < 2:
        raise ValueError(f"{schema.TOO_FEW_FOLDS}, not {cv_folds}")


def _targets(
    df: DataFrame,
    reach: int,
    step: int,
    key: str,
    time: str,
    value: str,
    covariates: list[str],
    lag_mode: str,
    grain_seconds: int,
    chunk_rows: int | None,
    bucket_seconds: float | None,
) -> tuple[DataFrame, Column]:
    """Every row with ``reach`` rows (or clock steps) before it, next to its chunk's values and its slot in them."""
    require_columns(df, [key, time, value, *covariates])
    chunk_rows = max(chunk_rows or CHUNK_FACTOR * reach, reach)
    base = df.select(key, time, F.col(value).cast("double").alias(value), *covariates)
    if lag_mode == "rows":
        placed = number_rows(base, key, time, bucket_seconds, rn="_rn").withColumn("_at", F.col("_rn") - 1)
    elif lag_mode == "time":
        base = _one_per_step(base, key, time, [value, *covariates], grain_seconds)
        start = base.groupBy(key).agg(F.min("_step").alias("_start"))
        placed = lookup_join(base, start, [key]).withColumn("_at", F.col("_step") - F.col("_start"))
    else:
        raise ValueError("lag_mode must be 'rows' or 'time'")

    home = F.floor(F.col("_at") / chunk_rows)
    in_halo = F.pmod(F.col("_at"), F.lit(chunk_rows)) >= chunk_rows - reach
    chunked = placed.withColumn("_chunk", F.explode(F.when(in_halo, F.array(home, home + 1)).otherwise(F.array(home))))
    # A fixed number of tasks: what comes out is many times what goes in, which size-based coalescing cannot know.
    chunked = chunked.repartition(shuffle_partitions(df.sparkSession), key, "_chunk")
    payload = F.struct("_at", time, value, *covariates)
    groups = chunked.groupBy(key, "_chunk").agg(F.sort_array(F.collect_list(payload)).alias("_rows"))
    if lag_mode == "rows":
        groups = groups.withColumn("_values", F.col(f"_rows.{value}"))
        slot = F.col("_pos")
    else:
        # Slot i of the dense array is clock step chunk_start − reach + i; gaps between the sorted rows become nulls.
        origin = F.col("_chunk") * chunk_rows - reach
        before = lambda i: F.when(i > 0, F.get("_rows", i - 1)["_at"]).otherwise(origin - 1)
        filled = F.transform(
            "_rows",
            lambda r, i: F.concat(
                F.array_repeat(F.lit(None).cast("double"), (r["_at"] - before(i) - 1).cast("int")), F.array(r[value])
            ),
        )
        groups = groups.withColumn("_values", F.flatten(filled))
        slot = (F.col("_row._at") - origin).cast("int")
    at = F.col("_row._at")
    targets = groups.select(key, "_chunk", "_values", F.posexplode("_rows").alias("_pos", "_row")).where(
        (at >= reach) & (at >= F.col("_chunk") * chunk_rows) & (F.pmod(at - reach, F.lit(step)) == 0)
    )
    return targets, slot


def lag_windows(
    df: DataFrame,
    seq_len: int = schema.SEQ_LEN,
    step: int = schema.STEP_SIZE,
    key: str = schema.KEY,
    time: str = schema.TIME,
    value: str = schema.VALUE,
    covariates: list[str] | None = None,
    lag_mode: str = "rows",
    grain_seconds: int = 3600,
    chunk_rows: int | None = None,
    bucket_seconds: float | None = BUCKET_SECONDS,
) -> DataFrame:
    """One row per window: key, time, ``demand_lags`` (oldest first), the covariates and the target.

    Covariates and target are those of the row right after the window. Every ``step``-th window of a series is kept,
    counted from its first. A null reading keeps its place in the array. Series with fewer than ``seq_len + 1`` rows
    give nothing. ``lag_mode="rows"`` counts rows; ``"time"`` counts clock steps of ``grain_seconds``, so a missing hour is
    a null lag instead of a shift. Of several rows in one clock step only the latest counts (of equal times the largest
    reading), as lag and as target.
    """
    covariates = list(schema.COVARIATES if covariates is None else covariates)
    targets, slot = _targets(
        df, seq_len, step, key, time, value, covariates, lag_mode, grain_seconds, chunk_rows, bucket_seconds
    )
    return targets.select(
        key,
        F.col(f"_row.{time}").alias(time),
        F.slice("_values", slot - seq_len + 1, F.lit(seq_len)).alias(LAGS),
        *[F.col(f"_row.{c}").alias(c) for c in covariates],
        F.col(f"_row.{value}").alias(schema.TARGET),
    )


def lag_columns(
    df: DataFrame,
    lags: list[int],
    step: int = schema.STEP_SIZE,
    key: str = schema.KEY,
    time: str = schema.TIME,
    value: str = schema.VALUE,
    covariates: list[str] | None = None,
    lag_mode: str = "rows",
    grain_seconds: int = 3600,
    chunk_rows: int | None = None,
    bucket_seconds: float | None = BUCKET_SECONDS,
) -> DataFrame:
    """The narrow form: only the lags asked for, as ``demand_previous_<k>_hour``, without building the arrays.

    Rows and order of the windows are those of ``lag_windows`` with ``seq_len = max(lags)``.
    """
    covariates = list(schema.COVARIATES if covariates is None else covariates)
    targets, slot = _targets(
        df, max(lags), step, key, time, value, covariates, lag_mode, grain_seconds, chunk_rows, bucket_seconds
    )
    return targets.select(
        key,
        F.col(f"_row.{time}").alias(time),
        *[F.get("_values", slot - k).alias(f"demand_previous_{k}_hour") for k in sorted(lags, reverse=True)],
        *[F.col(f"_row.{c}").alias(c) for c in covariates],
        F.col(f"_row.{value}").alias(schema.TARGET),
    )


def features_and_target(df: DataFrame, seq_len: int = schema.SEQ_LEN, step: int = schema.STEP_SIZE, **options) -> DataFrame:
    """The training table: checked columns and length, lag windows, and an error when no series is long enough."""
    require_columns(df, schema.FEATURE_COLUMNS)
    check_seq_len(seq_len, options.pop("season", schema.SEASON))
    return require_rows(lag_windows(df, seq_len, step, **options), schema.NO_WINDOWS)


def lag(k: int | Column, lags: str = LAGS) -> Column:
    """The reading ``k`` steps before the target; null when the array is shorter."""
    return F.try_element_at(F.col(lags), -k if isinstance(k, Column) else F.lit(-k))


def seasonal_mean(df: DataFrame, season: int = schema.SEASON, weeks: int = 4, lags: str = LAGS) -> DataFrame:
    """Add ``average_demand_last_4_weeks``: the mean of the readings 1, 2, 3 and 4 seasons back.

    Works on the array column, or on ``demand_previous_k_hour`` columns when there is no array.
    """
    steps = [season * w for w in range(1, weeks + 1)]
    if lags in df.columns:
        terms = [lag(k, lags) for k in steps]
    else:
        names = [f"demand_previous_{k}_hour" for k in steps]
        if not set(names) <= set(df.columns):
            raise ValueError(f"The seasonal mean takes a lag array or the columns {names}")
        terms = [F.col(n) for n in names]
    return df.withColumn("average_demand_last_4_weeks", sum(terms[1:], terms[0]) * F.lit(1.0 / weeks))


def widen(df: DataFrame, seq_len: int = schema.SEQ_LEN, lags: str = LAGS) -> DataFrame:
    """The array as ``demand_previous_<seq_len>_hour … demand_previous_1_hour``, oldest first."""
    rest = [c for c in df.columns if c != lags]
    wide = [lag(k, lags).alias(f"demand_previous_{k}_hour") for k in range(seq_len, 0, -1)]
    return df.select(*[c for c in rest if c != schema.TARGET], *wide, *[c for c in rest if c == schema.TARGET])


def window_ranges(df: DataFrame, seq_len: int, step: int, key: str | None = None, block: int = 100_000) -> DataFrame:
    """Row index ranges (first, mid, last) whose last index is still inside the table.

    One range fewer than ``lag_windows`` gives at step 1. Only the row counts are read; a long table is cut into blocks
    of ranges that are listed side by side.
    """
    group = [key] if key else []
    ranges = F.floor((F.col("_n") - seq_len - 2) / step) + 1
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") - seq_len - 2 >= 0)
    blocks = counts.withColumn("_ranges", ranges).select(
        *group,
        "_ranges",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_ranges") - 1) / block))).alias("_block"),
    )
    blocks = blocks.repartition(shuffle_partitions(df.sparkSession), *group, "_block")
    start = F.col("_block") * block
    numbers = blocks.select(*group, F.explode(F.sequence(start, F.least(start + block, F.col("_ranges")) - 1)).alias("_i"))
    first = F.col("_i") * step
    return numbers.select(*group, first.alias("first"), (first + seq_len).alias("mid"), (first + seq_len + 1).alias("last"))


def latest_windows(
    df: DataFrame,
    seq_len: int = schema.SEQ_LEN,
    key: str = schema.KEY,
    time: str = schema.TIME,
    value: str = schema.VALUE,
    covariates: list[str] | None = None,
    lag_mode: str = "rows",
    grain_seconds: int = 3600,
) -> DataFrame:
    """Per series its last (up to) ``seq_len`` readings, newest last, and the covariates of its newest row.

    ``n_lags`` tells how many readings there were. With ``lag_mode="time"`` the array has one slot per clock step up to
    the newest reading, null where a step has none, as in ``lag_windows``; ``n_lags`` counts the slots since the first
    reading. At most ``seq_len`` rows per series leave a map task.
    """
    covariates = list(schema.COVARIATES if covariates is None else covariates)
    columns = [time, value, *covariates]
    if lag_mode == "time":
        return _latest_on_clock(df.select(key, *columns), seq_len, key, time, value, covariates, grain_seconds)
    if lag_mode != "rows":
        raise ValueError("lag_mode must be 'rows' or 'time'")
    recent = top_n(df.select(key, *columns), [key], [F.col(time).desc()], seq_len)
    rows = recent.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(time, value, *covariates))).alias("_rows"))
    newest = F.element_at("_rows", -1)
    return rows.select(
        key,
        newest[time].alias(time),
        F.col(f"_rows.{value}").cast("array<double>").alias(LAGS),
        *[newest[c].alias(c) for c in covariates],
        F.size("_rows").alias("n_lags"),
    )


def _clock_step(time: str, grain_seconds: int) -> Column:
    return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / grain_seconds)


def _one_per_step(df: DataFrame, key: str, time: str, rest: list[str], grain_seconds: int) -> DataFrame:
    """key, _step, time and ``rest``: of several rows in a clock step the latest stays, trimmed before the shuffle."""
    timed = df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_step", _clock_step(time, grain_seconds))
    return timed.groupBy(key, "_step").agg(F.max(F.struct(time, *rest)).alias("_latest")).select(key, "_step", "_latest.*")


def _latest_on_clock(
    df: DataFrame, seq_len: int, key: str, time: str, value: str, covariates: list[str], grain_seconds: int
) -> DataFrame:
    steps = _one_per_step(df, key, time, [value, *covariates], grain_seconds)
    recent = top_n(steps, [key], [F.col("_step").desc()], seq_len)
    rows = recent.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_step", time, value, *covariates))).alias("_rows"))
    newest = F.element_at("_rows", -1)
    last, first = newest["_step"], F.element_at("_rows", 1)["_step"]
    n = F.least(F.lit(seq_len).cast("long"), last - first + 1)
    readings = F.map_from_arrays(F.col("_rows._step"), F.col(f"_rows.{value}").cast("array<double>"))
    return rows.select(
        key,
        newest[time].alias(time),
        F.transform(F.sequence(last - n + 1, last), lambda i: F.try_element_at(readings, i)).alias(LAGS),
        *[newest[c].alias(c) for c in covariates],
        n.cast("int").alias("n_lags"),
    )


def last_rows(df: DataFrame, key: str = schema.KEY, time: str = schema.TIME) -> DataFrame:
    return last_per_series(df, key, time)


def tail_per_series(df: DataFrame, n: int = 168, key: str = schema.KEY, time: str = schema.TIME) -> DataFrame:
    return top_n(df, [key], [F.col(time).desc()], n)


def lag_history(df: DataFrame, lags: str = LAGS, time: str = schema.TIME, grain_seconds: int = 3600) -> DataFrame:
    """Each lag array as rows (hour, demand), the last one at the row's own time."""
    rest = [c for c in df.columns if c not in (lags, time)]
    n = F.size(lags)
    return df.select(*rest, time, n.alias("_n"), F.posexplode(lags).alias("_pos", "demand")).select(
        *rest,
        (F.col(time) - F.make_dt_interval(secs=((F.col("_n") - 1 - F.col("_pos")) * grain_seconds).cast("decimal(18,6)"))).alias("hour"),
        "demand",
    )


def expanding_folds(
    df: DataFrame, folds: int = schema.CV_FOLDS, order: str = "time", key: str = schema.KEY, time: str = schema.TIME
) -> DataFrame:
    """Add ``ordinal`` and ``fold`` of expanding-window validation over all rows.

    With n rows and k folds the last k·(n // (k+1)) rows form folds 1…k; fold j is tested on a model that saw every row
    with a smaller fold number, fold 0 included. ``order="time"`` walks through time, ``"concat"`` through the series one
    after the other.
    """
    if folds < 2:
        raise ValueError(f"{schema.TOO_FEW_FOLDS}, not {folds}")
    columns = {"time": (time, key), "concat": (key, time)}[order]
    placed = df.withColumns({"_order": F.struct(*columns), "_one": F.lit(1).cast("bigint")})
    placed = running_totals(placed, "_order", ["_one"]).withColumnRenamed("_one_before", "ordinal")
    n = df.agg(F.count(F.lit(1))).scalar()
    size = F.floor(n / (folds + 1))
    fold = F.greatest(F.lit(0), F.floor((F.col("ordinal") - (n - size * folds)) / size) + 1)
    return placed.withColumn("fold", fold.cast("int")).drop("_order", "_one")


def seasonal_naive(
    df: DataFrame,
    lag_steps: int,
    key: str = schema.KEY,
    time: str = schema.TIME,
    value: str = schema.VALUE,
    bucket_seconds: float | None = BUCKET_SECONDS,
) -> DataFrame:
    """The reading ``lag_steps`` rows earlier as a forecast: (key, time, predicted_demand)."""
    lagged = lag_columns(df, [lag_steps], 1, key, time, value, [], bucket_seconds=bucket_seconds)
    return lagged.select(key, time, F.col(f"demand_previous_{lag_steps}_hour").alias("predicted_demand"))
