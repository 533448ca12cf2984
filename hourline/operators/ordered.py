"""Order-dependent building blocks that never put a whole series, or a whole table, into one task.

``Window.partitionBy(zone)`` sends every row of a zone to one task, and a window without a partition sends everything
to one. Both fail when a single zone holds a third of the data, so positions and running totals are made in two levels:
ordered slices are counted first (a tiny table), and every slice is then numbered on its own from a known offset.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BUCKET_SECONDS = 90 * 86400
ROWS_PER_TASK = 1_000_000
#: Bounds the split points that every task gets, 128 KB a label; reached at four thousand million different values.
MAX_SPLITS = 16_384
MAX_SLOTS = 100_000
OVERSAMPLE = 16


def number_rows(
    df: DataFrame,
    key: str = "sub_region_code",
    time: str = "date",
    bucket_seconds: float | None = BUCKET_SECONDS,
    rn: str = "rn",
) -> DataFrame:
    """Add ``rn``, the 1-based position of every row inside its series by time.

    A task holds one series for one time bucket: 90 days are some two thousand hourly or eight million secondly rows.
    For denser series ``bucket_seconds=None`` measures the width. Rows without key or time have no position and are left
    out, see ``operators.clean.split_rejects``; (key, time) must be unique, see ``operators.clean.dedupe_first``.
    """
    present = df.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    width = _slot_width(present, key, micros) if bucket_seconds is None else F.lit(int(bucket_seconds * 1_000_000))
    keyed = present.withColumn("_slot", F.floor(micros / width))
    counts = keyed.groupBy(key, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(key).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(key, "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = keyed.withColumn("_local", F.row_number().over(W.partitionBy(key, "_slot").orderBy(time)))
    return (
        local.join(offsets, [key, "_slot"], "left")
        .withColumn(rn, F.col("_before") + F.col("_local"))
        .select(*df.columns, rn)
    )


def _slot_width(df: DataFrame, key: str, micros: Column) -> Column:
    """Bucket width in microseconds, as a scalar subquery.

    90 days, or less where the densest 90 days of a series hold more than a million rows, but never so little that the
    whole time span falls into more than ``MAX_SLOTS`` buckets.
    """
    whole = BUCKET_SECONDS * 1_000_000
    per_bucket = df.groupBy(key, F.floor(micros / whole).alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(micros).alias("_from"), F.max(micros).alias("_to")
    )
    narrow = F.least(F.lit(float(whole)), F.lit(float(whole)) * ROWS_PER_TASK / F.max("_n"))
    span = (F.max("_to") - F.min("_from")) / MAX_SLOTS
    return per_bucket.agg(F.greatest(F.floor(F.greatest(narrow, span)), F.lit(1))).scalar()


def running_totals(
    df: DataFrame,
    order: str,
    sums: list[str],
    by: str | None = None,
    following: str | None = None,
    splits: int | None = None,
) -> DataFrame:
    """Add ``<sum>_before``: the total of all rows that come earlier in ``order`` (within ``by``).

    ``order`` must be unique inside a group and may be a struct. ``following`` names a column for the next order value.
    ``by`` is a label with few values, such as a column name. With ``splits`` unset the row count decides: up to a
    million rows one task per group does it; beyond that the order values are cut at split points sampled by hash, so a
    re-run task always sees the same cut.
    """
    rows = max(1, df.count()) if splits is None or splits > 1 else 1
    if splits is None:
        splits = 1 if rows <= ROWS_PER_TASK else min(MAX_SPLITS, math.ceil(4 * rows / ROWS_PER_TASK))
    group = [by] if by else []
    if splits <= 1:
        return _within(df, group, order, sums, following)

    # About OVERSAMPLE values per slice, chosen by their hash, and every so-manieth of them as a split point.
    one_in = max(1, rows // (splits * OVERSAMPLE))
    sampled = df.select(*group, order).where(F.pmod(F.xxhash64(order), F.lit(one_in)) == 0)
    points = sampled.groupBy(*group).agg(F.sort_array(F.collect_list(order)).alias("_sample"))
    stride = F.ceil((F.size("_sample") + 1) / splits)
    points = points.select(*group, F.filter("_sample", lambda _, i: (i + 1) % stride == 0).alias("_points"))
    # Looked up in two steps, first among every `jump`-th point, so that a row is compared with few of them.
    jump = math.ceil(math.sqrt(splits))
    points = points.select(
        *group, F.struct("_points", F.filter("_points", lambda _, i: (i + 1) % jump == 0).alias("_coarse")).alias("_cut")
    )
    if by:
        # One row of at most `splits` values for each of the few labels in `by`.
        cut = df.join(F.broadcast(points), by, "left")
    else:
        cut = df.withColumn("_cut", points.select("_cut").scalar())
    not_after = lambda p: p <= F.col(order)
    passed = F.size(F.filter("_cut._coarse", not_after)) * jump
    near = F.size(F.filter(F.slice("_cut._points", passed + 1, F.lit(jump)), not_after))
    cut = cut.withColumn("_slice", F.greatest(passed + near, F.lit(0))).drop("_cut")

    totals = cut.groupBy(*group, "_slice").agg(
        F.min(order).alias("_first"), *[F.sum(s).alias(f"_{s}_total") for s in sums]
    )
    ordered = W.partitionBy(*group).orderBy("_slice")
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        "_slice",
        F.lead("_first").over(ordered).alias("_next_first"),
        *[F.coalesce(F.sum(f"_{s}_total").over(earlier), F.lit(0)).alias(f"_{s}_offset") for s in sums],
    )
    local = _within(cut, [*group, "_slice"], order, sums, following)
    # One row per slice: at most `splits` for each label. Every slice has its row; a left join keeps the optimizer from
    # evaluating the slice a second time in a null check.
    out = local.join(F.broadcast(offsets), [*group, "_slice"], "left")
    shifted = {f"{s}_before": F.col(f"{s}_before") + F.col(f"_{s}_offset") for s in sums}
    if following:
        shifted[following] = F.coalesce(F.col(following), F.col("_next_first"))
    wanted = [*df.columns, *[f"{s}_before" for s in sums], *([following] if following else [])]
    return out.withColumns(shifted).select(*wanted)


def _within(df: DataFrame, group: list[str], order: str, sums: list[str], following: str | None) -> DataFrame:
    ordered = W.partitionBy(*group).orderBy(order)
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    added = {f"{s}_before": F.coalesce(F.sum(s).over(earlier), F.lit(0)) for s in sums}
    if following:
        added[following] = F.lead(order).over(ordered)
    return df.withColumns(added)


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, spread: int = 64) -> DataFrame:
    """The first ``n`` rows of every group, ties broken by the columns in ``order``.

    The rows of a group are spread over ``spread`` tasks, trimmed there, and only the survivors meet in one task, since
    even ``n`` rows from each of many map tasks are too many for one. Spark trims every map task to ``n`` rows by itself
    as long as ``n`` is below its group-limit threshold; above it identical rows are counted rather than moved.
    """
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= threshold:

        def first(part: DataFrame, keys: list[str]) -> DataFrame:
            ranked = part.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
            return ranked.where(F.col("_rank") <= n).drop("_rank")

        if n > 1:
            df = first(df.withColumn("_spread", F.pmod(F.spark_partition_id(), F.lit(spread))), [*group, "_spread"]).drop("_spread")
        return first(df, group)

    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    rows = rows.withColumn("_spread", F.pmod(F.xxhash64(*df.columns), F.lit(spread)))

    def trim(part: DataFrame, keys: list[str]) -> DataFrame:
        earlier = W.partitionBy(*keys).orderBy(*order, *df.columns).rowsBetween(W.unboundedPreceding, -1)
        seen = part.withColumn("_seen", F.coalesce(F.sum("_copies").over(earlier), F.lit(0)))
        return seen.where(F.col("_seen") < n)

    kept = trim(trim(rows, [*group, "_spread"]), group)
    copies = F.least(F.col("_copies"), F.lit(n) - F.col("_seen")).cast("int")
    return kept.select(*df.columns, F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def last_per_series(df: DataFrame, key: str, time: str) -> DataFrame:
    """The newest row of every series, as a plain aggregate with map-side combine."""
    rest = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*rest), time).alias("_row"))
    return newest.select(key, "_row.*").select(*df.columns)


def quantiles(counts: DataFrame, value: str, count: str, probabilities: list[float], by: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation, from a (value, count) table.

    Returns (by, p, quantile). Positions are looked up in the running counts, so no task sees all values.
    """
    group = [by] if by else []
    total = counts.groupBy(*group).agg(F.sum(count).alias("_total"))
    running = running_totals(counts.where(F.col(count) > 0), value, [count], by)
    wanted = total.select(*group, "_total", F.explode(F.array(*map(F.lit, probabilities))).alias("p")).withColumn(
        "_position", F.col("p") * (F.col("_total") - 1)
    )
    arrays = wanted.groupBy(*group).agg(F.collect_list(F.struct("p", "_position")).alias("_wanted"))
    # One row per label of `by`, each with one entry per probability.
    if by:
        hit = running.join(F.broadcast(arrays), by)
    else:
        hit = running.withColumn("_wanted", arrays.select("_wanted").scalar())
    low, high = F.col(f"{count}_before"), F.col(f"{count}_before") + F.col(count) - 1
    hit = hit.withColumn("_w", F.explode(F.filter("_wanted", lambda w: (F.ceil(w["_position"]) >= low) & (F.floor(w["_position"]) <= high))))
    position = F.col("_w._position")
    below = F.when((F.floor(position) >= low) & (F.floor(position) <= high), F.col(value))
    above = F.when((F.ceil(position) >= low) & (F.ceil(position) <= high), F.col(value))
    ends = hit.groupBy(*group, F.col("_w.p").alias("p"), position.alias("_position")).agg(
        F.max(below).alias("_below"), F.max(above).alias("_above")
    )
    share = F.col("_position") - F.floor("_position")
    return ends.select(*group, "p", (F.col("_below") + share * (F.col("_above") - F.col("_below"))).alias("quantile"))
