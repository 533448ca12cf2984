"""Sketches of days merged into periods against numpy on the rows themselves."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourline import plans
from hourline.operators import drift, sketches
from hourline.session import stage
from tests.helpers import hours, values

SPAN = {"reference_days": 40, "gap_days": 10, "current_days": 9}
LAST = "2025-02-19"


@pytest.fixture(scope="module")
def made():
    rng = random.Random(11)
    times = [t for t in hours("2025-01-01", 24 * 50) for _ in range(20)]
    return [(t, rng.choice([None, float("nan")]) if rng.random() < 0.1 else rng.gauss(1e6, 3.0), float(rng.randrange(4))) for t in times]


@pytest.fixture(scope="module")
def rows(spark, made):
    return stage(spark.createDataFrame(made, "date timestamp, wide double, narrow double"), "sketched-rows")


def present(made, place, period):
    last = date.fromisoformat(LAST)
    of = lambda t: "ref" if 10 <= (last - t.date()).days <= 40 else "cur" if (last - t.date()).days <= 9 else None
    chosen = [r[place] for r in made if of(r[0]) == period]
    return [x for x in chosen if x is not None and x == x], len(chosen)


def test_merged_days_equal_the_rows(spark, rows, made):
    daily = sketches.daily_sketches(rows, ["wide", "narrow"])
    found = {(r["period"], r["column"]): r for r in sketches.sketched_summary(sketches.period_sketches(daily, LAST, **SPAN)).collect()}
    assert len(found) == 4
    for (period, column), got in found.items():
        xs, n = present(made, 1 + (column == "narrow"), period)
        assert (got["n_values"], got["n_missing"], got["min"], got["max"]) == (len(xs), n - len(xs), min(xs), max(xs))
        # A mean far from zero would cost a difference of sums of squares its digits.
        assert got["mean"] == pytest.approx(np.mean(xs), rel=1e-12) and got["stddev"] == pytest.approx(np.std(xs, ddof=1), rel=1e-9)
        assert abs(got["n_distinct"] - len(set(xs))) <= 4 * sketches.distinct_error() * len(set(xs)) + 1
        for name, p in sketches.QUARTILES.items():
            below, up_to = np.mean(np.array(xs) < got[name]), np.mean(np.array(xs) <= got[name])
            assert below - 2 * sketches.rank_error() <= p <= up_to + 2 * sketches.rank_error()


def test_measured_gaps_see_a_wrong_quartile(spark, rows):
    labelled = rows.withColumn("period", drift.period_of(F.to_date("date"), LAST, **SPAN))
    found = sketches.sketched_summary(sketches.period_sketches(sketches.daily_sketches(rows, ["wide"]), LAST, **SPAN))
    right = sketches.rank_gaps(found, labelled, ["wide"])
    assert right.count() == 6 and right.agg(F.max("gap")).first()[0] <= 2 * sketches.rank_error()
    wrong = sketches.rank_gaps(found.withColumn("p25", F.col("p75")), labelled, ["wide"]).where("point = 'p25'")
    assert wrong.agg(F.min("gap")).first()[0] > 0.4


def test_rolled_days_replace_and_join_what_is_kept(spark, rows, tmp_path):
    root, day = str(tmp_path), F.to_date("date")
    before = str(date.fromisoformat(LAST) - timedelta(days=1))
    plans.roll_summary(spark, rows.where(day < F.lit(LAST)), ["wide"], root, before, **SPAN)
    changed = rows.where(day == F.lit("2025-02-15")).withColumn("wide", F.lit(7.0))
    got = plans.roll_summary(spark, changed.unionByName(rows.where(day == F.lit(LAST))), ["wide"], root, LAST, **SPAN)
    whole = rows.where(day != F.lit("2025-02-15")).unionByName(changed)
    plain = sketches.sketched_summary(sketches.period_sketches(sketches.daily_sketches(whole, ["wide"]), LAST, **SPAN))
    exact = ("period", "column", "n_values", "n_missing", "min", "max")
    assert values(got, *exact) == values(plain, *exact) and got.where("period = 'cur'").first()["min"] == 7.0


def test_columns_without_values_and_empty_tables(spark):
    ddl = "date timestamp, x double, y long"
    t = hours(LAST, 2)
    none = spark.createDataFrame([(t[0], None, 3), (t[1], float("nan"), None), (None, 1.0, 1)], ddl)
    found = sketches.sketched_summary(sketches.period_sketches(sketches.daily_sketches(none, ["x", "y"]), LAST, **SPAN))
    got = {r["column"]: r for r in found.collect()}
    assert got["x"]["n_missing"] == 2 and got["x"]["n_values"] == 0 and got["x"]["n_distinct"] == 0
    assert all(got["x"][c] is None for c in ("min", "p25", "p50", "p75", "max", "mean", "stddev"))
    assert got["y"]["p50"] == 3.0 and got["y"]["n_missing"] == 1 and got["y"]["stddev"] is None
    empty = sketches.daily_sketches(spark.createDataFrame([], ddl), ["x"])
    assert sketches.sketched_summary(sketches.period_sketches(empty, LAST, **SPAN)).count() == 0
