"""Daily value counts: periods moved on by days equal periods counted anew."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hourline import plans
from hourline.operators import drift
from hourline.session import stage
from tests.helpers import hours, values

SPAN = {"reference_days": 40, "gap_days": 10, "current_days": 9}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    made = [(t, float(rng.randrange(6)), rng.choice(["a", "b", None])) for t in hours("2025-01-01", 24 * 80) if rng.random() < 0.5]
    return stage(spark.createDataFrame(made, "date timestamp, demand double, name string"), "rows").withColumn("gap", F.when(F.col("demand") < 2, F.lit(float("nan"))).otherwise(F.col("demand")))


@pytest.mark.parametrize("before,last", [(60, 61), (60, 60), (45, 79), (30, 75), (79, 60), (5, 12)])
def test_moved_on_equals_counted_anew(spark, rows, before, last):
    daily = drift.daily_counts(rows, ["demand", "gap"])
    day = lambda n: str(date(2025, 1, 1) + timedelta(days=n))
    moved = drift.roll_counts(drift.period_counts(daily, day(before), **SPAN), daily, day(before), day(last), **SPAN)
    cols = ("column", "x", "n_ref", "n_cur")
    assert values(moved, *cols) == values(drift.period_counts(daily, day(last), **SPAN), *cols)


def test_period_counts_equal_labelled_rows(rows):
    last = str(rows.agg(F.to_date(F.max("date"))).first()[0])
    cols = ("column", "x", "n_ref", "n_cur")
    for kind, columns in (("double", ["demand", "gap"]), ("string", ["name"])):
        plain = drift.value_counts(drift.label_periods(rows, "date", 40, 10, 9, whole_days=True), columns, kind)
        assert values(drift.period_counts(drift.daily_counts(rows, columns, kind=kind), last, **SPAN), *cols) == values(plain, *cols)


def test_one_day_reads_its_own_rows_and_the_edges(spark, rows, tmp_path):
    root = str(tmp_path)
    last = rows.agg(F.to_date(F.max("date"))).first()[0]
    at = lambda n: rows.where(F.to_date("date") == F.lit(last - timedelta(days=n)))
    plans.roll_drift(spark, rows.where(F.to_date("date") < F.lit(last)), ["demand"], root, str(last - timedelta(days=1)), **SPAN)
    report = values(plans.roll_drift(spark, at(0), ["demand"], root, str(last), **SPAN), "column", "score", "n_ref", "n_cur")
    labelled = drift.label_periods(rows, "date", 40, 10, 9, whole_days=True).select("period", "demand")
    plain = values(drift.drift_report(labelled), "column", "score", "n_ref", "n_cur")
    assert [r[0::2] for r in report] == [r[0::2] for r in plain] and report[0][1] == pytest.approx(plain[0][1])
    # Days that no period reaches any more are not kept, and a move by a day reads four of them.
    kept = spark.read.parquet(f"{root}/days")
    assert kept.agg(F.min("day")).first()[0] >= last - timedelta(days=42)
    empty = spark.createDataFrame([], "column string, x double, n_ref long, n_cur long")
    moved = drift.roll_counts(empty, kept, str(last - timedelta(days=1)), str(last), **SPAN)
    scan = moved._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in scan and "DataFilters: []" in scan
    # A day that changes inside the periods is taken into account.
    changed = plans.roll_drift(spark, at(3).withColumn("demand", F.lit(100.0)), ["demand"], root, str(last), **SPAN)
    swapped = labelled_with(rows, last - timedelta(days=3))
    assert changed.first()["score"] == pytest.approx(drift.drift_report(swapped).first()["score"])


def labelled_with(rows, day):
    new = rows.withColumn("demand", F.when(F.to_date("date") == F.lit(day), 100.0).otherwise(F.col("demand")))
    return drift.label_periods(new, "date", 40, 10, 9, whole_days=True).select("period", "demand")
