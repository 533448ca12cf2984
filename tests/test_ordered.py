import numpy as np
import pytest
from pyspark.sql import functions as F

from hourline.operators import ordered
from tests.helpers import hours, series


@pytest.mark.parametrize("bucket", [3600, 86400, 90 * 86400, None])
def test_number_rows(spark, bucket):
    df = series(spark, 100, 3).where("hour(date) % 5 <> 2")
    got = ordered.number_rows(df, bucket_seconds=bucket).toPandas()
    truth = df.toPandas().sort_values("date")
    truth["rn"] = truth.groupby("sub_region_code").cumcount() + 1
    both = truth.merge(got, on=["sub_region_code", "date"])
    assert len(both) == len(truth) and (both["rn_x"] == both["rn_y"]).all()


def test_dense_series_get_narrow_slots(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 100)
    df = spark.range(3000).select(
        (F.col("id") % 2).alias("sub_region_code"), F.timestamp_micros(1_700_000_000_000_000 + F.col("id") * 1000).alias("date")
    )
    numbered = ordered.number_rows(df, bucket_seconds=None)
    assert [r["n"] for r in numbered.groupBy("rn").agg(F.count("*").alias("n")).orderBy("rn").collect()] == [2] * 1500
    width = df.select(ordered._slot_width(df, "sub_region_code", F.unix_micros("date")).alias("w")).first()["w"]
    assert width == 90 * 86400 * 1_000_000 * 100 // 1500


@pytest.mark.parametrize("splits", [1, 2, 7, 64, ordered.MAX_SPLITS])
def test_running_totals(spark, splits):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("x"), (F.col("id") % 11).alias("n"))
    got = ordered.running_totals(df, "x", ["n"], following="nx", splits=splits).toPandas().sort_values("x")
    assert (got["n_before"].to_numpy() == np.concatenate([[0], got["n"].cumsum().to_numpy()[:-1]])).all()
    assert got["nx"].dropna().tolist() == got["x"].tolist()[1:]


@pytest.mark.parametrize("splits", [1, 5])
def test_running_totals_by_label(spark, splits):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("label"), F.col("id").cast("double").alias("x"), F.lit(2).alias("n")
    )
    got = ordered.running_totals(df, "x", ["n"], by="label", following="nx", splits=splits).toPandas()
    for _, part in got.sort_values("x").groupby("label"):
        assert part["n_before"].tolist() == [2 * i for i in range(len(part))]
        assert part["nx"].tolist()[:-1] == part["x"].tolist()[1:]


def test_running_totals_over_structs(spark):
    df = series(spark, 20, 3).select(F.struct("date", "sub_region_code").alias("o"), F.lit(1).alias("one"))
    for splits in (1, 9):
        rows = ordered.running_totals(df, "o", ["one"], splits=splits).orderBy("o").collect()
        assert [r["one_before"] for r in rows] == list(range(60))


def test_quantiles(spark):
    rng = np.random.default_rng(7)
    data = np.round(rng.gamma(2, 3, 777), 1)
    counts = spark.createDataFrame([(float(x),) for x in data], "x double").groupBy("x").agg(F.count("*").alias("n"))
    p = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r["p"]: r["quantile"] for r in ordered.quantiles(counts, "x", "n", p).collect()}
    for q in p:
        assert got[q] == pytest.approx(np.quantile(data, q), abs=1e-9)


def top_truth(rows, n):
    out = []
    for g in sorted({r[0] for r in rows}):
        out += sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:n]
    return sorted(out)


@pytest.mark.parametrize("threshold", ["1000", "10"])
def test_top_n_with_a_hot_group_and_copies(spark, threshold):
    rows = [(0, i % 13, "x") for i in range(400)] + [(0, 99, "same")] * 300 + [(1, i, "y") for i in range(10)]
    df = spark.createDataFrame(rows, "g bigint, v bigint, s string").repartition(5)
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        for n in (25, 301, 320):
            got = ordered.top_n(df, ["g"], [F.col("v").desc(), F.col("s")], n, spread=4)
            assert sorted(map(tuple, got.collect())) == top_truth(rows, n)
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)


def test_top_n_trims_before_the_shuffle(spark):
    df = ordered.top_n(series(spark, 50, 2), ["sub_region_code"], [F.col("date").desc()], 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Two levels, each trimmed on both sides of its exchange.
    lines = [next(w for w in ("WindowGroupLimit", "Exchange") if w in line) for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange" in line]
    assert lines == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"] * 2


def test_last_per_series(spark):
    df = series(spark, 30, 3)
    got = ordered.last_per_series(df, "sub_region_code", "date").collect()
    assert len(got) == 3 and {r["date"] for r in got} == {hours("2025-01-01", 30)[-1].replace(tzinfo=None)}
