import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hourline import schema
from hourline.operators import windows
from tests.helpers import SERIES_DDL, at, hours, series, series_rows

SMALL = "date timestamp, sub_region_code bigint, demand double"


def brute(pdf, seq_len, step, value="demand"):
    """(zone, date) → (lags, target) by plain slicing."""
    out = {}
    for zone, part in pdf.sort_values("date").groupby("sub_region_code"):
        v, d = part[value].to_numpy(), part["date"].to_numpy()
        for i in range(0, len(v) - seq_len, step):
            out[(zone, pd.Timestamp(d[i + seq_len]))] = (v[i : i + seq_len], v[i + seq_len])
    return out


def found(df):
    return {
        (r[schema.KEY], pd.Timestamp(r["date"])): (np.array(r["demand_lags"], dtype=float), r[schema.TARGET])
        for r in df.collect()
    }


def same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        np.testing.assert_array_equal(a[k][0], b[k][0])
        assert a[k][1] == b[k][1] or (np.isnan(a[k][1]) and b[k][1] is None)


@pytest.mark.parametrize("seq_len,step,chunk,bucket", [(24, 1, None, 90 * 86400), (24, 5, 24, 36 * 3600), (30, 7, 41, 7200)])
def test_windows_equal_brute_force(spark, seq_len, step, chunk, bucket):
    df = series(spark, 200, 3)
    got = windows.lag_windows(df, seq_len, step, chunk_rows=chunk, bucket_seconds=bucket)
    same(found(got), brute(df.toPandas(), seq_len, step))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_windows_over_gappy_series(spark, data):
    """Rows, not hours, count: any subset of hours, any chunk length."""
    kept = data.draw(st.lists(st.integers(0, 300), min_size=12, max_size=60, unique=True))
    seq_len = data.draw(st.integers(2, 10))
    step = data.draw(st.integers(1, 4))
    chunk = data.draw(st.integers(seq_len, 40))
    t = hours("2025-01-01", 301)
    rows = [(t[i], i % 2, float(i)) for i in kept]
    df = spark.createDataFrame(rows, SMALL)
    got = windows.lag_windows(df, seq_len, step, covariates=[], chunk_rows=chunk, bucket_seconds=86400)
    same(found(got), brute(df.toPandas(), seq_len, step))


def test_null_keeps_its_slot(spark):
    rows = [(t, 0, None if i == 3 else float(i)) for i, t in enumerate(hours("2025-01-01", 8))]
    got = windows.lag_windows(spark.createDataFrame(rows, SMALL), 3, covariates=[]).orderBy("date").collect()
    assert [r["demand_lags"] for r in got] == [
        [0.0, 1.0, 2.0], [1.0, 2.0, None], [2.0, None, 4.0], [None, 4.0, 5.0], [4.0, 5.0, 6.0]
    ]
    assert got[0][schema.TARGET] is None


def test_missing_hour_shifts_rows_but_not_clock(spark):
    t = hours("2025-01-01", 8)
    df = spark.createDataFrame([(t[i], 0, float(i)) for i in range(8) if i != 4], SMALL)
    rows = windows.lag_windows(df, 3, covariates=[]).orderBy("date").collect()
    assert rows[-1]["demand_lags"] == [3.0, 5.0, 6.0]
    for chunk in (3, 5, 100):
        clock = windows.lag_windows(df, 3, covariates=[], lag_mode="time", chunk_rows=chunk).orderBy("date").collect()
        assert [r["demand_lags"] for r in clock] == [
            [0.0, 1.0, 2.0], [2.0, 3.0, None], [3.0, None, 5.0], [None, 5.0, 6.0]
        ]


@pytest.mark.parametrize("chunk", [3, 5, 100])
def test_several_rows_in_a_clock_step(spark, chunk):
    """The latest row of a step counts, of equal times the largest reading; later slots do not shift."""
    t = hours("2025-01-01", 8)
    once = [(t[i], 0, float(i)) for i in range(8)]
    more = [(t[2], 0, -1.0), (t[2], 0, 2.0), (t[5].replace(minute=1), 0, 50.0), (t[7], 0, None)]
    got = windows.lag_windows(spark.createDataFrame(once + more, SMALL), 3, covariates=[], lag_mode="time", chunk_rows=chunk)
    got = got.orderBy("date").collect()
    assert [r["demand_lags"] for r in got] == [[0.0, 1.0, 2.0], [1.0, 2.0, 3.0], [2.0, 3.0, 4.0], [3.0, 4.0, 50.0], [4.0, 50.0, 6.0]]
    assert [r[schema.TARGET] for r in got] == [3.0, 4.0, 50.0, 6.0, 7.0]


def test_latest_on_the_clock(spark):
    t = hours("2025-01-01", 8)
    rows = [(t[i], 0, float(i)) for i in range(8) if i != 5] + [(t[7], 1, 1.0), (t[6], 0, 9.0)]
    got = windows.latest_windows(spark.createDataFrame(rows, SMALL), 4, covariates=[], lag_mode="time").orderBy(schema.KEY).collect()
    assert [(r["demand_lags"], r["n_lags"]) for r in got] == [([4.0, None, 9.0, 7.0], 4), ([1.0], 1)]
    with pytest.raises(ValueError, match="lag_mode"):
        windows.latest_windows(spark.createDataFrame(rows, SMALL), 4, covariates=[], lag_mode="other")


def test_short_series_give_nothing(spark):
    rows = [(t, 0, 1.0) for t in hours("2025-01-01", 10)] + [(t, 1, 1.0) for t in hours("2025-01-01", 11)]
    got = windows.lag_windows(spark.createDataFrame(rows, SMALL), 10, covariates=[])
    assert [r[schema.KEY] for r in got.collect()] == [1]


def test_training_table_shape(spark):
    out = windows.features_and_target(series(spark, 1500, 2), 672, 10)
    assert out.count() == 2 * 83
    wide = windows.widen(out)
    lags = [c for c in wide.columns if c.startswith("demand_previous_")]
    assert lags[0] == "demand_previous_672_hour" and lags[-1] == "demand_previous_1_hour" and len(lags) == 672
    assert set(schema.COVARIATES) < set(wide.columns) and wide.columns[-1] == schema.TARGET
    row, array = wide.orderBy(schema.KEY, "date").first(), out.orderBy(schema.KEY, "date").first()["demand_lags"]
    assert [row[c] for c in lags] == array and None not in array


def test_training_table_errors(spark):
    with pytest.raises(ValueError, match="No valid time-series sequences"):
        windows.features_and_target(series(spark, 500, 1), 672, 1)
    with pytest.raises(ValueError, match="missing required columns"):
        windows.features_and_target(series(spark, 50, 1).drop("demand"), 672, 1)
    with pytest.raises(ValueError, match="input_seq_len must be >= 672"):
        windows.features_and_target(series(spark, 50, 1), 100, 1)
    with pytest.raises(ValueError, match="input_seq_len must be >= 24"):
        windows.check_parameters(23, 3)
    with pytest.raises(ValueError, match="cv_folds must be >= 2"):
        windows.check_parameters(672, 1)
    with pytest.raises(ValueError, match="lag_mode"):
        windows.lag_windows(series(spark, 50, 1), 4, lag_mode="other")


def test_covariates_come_from_the_target_row(spark):
    got = windows.lag_windows(series(spark, 60, 1), 24).orderBy("date").first()
    assert got["date"].hour == got["hour"] == 0 and got["day_of_week"] == 3


def test_seasonal_mean(spark):
    lags = [100.0 + k for k in range(672, 0, -1)]
    for k, v in ((168, 1000.0), (336, 2000.0), (504, 3000.0), (672, 4000.0)):
        lags[672 - k] = v
    df = spark.createDataFrame([(lags,)], "demand_lags array<double>")
    assert windows.seasonal_mean(df).first()["average_demand_last_4_weeks"] == 2500
    assert windows.seasonal_mean(windows.seasonal_mean(df)).columns.count("average_demand_last_4_weeks") == 1
    wide = windows.widen(df)
    assert windows.seasonal_mean(wide).first()["average_demand_last_4_weeks"] == 2500
    with pytest.raises(ValueError, match="or the columns"):
        windows.seasonal_mean(spark.createDataFrame([(1,)], "dummy_column bigint"))


def test_narrow_lags_match_the_arrays(spark):
    df = series(spark, 150, 2)
    arrays = {(r[0], r[1]): r[2] for r in windows.lag_windows(df, 48, 3).select(schema.KEY, "date", "demand_lags").collect()}
    narrow = windows.lag_columns(df, [1, 24, 48], 3).collect()
    assert len(narrow) == len(arrays)
    for r in narrow:
        a = arrays[(r[schema.KEY], r["date"])]
        assert (r["demand_previous_1_hour"], r["demand_previous_24_hour"], r["demand_previous_48_hour"]) == (a[-1], a[-24], a[0])


@pytest.mark.parametrize("step,expected", [(1, 899), (10, 90)])
def test_index_ranges(spark, step, expected):
    df = spark.range(1000).select(F.col("id").alias("demand"))
    got = windows.window_ranges(df, 100, step, block=64).orderBy("first").collect()
    assert len(got) == expected
    assert [tuple(r) for r in got[:3]] == [(i * step, i * step + 100, i * step + 101) for i in range(3)]
    assert got[-1]["last"] <= 999


def test_index_ranges_of_a_short_series(spark):
    assert windows.window_ranges(spark.range(10), 672, 1).count() == 0
    assert windows.window_ranges(spark.range(102), 100, 1).count() == 1


def test_latest_windows_include_the_newest_row(spark):
    df = series(spark, 40, 2).unionByName(series(spark, 5, 3).where("sub_region_code = 2"))
    got = {r[schema.KEY]: r for r in windows.latest_windows(df, 24).collect()}
    pdf = df.toPandas().sort_values("date")
    for zone, size in ((0, 24), (1, 24), (2, 5)):
        part = pdf[pdf.sub_region_code == zone]
        assert got[zone]["n_lags"] == size
        assert got[zone]["demand_lags"] == part["demand"].tolist()[-size:]
        assert got[zone]["temperature_2m"] == part["temperature_2m"].iloc[-1]


def test_tail_and_history(spark):
    df = series(spark, 300, 2)
    assert windows.tail_per_series(df, 168).groupBy(schema.KEY).count().collect()[0]["count"] == 168
    latest = windows.latest_windows(df, 24, covariates=[])
    back = windows.lag_history(latest.drop("n_lags")).where("sub_region_code = 1").orderBy("hour").collect()
    truth = df.where("sub_region_code = 1").orderBy(F.col("date").desc()).limit(24).orderBy("date").collect()
    assert [(r["hour"], r["demand"]) for r in back] == [(r["date"], r["demand"]) for r in truth]


@pytest.mark.parametrize("order", ["time", "concat"])
def test_expanding_folds(spark, order):
    df = series(spark, 53, 2)
    got = windows.expanding_folds(df, 3, order).toPandas()
    keys = ["date", "sub_region_code"] if order == "time" else ["sub_region_code", "date"]
    truth = df.toPandas().sort_values(keys).reset_index(drop=True)
    got = got.sort_values("ordinal").reset_index(drop=True)
    assert (got[keys].values == truth[keys].values).all()
    n, size = 106, 106 // 4
    for j in range(3):
        start = n - (3 - j) * size
        assert got.index[got["fold"] == j + 1].tolist() == list(range(start, start + size))
    assert (got["fold"] == 0).sum() == n - 3 * size


def test_folds_need_two(spark):
    with pytest.raises(ValueError, match="cv_folds"):
        windows.expanding_folds(series(spark, 10, 1), 1)


def test_seasonal_naive(spark):
    df = series(spark, 60, 2)
    got = windows.seasonal_naive(df, 24).toPandas()
    pdf = df.toPandas().sort_values("date")
    pdf["p"] = pdf.groupby("sub_region_code")["demand"].shift(24)
    both = got.merge(pdf.dropna(), on=["sub_region_code", "date"])
    assert len(both) == len(got) == 72 and (both["p"] == both["predicted_demand"]).all()


def test_rows_without_key_or_time_have_no_window(spark):
    rows = series_rows(30, 1) + [(None, 1.0, 0, 1.0, 0, 0, 1, 0, 0), (at("2025-01-01"), 1.0, None, 1.0, 0, 0, 1, 0, 0)]
    assert windows.lag_windows(spark.createDataFrame(rows, SERIES_DDL), 24).count() == 6
