from datetime import date

import pandas as pd
import pytest
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from hourline import functions as fn
from tests.helpers import at


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def test_holidays_equal_the_federal_calendar(spark):
    got = [r["day"] for r in fn.federal_holidays(spark, "1980-01-01", "2039-12-31").orderBy("day").collect()]
    truth = [t.date() for t in USFederalHolidayCalendar().holidays("1980-01-01", "2039-12-31")]
    assert got == truth
    assert date(2021, 12, 31) in got and date(2021, 6, 18) in got and date(2020, 6, 19) not in got


@pytest.mark.parametrize(
    "text,midnight,whole_day",
    [("2024-07-04 00:00:00", 1, 1), ("2024-07-04 01:00:00", 0, 1), ("2021-12-31 00:00:00", 1, 1), ("2024-07-05 00:00:00", 0, 0)],
)
def test_holiday_modes(spark, text, midnight, whole_day):
    t = F.lit(text).cast("timestamp")
    assert one(spark, fn.is_holiday(t).cast("int")) == midnight
    assert one(spark, fn.is_holiday(t, "calendar_day").cast("int")) == whole_day


def test_holiday_mode_is_checked(spark):
    with pytest.raises(ValueError):
        fn.is_holiday(F.lit(None).cast("timestamp"), "other")


def test_calendar_columns(spark):
    times = pd.date_range("2024-12-28", periods=24 * 10, freq="h", tz="UTC")
    df = spark.createDataFrame([(t.to_pydatetime(),) for t in times], "date timestamp")
    got = fn.calendar_columns(df).orderBy("date").toPandas()
    assert got["hour"].tolist() == times.hour.tolist()
    assert got["day_of_week"].tolist() == times.dayofweek.tolist()
    assert got["month"].tolist() == times.month.tolist()
    assert got["is_weekend"].tolist() == [int(d >= 5) for d in times.dayofweek]
    assert got.loc[got["is_holiday"] == 1, "date"].tolist() == [pd.Timestamp("2025-01-01")]
    assert dict(fn.calendar_columns(df).dtypes)["hour"] == "bigint"


def test_names():
    names = ["Sub-BA Name", "VALUE units ", " x", "a-b c"]
    assert [fn.normalized_name(n) for n in names] == ["sub_ba_name", "value_units_", "_x", "a_b_c"]


@pytest.mark.parametrize(
    "text,expected",
    [("2025-02-15T07", "2025-02-15 07:00:00"), ("2025-02-15T00:00:00Z", "2025-02-15 00:00:00"), ("nonsense", "None"), (None, "None")],
)
def test_parse(spark, text, expected):
    assert str(one(spark, fn.parse_utc(F.lit(text).cast("string")).cast("timestamp_ntz"))) == expected


def test_numbers(spark):
    assert one(spark, fn.to_number(F.lit("12.5"))) == 12.5
    assert one(spark, fn.to_number(F.lit("n/a"))) is None
    got = [one(spark, fn.round_half_even(F.lit(x))) for x in (0.5, 1.5, 2.5, -0.5, 2.51)]
    assert got == [0.0, 2.0, 2.0, 0.0, 3.0]


@pytest.mark.parametrize(
    "utc,local",
    [
        ("2025-03-09 06:59:00", "2025-03-09 01:59:00"),
        ("2025-03-09 07:00:00", "2025-03-09 03:00:00"),
        ("2025-11-02 05:59:00", "2025-11-02 01:59:00"),
        ("2025-11-02 06:00:00", "2025-11-02 01:00:00"),
    ],
)
def test_eastern_on_change_days(spark, utc, local):
    assert str(one(spark, fn.eastern(F.lit(utc).cast("timestamp")).cast("timestamp_ntz"))) == local


def test_color_scale(spark):
    def rgba(x, lo, hi):
        return one(spark, fn.color_scale(F.lit(x), F.lit(lo), F.lit(hi)))

    assert rgba(0.0, 0.0, 10.0) == [0, 200, 50, 200]
    assert rgba(10.0, 0.0, 10.0) == [255, 0, 50, 200]
    assert rgba(3.0, 0.0, 10.0) == [76, 140, 50, 200]
    assert rgba(5.0, 5.0, 5.0) == [127, 100, 50, 200]


def test_json_number(spark):
    doc = F.lit('{"current": {"temperature_2m": 15.5}}')
    assert one(spark, fn.json_number(doc, "$.current.temperature_2m", 10)) == 15.5
    assert one(spark, fn.json_number(doc, "$.current.weather_code", 0)) == 0.0
    assert one(spark, fn.json_number(F.lit(None).cast("string"), "$.x", 5)) == 5.0


def test_time_helpers(spark):
    t = F.lit("2025-02-15 07:31:05").cast("timestamp")
    assert one(spark, fn.iso_string(t)) == "2025-02-15T07:31:05"
    assert one(spark, fn.days_between(t, F.lit("2025-02-13 07:31:06").cast("timestamp"))) == 1
    assert one(spark, fn.days_between(F.lit("2025-02-13 00:00:00").cast("timestamp"), t)) == -3
    assert one(spark, fn.from_epoch(F.lit(0)).cast("timestamp_ntz")) == at("1970-01-01").replace(tzinfo=None)


def test_exact_sum(spark):
    df = spark.range(10).select((F.lit(0.1) + 0 * F.col("id")).alias("x"))
    assert df.agg(fn.exact_sum(F.col("x"), 2).alias("s")).first()["s"] == 1.0
