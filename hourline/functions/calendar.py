"""Calendar features of a UTC timestamp.

The holiday flag is a pure date expression, so it needs neither a holiday table, nor a join, nor the date range of the
input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MON, THU, FRI = 0, 3, 4

# Federal holidays as month · 100 + day. Those tied to a date move from Saturday to Friday and from Sunday
# to Monday; those tied to a weekday are the days of the month it can fall on.
DATED = [101, 704, 1111, 1225]
DATED_SINCE = {619: 2021}
MONDAYS = [(215, 221), (525, 531), (901, 907), (1008, 1014)]
MONDAYS_SINCE = {(115, 121): 1986}
THURSDAYS = [(1122, 1128)]


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _month_day(day: Column) -> Column:
    return F.month(day) * 100 + F.dayofmonth(day)


def _is_dated(day: Column) -> Column:
    code = _month_day(day)
    recent = [(code == dated) & (F.year(day) >= first) for dated, first in DATED_SINCE.items()]
    return _any([code.isin(DATED), *recent])


def is_federal_holiday(day: Column) -> Column:
    """True on the day a US federal holiday is observed."""
    weekday, code = F.weekday(day), _month_day(day)
    monday, friday = weekday == MON, weekday == FRI
    observed = (
        ((weekday <= FRI) & _is_dated(day))
        | (friday & _is_dated(F.date_add(day, 1)))
        | (monday & _is_dated(F.date_sub(day, 1)))
    )
    since = [code.between(*days) & (F.year(day) >= first) for days, first in MONDAYS_SINCE.items()]
    on_monday = monday & _any([*[code.between(*days) for days in MONDAYS], *since])
    on_thursday = (weekday == THU) & _any([code.between(*days) for days in THURSDAYS])
    return observed | on_monday | on_thursday


def is_holiday(time: Column, mode: str = "midnight") -> Column:
    """``midnight`` flags only the 00:00 row of a holiday, ``calendar_day`` flags all of its rows."""
    day = F.to_date(time)
    if mode == "calendar_day":
        return is_federal_holiday(day)
    if mode == "midnight":
        return (time == F.date_trunc("day", time)) & is_federal_holiday(day)
    raise ValueError("mode must be 'midnight' or 'calendar_day'")


def is_weekend(time: Column) -> Column:
    return F.weekday(time).isin(5, 6)


def federal_holidays(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per observed holiday in the closed range of days."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("day"))
    return days.where(is_federal_holiday(F.col("day")))


def calendar_columns(df: DataFrame, time: str = "date", holiday_mode: str = "midnight") -> DataFrame:
    """Add hour, day_of_week (Monday is 0), month, is_weekend and is_holiday as bigint."""
    t = F.col(time)
    return df.withColumns(
        {
            "hour": F.hour(t).cast("bigint"),
            "day_of_week": F.weekday(t).cast("bigint"),
            "month": F.month(t).cast("bigint"),
            "is_weekend": is_weekend(t).cast("bigint"),
            "is_holiday": is_holiday(t, holiday_mode).cast("bigint"),
        }
    )
