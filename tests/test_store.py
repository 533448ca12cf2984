"""The store by day and bucket: what is replaced, what stays, and which plans do without a shuffle."""

import os
import re

import pytest
from pyspark.sql import functions as F

from hourline import plans, sinks
from hourline.operators import joins, windows
from tests.helpers import at, hours, values

DDL = "sub_region_code bigint, date timestamp, demand double"


def readings(spark, n, zones=4, start="2025-01-01", value=1.0):
    return spark.createDataFrame([(z, t, value * z) for t in hours(start, n) for z in range(zones)], DDL)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"(?<!Broadcast)Exchange ", plan_of(df)))


@pytest.fixture
def by_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_days_that_arrive_are_replaced(spark, tmp_path):
    path = str(tmp_path / "store")
    got = sinks.write_store(readings(spark, 96), path, bucket_rows=30)
    assert sinks.store_buckets(spark, path) == 4  # 96 rows a day at 30 each
    assert got.columns == ["sub_region_code", "date", "demand", "day"] and got.count() == 384
    stamps = {d: os.stat(f"{path}/rows/day=2025-01-0{d}").st_mtime_ns for d in (1, 2, 4)}
    again = readings(spark, 10, start="2025-01-03", value=5.0).select("demand", "date", "sub_region_code")
    got = sinks.write_store(again, path)
    counts = {str(r["day"]): r["count"] for r in got.groupBy("day").count().collect()}
    assert counts == {"2025-01-01": 96, "2025-01-02": 96, "2025-01-03": 40, "2025-01-04": 96}
    assert all(os.stat(f"{path}/rows/day=2025-01-0{d}").st_mtime_ns == s for d, s in stamps.items())
    assert got.where("day = '2025-01-03'").agg(F.max("demand")).first()[0] == 15.0


def test_one_file_for_each_day_and_bucket(spark, tmp_path):
    path = str(tmp_path / "store")
    got = sinks.write_store(readings(spark, 48, 8), path, buckets=4)
    placed = got.select("day", F.pmod(F.hash("sub_region_code", "date"), F.lit(4)).alias("b"), F.input_file_name().alias("file"))
    files = placed.groupBy("day", "b").agg(F.countDistinct("file").alias("n"))
    assert [r["n"] for r in files.collect()] == [1] * 8


def test_merge_keeps_the_newer_version(spark, tmp_path):
    path = str(tmp_path / "store")
    sinks.upsert_store(readings(spark, 48, 2), path)
    late = spark.createDataFrame([(1, at("2025-01-02T05:00:00"), 50.0), (9, at("2025-01-02T05:00:00"), 9.0), (9, at("2025-01-05"), 8.0)], DDL)
    for _ in range(2):  # again changes nothing
        got = sinks.upsert_store(late, path)
        assert got.count() == 98
        assert values(got.where("demand > 1"), "sub_region_code", "demand") == [(1, 50.0), (9, 8.0), (9, 9.0)]


def test_odd_rows_stay(spark, tmp_path):
    """Null keys, null times, repeated rows and odd names are kept; an empty table leaves an empty store."""
    t = at("2025-01-01")
    rows = spark.createDataFrame([(None, t, 1.0, "a"), (1, None, 2.0, None), (1, t, 3.0, "c"), (1, t, 3.0, "c")], DDL + ", `odd``name x` string")
    path = str(tmp_path / "it's" / "store")
    got = sinks.write_store(rows, path, buckets=2)
    assert values(got, "sub_region_code", "demand") == [(1, 2.0), (1, 3.0), (1, 3.0), (None, 1.0)] and got.columns[3] == "odd`name x"
    again = sinks.upsert_store(rows.where("date is null").withColumn("demand", F.lit(7.0)), path)
    assert values(again, "demand") == [(1.0,), (3.0,), (3.0,), (7.0,)]
    empty = sinks.write_store(rows.limit(0), str(tmp_path / "none"))
    assert empty.count() == 0 and sinks.store_buckets(spark, str(tmp_path / "none")) == 1
    with pytest.raises(ValueError, match="columns"):
        sinks.write_store(rows.drop("demand"), path)
    with pytest.raises(ValueError, match="own column"):
        sinks.write_store(rows.withColumn("Day", F.lit(1)), str(tmp_path / "clash"))
    with pytest.raises(FileNotFoundError):
        sinks.open_store(spark, str(tmp_path / "nothing"))


def test_another_session_sees_the_days(spark, tmp_path):
    path = str(tmp_path / "store")
    sinks.write_store(readings(spark, 48), path)
    name = plan_of(sinks.open_store(spark, path))
    table = re.search(r"hourline_[0-9a-f]{16}", name).group()
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    assert sinks.open_store(spark, path).count() == 192


def test_actuals_join_without_a_shuffle(spark, tmp_path, by_shuffle):
    facts = sinks.write_store(readings(spark, 96), str(tmp_path / "a"), buckets=4)
    made = readings(spark, 96, value=2.0).withColumnRenamed("demand", "predicted_demand")
    plain = plans.monitor(made, facts.drop("day"), F.lit("2025-01-03 02:00:00").cast("timestamp"))
    stored = sinks.write_store(made, str(tmp_path / "p"), buckets=sinks.store_buckets(spark, str(tmp_path / "a")))
    joined = plans.monitor(stored, facts, F.lit("2025-01-03 02:00:00").cast("timestamp"))
    assert exchanges(joined) == 0 and plan_of(joined).count("PartitionFilters: [isnotnull(day") == 2
    assert "SelectedBucketsCount: 4 out of 4" in plan_of(joined)
    columns = ("sub_region_code", "date", "demand", "predicted_demand")
    assert values(joined, *columns) == values(plain, *columns) and joined.count() == 100
    # Rows that are not stored move alone.
    assert exchanges(joins.predictions_vs_actuals(made, facts)) == 1


def test_groups_by_zone_without_a_shuffle(spark, tmp_path):
    stored = sinks.write_store(readings(spark, 60, 9), str(tmp_path / "z"), keys=["sub_region_code"], buckets=4)
    last = windows.last_rows(stored.select("sub_region_code", "date", "demand"))
    assert exchanges(last) == 0
    assert values(last, "sub_region_code", "date") == [(z, "2025-01-03 11:00:00") for z in range(9)]
