import pytest
from pyspark.sql import functions as F

from hourline import schema
from hourline.operators import clean, joins
from tests.helpers import at, hours, series, values


def test_clean_demand(spark):
    raw = spark.createDataFrame(
        [
            ("2025-02-15T00:00:00Z", "ZONA", "2000"),
            ("2025-02-15T01:00:00Z", "ZONB", "2100"),
            ("2025-02-15T02", "ZONK", "n/a"),
            ("2025-02-15T03", "ZONX", "5"),
        ],
        "period string, subba string, value string",
    )
    got = values(clean.clean_demand(raw), "date", "sub_region_code", "demand")
    assert sorted(got) == sorted(
        [
            ("2025-02-15 00:00:00", 0, 2000.0),
            ("2025-02-15 01:00:00", 1, 2100.0),
            ("2025-02-15 02:00:00", 10, None),
            ("2025-02-15 03:00:00", None, 5.0),
        ]
    , key=lambda r: r[0])


def test_boundary_hour_is_kept_once(spark):
    raw = spark.createDataFrame(
        [("2025-02-16T00", "ZONA", "1", "2025-02-16"), ("2025-02-16T00", "ZONA", "2", "2025-02-15")],
        "period string, subba string, value string, day string",
    )
    first = clean.clean_demand(raw, order=[F.col("day")]).collect()
    assert [r["demand"] for r in first] == [2.0]
    assert clean.clean_demand(raw, dedupe=False).count() == 2


def test_dedupe_over_hot_key(spark):
    rows = [(0, i, "x") for i in range(500)] + [(k, 0, "y") for k in range(1, 20)]
    df = spark.createDataFrame(rows, "k bigint, v bigint, s string").repartition(7)
    got = clean.dedupe_first(df, ["k"], [F.col("v").desc()])
    assert values(got, "k", "v") == sorted([(0, 499)] + [(k, 0) for k in range(1, 20)], key=repr)


def test_rename_and_normalize(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Sub-BA` bigint, `Value Units` bigint, subba bigint")
    assert clean.normalize_names(df).columns == ["sub_ba", "value_units", "subba"]
    assert clean.rename_demand(df).columns == ["Sub-BA", "Value Units", "sub_region"]


@pytest.mark.parametrize("splits", [None, 3])
def test_label_encode(spark, splits):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "z string")
    got = values(clean.label_encode(df, "z", "code", splits=splits), "z", "code")
    assert got == sorted([("a", 0), ("a", 0), ("b", 1), ("c", 2), (None, None)], key=repr)


def test_holdout_uses_one_cutoff_for_all_zones(spark):
    rows = [(t, 0, 1.0) for t in hours("2025-01-01", 24 * 100)] + [(t, 1, 1.0) for t in hours("2025-01-01", 24)]
    df = spark.createDataFrame(rows, "date timestamp, sub_region_code bigint, demand double")
    train, test = clean.holdout_split(df)
    assert test.count() == 90 * 24 + 1 and train.count() == len(rows) - 90 * 24 - 1
    assert test.where("sub_region_code = 1").isEmpty()


def test_as_of_range_and_tail(spark):
    df = series(spark, 24 * 40, 1)
    late = clean.as_of_range(df, F.lit("2030-01-01").cast("timestamp"))
    assert late.count() == 29 * 24 + 1
    early = F.lit("2020-01-01").cast("timestamp")
    assert clean.as_of_range(df, early).isEmpty()
    assert clean.as_of_range_or_tail(df, early, tail=50).count() == 50
    assert clean.as_of_range_or_tail(df, F.lit("2025-01-02").cast("timestamp")).count() == 25


def test_guards(spark):
    df = series(spark, 30, 1)
    with pytest.raises(ValueError, match="nothing left"):
        clean.require_rows(df.where("demand < 0"), "nothing left")
    with pytest.raises(ValueError, match="hold no numbers"):
        clean.require_numeric(df.withColumn("s", F.lit("x")), ["demand", "s"])
    clean.require_numeric(df.drop("date"))
    good, bad = clean.split_rejects(df.withColumn("demand", F.when(F.col("hour") > 2, F.col("demand"))), ["demand", "date"])
    assert (good.count(), bad.count()) == (24, 6)


def test_fallback(spark):
    a, b = spark.range(3), spark.range(5)
    assert clean.fallback(a, b).count() == 3
    assert clean.fallback(a.where("id > 9"), b).count() == 5


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 2)], "x bigint, y bigint")
    b = spark.createDataFrame([(3, 4)], "z bigint, x bigint")
    assert values(clean.union_all(a, b), "x", "y", "z") == [(1, 2, None), (4, None, 3)]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_weather_join_both_ways(spark, limit):
    demand = spark.createDataFrame(
        [(t, z, 1.0 * z, "d") for t in hours("2025-01-01", 5) for z in range(3)] + [(None, 1, 1.0, "d")],
        "date timestamp, sub_region_code bigint, demand double, note string",
    )
    weather = spark.createDataFrame(
        [(t, 10.0, "w") for t in hours("2025-01-01T02:00:00", 9)] + [(None, 1.0, "w")], "date timestamp, temperature_2m double, note string"
    )
    got = joins.enrich_with_weather(demand, weather, broadcast_bytes=limit, task_rows=3)
    assert got.count() == 9 and {"note_x", "note_y"} < set(got.columns)
    left = joins.lookup_join(demand, weather.drop("note"), ["date"], "left", broadcast_bytes=limit)
    assert left.count() == 16 and left.where("temperature_2m is null").count() == 7


def test_hot_key_is_spread(spark):
    facts = spark.range(6000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert [r["k"] for r in joins.hot_keys(facts, ["k"], 100).collect()] == [0]
    for how in ("inner", "left"):
        got = joins.lookup_join(facts, lookup.where("k % 2 = 0"), ["k"], how, broadcast_bytes=0)
        truth = facts.join(lookup.where("k % 2 = 0"), "k", how)
        assert values(got, "k", "v", "w") == values(truth, "k", "v", "w")


def test_identical_rows_of_a_hot_key_are_spread(spark):
    facts = spark.range(4000).repartition(8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    lookup = spark.createDataFrame([(1, "w")], "k int, w string")
    joined = joins.lookup_join(facts, lookup, ["k"], broadcast_bytes=0)
    assert joined.count() == 4000
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "spark_partition_id" in plan.lower()


def test_size_check_measures_text(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.fits(df, 120_000) and not joins.fits(df, 90_000)
    assert not joins.fits(spark.range(10_000), 1000) and joins.fits(spark.range(0), 0)


def test_plan_of_both_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        demand, weather = series(spark, 10, 1).select("date", "demand"), series(spark, 10, 1).select("date", "hour")
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(joins.enrich_with_weather(demand, weather))
        large = plan(joins.enrich_with_weather(demand, weather, broadcast_bytes=5))
        assert "SortMergeJoin" in large and "_salt" in large
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_predictions_vs_actuals(spark):
    t = at("2025-01-01")
    p = spark.createDataFrame([(1, 10.0, t), (2, 20.0, t)], schema.PREDICTIONS_DDL)
    a = spark.createDataFrame([(1, t, 11.0, 9), (3, t, 12.0, 9)], "sub_region_code bigint, date timestamp, demand double, hour int")
    assert values(joins.predictions_vs_actuals(p, a), "sub_region_code", "predicted_demand", "demand") == [(1, 10.0, 11.0)]


def test_zone_names(spark):
    df = spark.createDataFrame([(9,), (42,), (None,)], "sub_region_code bigint")
    got = {r[0]: tuple(r)[1:] for r in joins.with_zone_names(df).collect()}
    assert got[9] == ("New York City", 40.7128, -74.006)
    assert got[42] == ("Zone 42", 42.0, -75.0)
    assert got[None][1:] == (42.0, -75.0)
    assert schema.zones(spark).count() == 11
