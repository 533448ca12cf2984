import json

import pytest
from pyspark.sql import functions as F

from hourline import schema, session, sinks, sources
from hourline.operators import profile
from tests.helpers import at, hours, series, values

RECORDS = "day date, period string, subba string, value string"


def envelope(*records):
    return json.dumps({"response": {"data": list(records)}}, indent=1)


def test_one_file_per_day(spark, tmp_path):
    files = {
        "2025-02-15": envelope(
            {"value": 2000, "period": "2025-02-15T00:00:00Z", "subba": "ZONA", "subba-name": "West"},
            {"value": 2100, "period": "2025-02-15T01:00:00Z", "subba": "ZONA"},
        ),
        "2025-02-16": "{}",
        "2025-02-17": envelope({"value": None, "period": "2025-02-17T00", "subba": "ZONB"}),
        "2025-02-18": '{"response": {"data": [{"value": 1',
        "2025-02-19": envelope({"value": 7, "period": "2025-02-19T00", "subba": "ZONC"}),
    }
    for day, text in files.items():
        (tmp_path / f"hourly_demand_{day}.json").write_text(text)
    (tmp_path / "other.json").write_text(envelope({"value": 1}))
    rows = sources.landed_files(spark, str(tmp_path))
    assert values(rows, "day", "subba", "value") == values(
        spark.sql(
            "select * from values (date'2025-02-15','ZONA','2000'),(date'2025-02-15','ZONA','2100'),"
            "(date'2025-02-17','ZONB',null),(date'2025-02-19','ZONC','7') t(day,subba,value)"
        ),
        "day", "subba", "value",
    )
    assert sources.landed_files(spark, str(tmp_path), "2025-02-16", "2025-02-17").count() == 1
    docs = sources.read_envelopes(spark, str(tmp_path), multiline=True, glob="hourly_demand_*.json")
    _, rejected = sources.unwrap(docs)
    assert sorted(r["file"][-15:-5] for r in rejected.select("file").collect()) == ["2025-02-16", "2025-02-18"]


def test_landing_replaces_only_its_days(spark, tmp_path):
    root = str(tmp_path / "landed")
    make = lambda rows: spark.createDataFrame(rows, "day string, period string, subba string, value string").withColumn("day", F.to_date("day"))
    sinks.write_landed_demand(make([("2025-02-15", "2025-02-15T00", "ZONA", "1"), ("2025-02-16", "2025-02-16T00", "ZONA", "2")]), root)
    sinks.write_landed_demand(make([("2025-02-16", "2025-02-16T00", "ZONA", "3")]), root)
    assert values(sources.landed_demand(spark, root), "period", "value") == [("2025-02-15T00", "1"), ("2025-02-16T00", "3")]
    assert sources.landed_demand(spark, root, "2025-02-16").count() == 1
    plan = sources.landed_demand(spark, root, "2025-02-16", "2025-02-16")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_day_spine(spark):
    got = [str(r["day"]) for r in sources.day_spine(spark, "2025-02-15", "2025-02-17").collect()]
    assert got == ["2025-02-15", "2025-02-16", "2025-02-17"]
    assert sources.day_spine(spark, "2025-02-17", "2025-02-15").isEmpty()


def test_request_filter(spark):
    rows = [(t, "NYIS", i) for i, t in enumerate(hours("2025-02-15", 30))] + [(at("2025-02-15"), "OTHER", 99)]
    df = spark.createDataFrame(rows, "period timestamp, parent string, id bigint")
    got = sources.request_filter(df)
    per_day = {str(r["day"]): r["count"] for r in got.groupBy("day").count().collect()}
    assert per_day == {"2025-02-14": 1, "2025-02-15": 25, "2025-02-16": 6}
    two = sources.request_filter(df, rows=2).where("day = date'2025-02-15'")
    assert sorted(r["id"] for r in two.collect()) == [23, 24]


def test_refresh_plan(spark):
    days = sources.day_spine(spark, "2025-02-13", "2025-02-16")
    plan = sources.refresh_plan(days, F.lit("2025-02-16 09:00:00").cast("timestamp")).orderBy("day")
    assert [(r["days_old"], r["use_landed"]) for r in plan.collect()] == [(3, True), (2, True), (1, False), (0, False)]


def test_blocks(spark):
    four = "temperature_2m array<double>, weather_code array<double>, relative_humidity_2m array<double>, wind_speed_10m array<double>"
    df = spark.createDataFrame(
        [(0, 7200, 3600, *[[1.0, 2.0]] * 4), (86400, 86400, 3600, *[[]] * 4)], f"start bigint, `end` bigint, interval bigint, {four}"
    )
    got = values(sources.expand_blocks(df), "date", "temperature_2m", "wind_speed_10m")
    assert got == [("1970-01-01 00:00:00", 1.0, 1.0), ("1970-01-01 01:00:00", 2.0, 2.0)]


def test_archive_wins_on_the_shared_day(spark):
    ddl = "date timestamp, temperature_2m double"
    archive = spark.createDataFrame([(t, 1.0) for t in hours("2025-01-01", 48)], ddl)
    forecast = spark.createDataFrame([(t, 2.0) for t in hours("2025-01-01", 72)], ddl)
    as_of = F.lit("2025-03-28 10:00:00").cast("timestamp")
    got = sources.combine_sources(archive, forecast, as_of)
    assert got.count() == 72
    assert {(r["day"], r["t"], r["n"]) for r in got.groupBy(F.dayofmonth("date").alias("day"), F.col("temperature_2m").alias("t")).agg(F.count("*").alias("n")).collect()} == {
        (1, 1.0, 24), (2, 1.0, 24), (3, 2.0, 24)
    }


def test_current_weather(spark):
    docs = [('{"current": {"temperature_2m": 15.5, "relative_humidity_2m": 65, "weather_code": 0, "wind_speed_10m": 5.2}}',), ("{}",), (None,)]
    got = values(sources.current_weather(spark.createDataFrame(docs, "doc string")), *sources.weather.MEASURES)
    assert got == [(10.0, 0.0, 50.0, 5.0), (10.0, 0.0, 50.0, 5.0), (15.5, 0.0, 65.0, 5.2)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_table_round_trip(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    df = series(spark, 50, 2)
    sinks.write_table(df, path, fmt)
    back = sources.read_table(spark, path, ", ".join(f"{c} {t}" for c, t in df.dtypes), fmt)
    assert values(back, *df.columns) == values(df, *df.columns)


def test_features_are_written_in_time_order(spark, tmp_path):
    path = str(tmp_path / "f")
    sinks.write_features(series(spark, 200, 3).repartition(5), path)
    names = spark.read.parquet(path).select("date", F.input_file_name().alias("f")).groupBy("f").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    spans = [(r["a"], r["b"]) for r in names.orderBy("f").collect()]
    assert len(spans) > 1 and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_missing_source(spark, tmp_path):
    for call in (lambda p: sources.read_table(spark, p, "x bigint"), lambda p: sources.read_document(spark, p, "x bigint")):
        with pytest.raises(FileNotFoundError, match="not found"):
            call(str(tmp_path / "nothing"))


def test_documents(spark, tmp_path):
    path = str(tmp_path / "status")
    sinks.write_document(spark.createDataFrame([(True,)], schema.STATUS_DDL), path)
    sinks.write_document(spark.createDataFrame([(False,)], schema.STATUS_DDL), path)
    assert [r[0] for r in sources.read_document(spark, path, schema.STATUS_DDL).collect()] == [False]


def test_prediction_history_grows(spark, tmp_path):
    path = str(tmp_path / "p")
    for h in (1, 2):
        sinks.keep_predictions(spark.createDataFrame([(0, float(h), at(f"2025-01-01T0{h}:00:00"))], schema.PREDICTIONS_DDL), path)
    assert spark.read.parquet(path).count() == 2


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    for step, score in (("XGBoost", 60.5), ("LightGBM", 61)):
        sinks.append_runs(sinks.run_row(spark, "tuning", step, {"max_depth": 5}, {"cv_best_rmse": score}, F.current_timestamp()), path)
    got = spark.read.schema(schema.RUNS_DDL).parquet(path).orderBy("step").collect()
    assert [(r["step"], r["params"], r["metrics"]) for r in got] == [
        ("LightGBM", {"max_depth": "5"}, {"cv_best_rmse": 61.0}), ("XGBoost", {"max_depth": "5"}, {"cv_best_rmse": 60.5})
    ]


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "runs")
    log = lambda run, step, score, run_id: sinks.log_runs(
        sinks.run_row(spark, run, step, {}, {"rmse": score}, F.current_timestamp()), path, run_id
    )
    log("tuning", "a", 1.0, "7")
    log("training", "a", 2.0, "7")
    log("tuning", "a", 3.0, "8")
    log("tuning", "b", 4.0, "7")
    got = spark.read.schema(schema.RUNS_DDL).parquet(path).select("run_id", "run", "step", F.col("metrics.rmse").alias("rmse"))
    assert values(got, *got.columns) == [("7", "training", "a", 2.0), ("7", "tuning", "b", 4.0), ("8", "tuning", "a", 3.0)]


def test_profile(spark):
    t = hours("2025-01-31T22:00:00", 4)
    df = spark.createDataFrame([(0, t[0]), (0, t[1]), (1, t[2]), (1, t[2]), (None, t[3]), (2, None)], "sub_region_code bigint, date timestamp")
    row = profile.table_profile(df).select("n_rows", "n_columns", "n_zones", F.col("first").cast("string"), F.col("last").cast("string")).first()
    assert tuple(row) == (6, 2, 3, "2025-01-31 22:00:00", "2025-02-01 01:00:00")
    months = profile.table_profile(df, by=[F.month("date")])
    assert values(months, "_by0", "n_rows", "n_zones") == sorted([(1, 2, 1), (2, 3, 1), (None, 1, 1)], key=repr)
    none = df.limit(0)
    assert tuple(profile.table_profile(none).first()) == (0, 2, None, None, 0)
    assert tuple(profile.date_bounds(none).first()) == (None, None) and profile.distinct_keys(none).count() == 0
    assert values(profile.distinct_keys(df), "sub_region_code") == sorted([(0,), (1,), (2,), (None,)], key=repr)
    assert [r[0] for r in profile.by_series(df).collect()] == [None, 0, 0, 1, 1, 2]


def test_upsert(spark, tmp_path):
    path, ddl = str(tmp_path / "k"), "sub_region_code bigint, date timestamp, demand double"
    t = hours("2025-01-01", 30)
    keys = ["sub_region_code", "date"]
    sinks.upsert_keyed(spark.createDataFrame([(0, x, 1.0) for x in t], ddl), path, keys)
    got = sinks.upsert_keyed(spark.createDataFrame([(0, t[29], 2.0), (1, t[29], 3.0)], ddl), path, keys)
    assert got.count() == 31
    assert values(got.where("demand > 1"), "sub_region_code", "demand") == [(0, 2.0), (1, 3.0)]


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_dir(spark)
    if configured:
        assert folder == configured.rstrip("/")
    staged = session.stage(spark.range(5), "t")
    assert staged.count() == 5 and all(f"{folder}/hourline/t-" in r[0] for r in staged.select(F.input_file_name()).collect())
