from hourline import streaming
from tests.helpers import at, hours, values

DDL = "sub_region_code bigint, date timestamp, demand double"


def land(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode(mode).parquet(path)


def test_repeats_are_dropped_across_files(spark, tmp_path):
    path = str(tmp_path / "in")
    t = hours("2025-01-01", 4)
    land(spark, path, [(0, x, 1.0) for x in t] * 3)
    land(spark, path, [(0, t[1], 1.0), (0, t[1], 9.0), (1, t[1], 2.0)])
    stream = streaming.read_stream(spark, path, DDL)
    got = streaming.drain(streaming.drop_duplicate_readings(stream, spread=4), "dedupe")
    assert values(got, "sub_region_code", "date") == values(
        spark.createDataFrame([(0, x, 0.0) for x in t] + [(1, t[1], 0.0)], DDL), "sub_region_code", "date"
    )


def test_static_enrichment(spark, tmp_path):
    path = str(tmp_path / "in")
    t = hours("2025-01-01", 4)
    land(spark, path, [(z, x, 1.0) for x in t for z in (0, 1)])
    wx = spark.createDataFrame([(x, 5.0) for x in t[:2]], "date timestamp, temperature_2m double")
    for limit in (1 << 20, 0):
        got = streaming.drain(streaming.enrich_stream(streaming.read_stream(spark, path, DDL), wx, broadcast_bytes=limit), "static")
        assert got.count() == 4 and got.columns == ["date", "sub_region_code", "demand", "temperature_2m"]


def test_stream_stream_match(spark, tmp_path):
    actual, forecast = str(tmp_path / "a"), str(tmp_path / "p")
    t = hours("2025-01-01", 6)
    land(spark, actual, [(0, x, 10.0) for x in t])
    land(spark, forecast, [(0, x, 11.0) for x in t[3:]] + [(1, t[0], 1.0)])
    p = streaming.read_stream(spark, forecast, DDL).withColumnRenamed("demand", "predicted_demand")
    got = streaming.drain(streaming.match_predictions(p, streaming.read_stream(spark, actual, DDL)), "match")
    assert got.count() == 3 and values(got, "predicted_demand", "demand") == [(11.0, 10.0)] * 3


def test_hours_close_behind_the_watermark(spark, tmp_path):
    path = str(tmp_path / "in")
    land(spark, path, [(0, at(f"2025-01-01T00:{m:02d}:00"), 0.1) for m in range(0, 60, 6)] + [(0, at("2025-01-05"), 1.0)])
    stream = streaming.read_stream(spark, path, DDL)
    got = streaming.drain(streaming.hourly_totals(stream, scale=2), "hours")
    assert values(got, "sub_region_code", "date", "demand") == [(0, "2025-01-01 00:00:00", 1.0)]


def test_matches_keep_few_state_entries_and_all_pairs(spark, tmp_path):
    """Many zones at one time, repeats, nulls, and readings that arrive a micro-batch after their predictions."""
    t = hours("2025-01-01", 3)
    forecast = [(z, x, float(z)) for z in range(3000) for x in t[:2]] + [(7, t[0], -1.0), (None, t[0], 1.0), (8, None, 1.0)]
    actual = [(z, x, z + 0.5) for z in range(1000, 4000) for x in t[1:]] + [(7, t[0], 0.5), (7, t[0], 0.6), (None, t[0], 1.0), (8, None, 1.0)]
    for name, parts in (("p", (forecast[::2], forecast[1::2])), ("a", (actual[:1000], actual[1000:]))):
        for part in parts:
            land(spark, str(tmp_path / name), part)
    p, a = (spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / n)) for n in ("p", "a"))
    with streaming.state_on_disk(spark):
        stream = streaming.match_predictions(p.withColumnRenamed("demand", "predicted_demand"), a)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    frames = [spark.createDataFrame(rows, DDL) for rows in (forecast, actual)]
    want = frames[0].withColumnRenamed("demand", "predicted_demand").join(frames[1], ["sub_region_code", "date"])
    assert got.columns == want.columns and got.count() == want.count() == 2004
    assert values(got, *got.columns) == values(want, *want.columns)
    progress = [s for q in query.recentProgress for s in q["stateOperators"]]
    assert len(query.recentProgress) >= 2 and 0 < max(s["numRowsTotal"] for s in progress) < 400
