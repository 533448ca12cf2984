"""Intake that goes on: replayed micro-batches, unsettled days, both weather sources, documents that cannot be read."""

import json
import os

import pytest
from pyspark.sql import functions as F

from hourline import jobs, sinks, sources, streaming
from tests.helpers import at, hours, values

DDL = "sub_region_code bigint, date timestamp, demand double"
KEYS = ["sub_region_code", "date"]


def land(spark, path, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return streaming.read_stream(spark, path, DDL)


def test_replayed_batches_change_nothing(spark, tmp_path):
    landing, path, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    t = hours("2025-01-01", 30)
    land(spark, landing, [(0, x, 1.0) for x in t])
    first = values(streaming.keep_keyed(stream(spark, landing), path, state, KEYS), *KEYS, "demand")
    # Spark's own commit of the batch is lost: it sends the batch again, the ledger knows it.
    os.remove(f"{state}/checkpoint/commits/0")
    for crc in (f"{state}/checkpoint/commits/.0.crc",):
        if os.path.exists(crc):
            os.remove(crc)
    assert values(streaming.keep_keyed(stream(spark, landing), path, state, KEYS), *KEYS, "demand") == first
    land(spark, landing, [(0, t[-1], 5.0), (1, t[0], 7.0)])
    got = streaming.keep_keyed(stream(spark, landing), path, state, KEYS)
    assert got.count() == 31 and got.where("demand = 5").count() == 1
    before = values(got, *KEYS, "demand")
    streaming.keyed_writer(path, f"{state}/ledger", KEYS)(spark.createDataFrame([(0, t[-1], 1.0)], DDL), 0)
    assert values(spark.read.parquet(path), *KEYS, "demand") == before
    ledger = spark.read.parquet(f"{state}/ledger").orderBy("batch")
    assert [(r["batch"], r["rows"], r["days"]) for r in ledger.collect()] == [(0, 30, 2), (1, 2, 2)]


def test_a_batch_without_its_ledger_row_is_merged_again(spark, tmp_path):
    path, ledger = str(tmp_path / "table"), str(tmp_path / "ledger")
    rows = spark.createDataFrame([(0, x, 1.0) for x in hours("2025-01-01", 5)], DDL)
    sinks.upsert_keyed(rows, path, KEYS)
    streaming.keyed_writer(path, ledger, KEYS)(rows, 0)
    assert spark.read.parquet(path).count() == 5 and streaming.batch_is_kept(spark, ledger, 0)
    streaming.keyed_writer(path, ledger, KEYS)(rows.limit(0), 1)
    assert spark.read.parquet(path).count() == 5 and streaming.batch_is_kept(spark, ledger, 1)
    assert not streaming.batch_is_kept(spark, ledger, 2) and not streaming.batch_is_kept(spark, ledger, 0, "other")


def envelopes(spark, root, days, value):
    rows = [(t.date(), t.strftime("%Y-%m-%dT%H"), z, value) for t in hours("2025-01-01", 24 * days) for z in ("ZONA", "ZONJ")]
    sinks.write_landed_demand(spark.createDataFrame(rows, "day date, period string, subba string, value string"), root)


@pytest.fixture
def root(spark, tmp_path):
    places = jobs.Locations(str(tmp_path))
    envelopes(spark, places.arrivals, 10, "100")
    for name, value in (("weather_archive", 1.0), ("weather_forecast", 2.0)):
        start = int(at("2024-12-31").timestamp())
        block = {"start": start, "end": start + 240 * 3600, "interval": 3600} | {m: [value] * 240 for m in sources.weather.MEASURES}
        os.makedirs(getattr(places, name))
        with open(f"{getattr(places, name)}/a.json", "w") as f:
            f.write(json.dumps(block) + "\n")
    return places


def test_only_unsettled_and_missing_days_are_read_again(spark, root):
    now = lambda s: F.lit(s).cast("timestamp")
    first = jobs.refresh_demand(spark, root, "2025-01-01", "2025-01-08", now("2025-01-08 12:00:00"))
    assert {r["action"] for r in first.collect()} == {"landed"}
    stamps = {d: os.stat(f"{root.demand}/day={d}").st_mtime_ns for d in ("2025-01-03", "2025-01-07", "2025-01-08")}
    envelopes(spark, root.arrivals, 10, "200")
    second = {str(r["day"]): (r["action"], r["rows"]) for r in jobs.refresh_demand(spark, root, "2025-01-01", "2025-01-12", now("2025-01-09 12:00:00")).collect()}
    assert second["2025-01-07"] == ("kept", 0) and second["2025-01-08"] == ("replaced", 48) and second["2025-01-10"] == ("landed", 48)
    assert second["2025-01-12"] == ("none", 0)
    assert all((os.stat(f"{root.demand}/day={d}").st_mtime_ns == s) == (d < "2025-01-08") for d, s in stamps.items())
    got = sources.landed_demand(spark, root.demand).groupBy("day").agg(F.max("value").alias("v"), F.min("value").alias("w")).collect()
    assert all(r["v"] == r["w"] == ("200" if str(r["day"]) >= "2025-01-08" else "100") for r in got) and len(got) == 10


def test_feature_job_from_the_sources(spark, root):
    as_of = F.lit("2025-01-10 12:00:00").cast("timestamp")
    with open(f"{root.arrivals}/day=2025-01-02/extra.txt", "w") as f:
        f.write("no json\n")
    features = jobs.run_features(spark, root, "2025-01-01", "2025-01-10", as_of=as_of)
    assert features.count() == 9 * 48 and {r[0] for r in features.select("temperature_2m").distinct().collect()} == {2.0}
    assert spark.read.parquet(root.bad_documents).count() == 0  # the bad document never landed
    os.makedirs(f"{root.demand}/day=2025-01-03", exist_ok=True)
    with open(f"{root.demand}/day=2025-01-03/bad.txt", "w") as f:
        f.write("no json\n")
    assert jobs.run_features(spark, root, "2025-01-01", "2025-01-10", as_of=as_of).count() == 9 * 48
    bad = spark.read.parquet(root.bad_documents).first()
    assert bad["document"] == "no json" and str(bad["day"]) == "2025-01-03" and bad["file"].endswith("bad.txt")
    late = F.lit("2025-04-03 00:00:00").cast("timestamp")  # 85 days on: up to January 8 the archive counts
    mixed = jobs.stored_weather(spark, root, late).groupBy("temperature_2m").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    assert {r["temperature_2m"]: str(r["b"]) for r in mixed.collect()} == {1.0: "2025-01-08 23:00:00", 2.0: "2025-01-09 23:00:00"}


def test_intake_job_keeps_the_latest_version(spark, tmp_path):
    places = jobs.Locations(str(tmp_path))
    os.makedirs(places.incoming)

    def arrive(name, rows):
        with open(f"{places.incoming}/{name}.json", "w") as f:
            f.write(json.dumps({"response": {"data": [dict(zip(("period", "subba", "value", "parent"), r)) for r in rows]}}) + "\nno json\n")

    arrive("a", [("2025-01-01T00", "ZONA", "1", "NYIS"), ("2025-01-01T01", "ZONA", "2", "NYIS"), ("bad", "ZONA", "3", "NYIS")])
    jobs.run_intake(spark, places)
    arrive("b", [("2025-01-01T01", "ZONA", "9", "NYIS"), ("2025-01-02T01", "ZONB", "4", "NYIS")])
    got = jobs.run_intake(spark, places)
    assert values(got, "subba", "date", "value") == [
        ("ZONA", "2025-01-01 00:00:00", "1"), ("ZONA", "2025-01-01 01:00:00", "9"), ("ZONB", "2025-01-02 01:00:00", "4")
    ]
