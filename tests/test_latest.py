"""Latest vectors kept by a stream against the vectors of the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from hourline import plans, streaming
from hourline.operators.windows import latest_windows
from hourline.streaming import latest
from tests.helpers import at, hours, values

DDL = "sub_region_code bigint, date timestamp, demand double, kind string, hour bigint"
COLS = ("sub_region_code", "date", "demand_lags", "kind", "hour", "n_lags")


def drained(spark, root, rows, seq_len=5, fold=50):
    spark.createDataFrame(rows, DDL).repartition(3).write.mode("append").parquet(f"{root}/in")
    vectors = streaming.latest_vectors(streaming.read_stream(spark, f"{root}/in", DDL), seq_len, covariates=["kind", "hour"])
    return streaming.keep_latest(vectors, f"{root}/latest", f"{root}/state", fold=fold)


def test_late_rows_take_their_place(spark, tmp_path):
    rng = random.Random(3)
    rows = [(z, t, None if rng.random() < 0.2 else float(i), rng.choice(["a", None]), (1 << 60) + i) for z in (0, 1, 2) for i, t in enumerate(hours("2025-01-01", 12))]
    rows.append((3, at("2025-01-01"), 1.0, "b", None))
    rng.shuffle(rows)
    for n, part in enumerate((rows[:12], rows[12:20], rows[20:])):
        got = drained(spark, str(tmp_path), part, fold=2)
        seen = spark.createDataFrame(rows[: (12, 20, len(rows))[n]], DDL)
        assert values(got, *COLS) == values(latest_windows(seen, 5, covariates=["kind", "hour"]), *COLS)


def test_later_batches_replace_readings(spark, tmp_path):
    t = hours("2025-01-01", 7)
    root = str(tmp_path)
    drained(spark, root, [(0, x, 5.0, "a", 1) for x in t] + [(0, t[6], None, "z", 9), (0, t[6], 4.0, "z", 9), (0, t[6], 5.0, "b", 2)])
    first = values(streaming.read_latest(spark, f"{root}/latest", spark.read.parquet(f"{root}/latest").drop("batch", "whole").schema), *COLS)
    assert first == [(0, "2025-01-01 06:00:00", [5.0] * 5, "b", 2, 5)]
    # Smaller, null and NaN readings replace too; one before the window, one of no key and one of no time change nothing.
    got = drained(spark, root, [(0, t[6], 1.0, "c", 3), (0, t[5], None, "d", 4), (0, t[4], float("nan"), "e", 5), (0, t[0], 9.0, "f", 6), (None, t[0], 9.0, "f", 6), (0, None, 9.0, "f", 6)])
    assert values(got, *COLS) == [(0, "2025-01-01 06:00:00", [5.0, 5.0, None, None, 1.0], "c", 3, 5)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    root, t = str(tmp_path), hours("2025-01-01", 3)
    for i, x in enumerate(t):
        got = drained(spark, root, [(z, x, float(i), "a", i) for z in range(3 - i)], fold=2)
    before, columns = values(got, *COLS), got.schema
    assert [r[5] for r in before] == [3, 2, 1]
    for batch in (1, 2):
        again = spark.read.schema(columns).parquet(f"{root}/latest/batch={batch}/*")
        changed = again if batch == 1 else again.where("sub_region_code = 0")
        latest.latest_writer(f"{root}/latest", columns, fold=2)(spark.createDataFrame(changed.collect(), columns), batch)
    assert values(streaming.read_latest(spark, f"{root}/latest", columns), *COLS) == before
    # The third batch holds all series, so the older folders are not needed.
    kept = spark.read.schema(columns).parquet(f"{root}/latest/batch=2/*")
    assert values(kept, *COLS) == before
    assert streaming.read_latest(spark, f"{root}/nothing", columns).count() == 0


@pytest.mark.parametrize("gathered,most", [(50_000, 500_000), (10, 500_000), (10, 20)])
def test_tasks_send_what_can_still_count(spark, monkeypatch, gathered, most):
    monkeypatch.setattr(latest, "GATHERED_ROWS", gathered)
    monkeypatch.setattr(latest, "KEPT_ROWS", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(0, (i * 37) % 400, float(i % 5)) for i in range(2000)] + [(1, 5, None), (1, 5, 1.0), (1, 6, None)]
        df = spark.createDataFrame(rows, "key long, at long, reading double").repartition(2)
        got = streaming.trim_recent(df, 10, "key", "at", "reading").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    best = {k: max((r[2] for r in rows if (r[0], r[1]) == k and r[2] is not None), default=None) for k in {r[:2] for r in rows}}
    wanted = {(k, t): v for (k, t), v in best.items() if k == 1 or t >= 390}
    found = {}
    for r in got:
        kept = found.get((r[0], r[1]))
        found[(r[0], r[1])] = r[2] if kept is None else max(kept, r[2] if r[2] is not None else kept)
    assert {k: found.get(k) for k in wanted} == wanted
    if most > 1000:
        assert len(got) <= 2 * 12


def test_kept_vectors_are_ready_for_a_prediction(spark, tmp_path):
    t = hours("2025-01-01", 6)
    got = drained(spark, str(tmp_path), [(0, x, 1.0, "a", 1) for x in t] + [(1, t[0], 1.0, "a", 1)])
    ready, short = plans.vector_inputs(got, F.lit("2025-01-01 06:30:00").cast("timestamp"), 5)
    assert values(ready, "sub_region_code", "date", "feature_time") == [(0, "2025-01-01 06:00:00", "2025-01-01 05:00:00")]
    assert values(short, "sub_region_code") == [(1,)]
