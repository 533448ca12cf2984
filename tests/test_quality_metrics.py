import math

import pytest
from pyspark.sql import functions as F

from hourline.operators.metrics import regression_cube, regression_metrics
from hourline.operators import metrics, present, quality
from tests.helpers import at

METRIC_CASES = [
    ([100, 200, 300, 400, 500], [110, 190, 310, 390, 510]),
    ([2000, 2100, 1900, 2200, 1800], [2010, 2080, 1920, 2180, 1810]),
]


def pairs(spark, y, p):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")


def test_metrics_of_every_grouping(spark):
    rows = [("a", 1, 10.0, 8.0), ("a", 2, 10.0, 10.0), ("b", 1, 20.0, 21.0), (None, 1, 5.0, 5.0), ("b", 2, None, 1.0)]
    df = spark.createDataFrame(rows, "zone string, month int, y double, p double")
    got = {(r["zone"], r["month"], r["grouping_id"]): r for r in regression_cube(df, "y", "p", ["zone", "month"]).collect()}
    assert len(got) == 5 + 3 + 2 + 1
    assert got["a", None, 1]["mse"] == 2.0 and got[None, None, 3]["n_samples"] == 4 and got[None, None, 1]["n_samples"] == 1
    plain = {r["month"]: r for r in regression_metrics(df, "y", "p", ["month"]).collect()}
    assert all(got[None, k, 2][c] == plain[k][c] for k in plain for c in ("mse", "mae", "mape", "rmse", "n_samples"))


@pytest.mark.parametrize("y,p", METRIC_CASES)
def test_metrics(spark, y, p):
    got = metrics.regression_metrics(pairs(spark, y, p), "y", "p").first()
    n, mean = len(y), sum(y) / len(y)
    sq = [(a - b) ** 2 for a, b in zip(y, p)]
    mape = sum(abs(a - b) / a for a, b in zip(y, p)) / n * 100
    assert got["mse"] == pytest.approx(sum(sq) / n) and got["rmse"] == pytest.approx(math.sqrt(sum(sq) / n))
    assert got["mae"] == pytest.approx(sum(abs(a - b) for a, b in zip(y, p)) / n)
    assert got["mape"] == pytest.approx(mape)
    assert got["r2_score"] == pytest.approx(1 - sum(sq) / sum((a - mean) ** 2 for a in y))
    assert got["forecast_improvement_percent"] == pytest.approx((10 - mape) / 10 * 100)
    assert got["n_samples"] == n and got["baseline_mape"] == 10.0


def test_known_values(spark):
    got = metrics.regression_metrics(pairs(spark, *METRIC_CASES[0]), "y", "p").first()
    assert got["mae"] == 10.0
    got = metrics.regression_metrics(pairs(spark, [100, 200, 300], [110, 190, 310]), "y", "p").first()
    assert 6.0 <= got["mape"] <= 6.2
    assert metrics.regression_metrics(pairs(spark, [1, 2, 3], [1, 2, 3]), "y", "p").first()["r2_score"] == 1


def test_edges(spark):
    zero = metrics.regression_metrics(pairs(spark, [0, 10], [1, 10]), "y", "p").first()
    assert zero["mape"] == pytest.approx(1 / 2.220446049250313e-16 / 2 * 100)
    assert metrics.regression_metrics(pairs(spark, [5, 5], [5, 5]), "y", "p").first()["r2_score"] == 1
    assert metrics.regression_metrics(pairs(spark, [5, 5], [5, 6]), "y", "p").first()["r2_score"] == 0


def table(spark, nulls, n=20):
    rows = [("s", at("2025-01-01"), "ZONA", None if i < nulls else 1.0, float("nan") if i < 1 else 2.0) for i in range(n)]
    return spark.createDataFrame(rows, "date_str string, date timestamp, subba string, value double, temperature_2m double")


def test_missing_share_at_the_threshold_passes(spark):
    got = {r["column"]: (r["value"], r["passed"]) for r in quality.missing_values(table(spark, 1)).collect()}
    assert got["value"] == (0.05, True) and got["temperature_2m"] == (0.05, True) and got["subba"] == (0.0, True)
    got = {r["column"]: r["passed"] for r in quality.missing_values(table(spark, 2)).collect()}
    assert got["value"] is False


def test_presence_and_types(spark):
    df = table(spark, 0).withColumn("n", F.lit(1))
    assert quality.missing_columns(df, {"value": "float", "other": "int"}) == ["other"]
    wrong = quality.type_mismatches(df, {"value": "float", "n": "int", "subba": "str", "date_str": "object", "date": "timestamp", "other": "int"})
    assert wrong == []
    assert quality.type_mismatches(df, {"value": "int", "n": "bigint", "subba": "float"}) == ["value", "n", "subba"]


def test_report_and_status(spark):
    status = lambda df, **kw: quality.validation_status(quality.quality_report(df, **kw)).first()[0]
    good = table(spark, 1)
    assert status(good) is True
    assert status(good, expected={"value": "float"}) is True
    assert status(good, expected={"value": "int"}) is False
    assert status(good, expected={"nope": "int"}) is False
    assert status(good, strict=True) is False
    assert status(table(spark, 3)) is False
    with pytest.raises(ValueError, match="validation failed"):
        quality.require_valid(good, quality.validation_status(quality.quality_report(table(spark, 3))))
    flags = {r["column"]: r["has_missing"] for r in quality.any_missing(good).collect()}
    assert flags == {"date_str": False, "date": False, "subba": False, "value": True, "temperature_2m": True}


def test_empty_table_passes_missing_check(spark):
    assert quality.validation_status(quality.quality_report(table(spark, 0).limit(0))).first()[0] is True


def predictions(spark, rows):
    return spark.createDataFrame(
        [(c, p, at("2025-01-01T05:00:00")) for c, p in rows], "sub_region_code bigint, predicted_demand double, date timestamp"
    )


def test_presentation(spark):
    p = predictions(spark, [(0, 100.0), (9, 300.0), (10, 300.0), (77, 200.7)])
    peak = present.peak_zone(p).first()
    assert (peak["sub_region_code"], peak["zone_name"]) == (9, "New York City")
    assert [(r["sub_region_code"], r["whole_mw"]) for r in present.top_zones(p, 3).collect()] == [(9, 300), (10, 300), (77, 200)]
    points = {r["sub_region_code"]: r for r in present.map_points(p).collect()}
    assert points[0]["fill_color"] == [0, 200, 50, 200] and points[9]["fill_color"] == [255, 0, 50, 200]
    assert points[77]["radius"] == 1003.5 and points[77]["latitude"] == 42.0
    items = {r["sub_region_code"]: r for r in present.response_items(p).collect()}
    assert items[77]["zone_name"] == "Zone 77" and items[0]["date"] == "2025-01-01 05:00:00Z"
    assert dict(present.response_items(p).dtypes)["sub_region_code"] == "int"
    assert present.response(p).first()["record_count"] == 4


def test_equal_predictions_get_the_middle_colour(spark):
    rows = present.map_points(predictions(spark, [(0, 5.0), (1, 5.0)])).collect()
    assert all(r["fill_color"] == [127, 100, 50, 200] for r in rows)


def test_health(spark, tmp_path):
    assert present.health(spark, str(tmp_path / "no")).first()["status"] == "degraded"
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "part").write_text("x")
    assert present.health(spark, str(tmp_path / "m")).first()["model_loaded"] is True
