import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from hourline import plans, schema, sinks
from hourline.operators import learn, windows
from hourline.operators.clean import holdout_split
from tests.helpers import at, hours, series, values

SEQ, SEASON = 28, 7
TINY = {"XGBoost": {"n_estimators": [2], "max_depth": [1, 3]}, "LightGBM": {"num_leaves": [4], "n_estimators": [2]}}


@pytest.fixture(scope="module")
def table(spark):
    from hourline.session import stage

    return stage(series(spark, 24 * 12, 2), "learn")


@pytest.fixture(scope="module")
def model(spark, table):
    return learn.get_pipeline("XGBoost", SEASON, n_estimators=3, max_depth=3).fit(windows.lag_windows(table, SEQ))


def test_families(spark):
    xgb = learn.get_pipeline("XGBoost", n_estimators=50, max_depth=3).getStages()[-1]
    assert isinstance(xgb, GBTRegressor) and (xgb.getMaxIter(), xgb.getMaxDepth()) == (50, 3)
    for leaves, depth in ((50, 6), (100, 7), (31, 5)):
        lgbm = learn.regressor("LightGBM", num_leaves=leaves, learning_rate=0.05)
        assert (lgbm.getMaxDepth(), lgbm.getStepSize()) == (depth, 0.05)
    with pytest.raises(ValueError, match="model_type must be"):
        learn.get_pipeline("InvalidModel")
    with pytest.raises(ValueError, match="Unknown model parameters"):
        learn.regressor("XGBoost", nonsense=1)


def test_grid_size():
    listed = learn.candidates(learn.GRIDS)
    assert len(listed) == 16 and [f for f, _ in listed[:8]] == ["XGBoost"] * 8


def test_fit_predict_and_round_trip(spark, table, model, tmp_path):
    rows = windows.lag_windows(table, SEQ)
    first = values(model.transform(rows), schema.KEY, "date", "prediction")
    assert len(first) == rows.count() and all(isinstance(r[2], float) for r in first)
    path = str(tmp_path / "model")
    learn.save_model(model, path)
    assert values(learn.load_model(path).transform(rows), schema.KEY, "date", "prediction") == first


def test_vector_fills_gaps(spark):
    row = ([1.0, None, 3.0], None, 2.0)
    df = spark.createDataFrame([row], "demand_lags array<double>, a double, b double")
    got = learn.LagVector(scalars=["a", "b"]).transform(df).first()["features"].toArray().tolist()
    assert got[:3] == [1.0, 2.0, 3.0] and got[3] != got[3] and got[4] == 2.0


def test_grid_search_picks_the_lowest_mean(spark, table):
    model, scores, best = plans.train(table, SEQ, 4, folds=2, grids=TINY, season=SEASON, holdout_days=2)
    means = {r[0]: r[1] for r in scores.groupBy("candidate").agg(F.avg("rmse")).collect()}
    assert scores.count() == 3 * 2 and best["score"] == pytest.approx(min(means.values()))
    assert model.stages[-1].getNumTrees == best["params"]["n_estimators"]
    metrics = plans.evaluate(table, model, SEQ, holdout_days=2).first()
    assert metrics["n_samples"] == 2 * (2 * 24 + 1 - SEQ) and metrics["rmse"] > 0
    warm = plans.evaluate(table, model, SEQ, holdout_days=2, warmup=True).first()
    assert warm["n_samples"] == 2 * (2 * 24 + 1)


def test_tree_counts_share_a_fit(spark, table, monkeypatch):
    """Scores of shared fits are those of a fit for each candidate, and a family of tree counts is fitted once a fold."""
    grids = {"XGBoost": {"n_estimators": [1, 4, 2], "max_depth": [1, 2], "learning_rate": [0.3]}, "LightGBM": {"num_leaves": [4], "n_estimators": [3]}}
    listed = learn.candidates(grids)
    assert len(listed) == 7 and [sorted(t.values()) for _, _, t in learn.shared_fits(listed)] == [[1, 2, 4], [1, 2, 4], [3]]
    train, _ = holdout_split(table, 2)
    folded = windows.expanding_folds(learn.trainable(windows.lag_windows(train, SEQ, 4)), 2)
    fitted, fit = [], learn.GBTRegressor.fit
    monkeypatch.setattr(learn.GBTRegressor, "fit", lambda self, *a, **k: fitted.append(self.getMaxIter()) or fit(self, *a, **k))
    _, scores, best = learn.grid_search(folded, grids, SEASON, patience=1)
    assert sorted(fitted[:-1]) == [3, 3, 4, 4, 4, 4] and fitted[-1] == best["params"]["n_estimators"]
    got = {(r["candidate"], r["fold"]): r for r in scores.collect()}
    assert len(got) == (7 + 3) * 2 and all(r["n_train"] + r["n_scored"] <= folded.count() for r in got.values())
    vectors = folded
    for step in learn.preparation(SEASON):
        vectors = step.transform(vectors)
    for number, (family, params) in enumerate(listed):
        model = learn.regressor(family, **params).fit(vectors.where("fold < 2"))
        rows = model.transform(vectors.where("fold = 2")).select(schema.TARGET, "prediction").collect()
        plain = (sum((a - b) ** 2 for a, b in rows) / len(rows)) ** 0.5
        assert got[number, 2]["rmse"] == pytest.approx(plain) and got[number, 2]["n_scored"] == len(rows)


def test_where_a_curve_stops():
    assert learn.stopped_at([5, 4, 3, 3.5, 3.4, 2], 2) == 3 and learn.stopped_at([5, 4, 3, 3.5, 3.4, 2], 3) == 6
    assert learn.stopped_at([1.0], 1) == 1 and learn.stopped_at([2, 2, 2], 5) == 1


def test_first_candidate_wins_ties(spark):
    rows = [(2, "b", "{}", 1, 5.0), (1, "a", "{}", 1, 4.0), (1, "a", "{}", 2, 6.0), (3, "c", "{}", 1, 5.5)]
    scores = spark.createDataFrame(rows, "candidate int, family string, params string, fold int, rmse double")
    assert tuple(learn.best_candidate(scores).first()) == (1, "a", "{}", 5.0)


def test_training_guards(spark, table):
    with pytest.raises(ValueError, match="There are no features"):
        plans.train(table.where("demand < 0"), SEQ, season=SEASON)
    with pytest.raises(ValueError, match="leaves one side without rows"):
        plans.train(table, SEQ, season=SEASON, holdout_days=90)
    with pytest.raises(ValueError, match="No valid time-series"):
        plans.evaluate(table, None, 200, holdout_days=2)
    with pytest.raises(ValueError, match="input_seq_len"):
        plans.train(table, 100)


def test_prediction(spark, table, model):
    short = series(spark, 10, 3, start="2025-01-12").where("sub_region_code = 2")
    features = table.unionByName(short)
    as_of = F.lit("2025-02-01 07:45:00").cast("timestamp")
    got = plans.predict_next(features, model, as_of, SEQ).orderBy(schema.KEY).collect()
    assert [r[schema.KEY] for r in got] == [0, 1]
    last = hours("2025-01-01", 24 * 12)[-1].replace(tzinfo=None)
    assert {(str(r["date"]), r["feature_time"]) for r in got} == {("2025-02-01 07:00:00", last)}
    assert all(r["target_time"].hour == 0 and r["predicted_demand"] == round(r["predicted_demand"]) for r in got)
    _, rejected = plans.prediction_inputs(features, as_of, SEQ)
    assert [(r[schema.KEY], r["n_lags"]) for r in rejected.collect()] == [(2, 10)]
    with pytest.raises(ValueError, match="enough history"):
        plans.predict_next(short, model, as_of, SEQ)


def test_prediction_only_sees_what_is_past(spark, table, model):
    early = plans.predict_next(table, model, F.lit("2025-01-05 00:30:00").cast("timestamp"), SEQ).collect()
    assert {str(r["feature_time"]) for r in early} == {"2025-01-05 00:00:00"}


def raw_tables(spark, n=72):
    raw = [(t.strftime("%Y-%m-%dT%H"), zone, str(100 + i), "x") for i, t in enumerate(hours("2025-07-04", n)) for zone in ("ZONA", "ZONC")]
    raw += [raw[0], ("2025-07-04T05", "ZONQ", "1", "x")]
    demand = spark.createDataFrame(raw, "period string, subba string, value string, `parent-name` string")
    wx = spark.createDataFrame([(t, 20.0) for t in hours("2025-07-04T02:00:00", n)], "date timestamp, temperature_2m double")
    return demand, wx


def test_feature_build(spark):
    demand, wx = raw_tables(spark)
    built = plans.build_features(demand, wx)
    assert built.features.columns[:5] == ["date_str", "date", "sub_region_code", "demand", "temperature_2m"]
    assert built.features.count() == 2 * 70 and built.rejects.count() == 1
    assert "parent_name" in built.processed.columns
    assert built.status.first()["validation_status"] is True
    assert {r[0] for r in built.features.select("sub_region_code").distinct().collect()} == {0, 2}
    assert built.features.agg(F.sum("is_holiday")).first()[0] == 0
    whole = plans.feature_table(built.processed, holiday_mode="calendar_day")
    assert whole.agg(F.sum("is_holiday")).first()[0] == 2 * 22 + 1
    labels = plans.feature_table(built.processed, encoder="labels")
    assert {r[0] for r in labels.select("sub_region_code").distinct().collect()} == {0, 1, 2}
    with pytest.raises(ValueError, match="encoder"):
        plans.feature_table(built.processed, encoder="other")


def test_boundary_copies_stay_without_dedupe(spark):
    demand, _ = raw_tables(spark)
    wx = spark.createDataFrame([(t, 20.0) for t in hours("2025-07-04", 3)], "date timestamp, temperature_2m double")
    assert plans.merge_demand_weather(demand, wx, dedupe=False).count() == 7
    assert plans.merge_demand_weather(demand, wx).count() == 6


def test_invalid_data_can_stop_the_build(spark):
    demand, wx = raw_tables(spark)
    bad = wx.withColumn("temperature_2m", F.lit(None).cast("double"))
    assert plans.build_features(demand, bad).status.first()[0] is False
    with pytest.raises(ValueError, match="validation failed"):
        plans.build_features(demand, bad, valid_only=True)


def test_monitoring_range(spark, tmp_path):
    t = hours("2025-01-01", 72)
    features = spark.createDataFrame([(0, x, 100.0) for x in t], "sub_region_code bigint, date timestamp, demand double")
    path = str(tmp_path / "p")
    sinks.keep_predictions(spark.createDataFrame([(0, 90.0, x) for x in t], schema.PREDICTIONS_DDL), path)
    got = plans.monitor(spark.read.parquet(path), features, F.lit("2025-01-03 15:00:00").cast("timestamp"))
    assert got.columns == ["sub_region_code", "predicted_demand", "date", "demand"]
    ends = got.agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert (ends[0], ends[1], ends[2]) == (at("2025-01-02").replace(tzinfo=None), at("2025-01-03").replace(tzinfo=None), 25)
    assert plans.monitoring_errors(got).first()["mae"] == 10.0


def test_empty_inputs_give_empty_tables(spark):
    demand, wx = raw_tables(spark)
    for raw, weather in ((demand.limit(0), wx), (demand, wx.limit(0))):
        built = plans.build_features(raw, weather)
        assert built.features.isEmpty() and built.status.first()[0] is True
