"""Model selection, evaluation, prediction.

Boosted trees have no SQL form; what SQL can tell is compared: the keys, times and targets of what is scored, equality of
a stored model, and the whole result of one tree with one split.
"""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressionModel  # noqa: F401  (the fitted stage)
from pyspark.sql import functions as F

from hourline import plans, schema
from hourline.catalog.common import FEATURES, features, query
from hourline.operators import learn, windows
from hourline.operators.clean import holdout_split, newest
from hourline.session import scratch_path

SEQ_LEN, SEASON = 28, 7
GRID = {
    "XGBoost": {"n_estimators": [3], "max_depth": [2, 3], "learning_rate": [0.3]},
    "LightGBM": {"num_leaves": [4], "n_estimators": [3]},
}


def quick_model(spark, sf_dir, model_type="XGBoost"):
    train, _ = holdout_split(features(spark, sf_dir))
    rows = learn.trainable(windows.lag_windows(train, SEQ_LEN))
    return learn.get_pipeline(model_type, SEASON, n_estimators=4, learning_rate=0.3).fit(rows)


@query("k1_families")
def families(spark, sf_dir):
    """Both families fitted on the training part and applied to it."""
    train, _ = holdout_split(features(spark, sf_dir))
    rows = learn.trainable(windows.lag_windows(train, SEQ_LEN))
    out = None
    for family in ("XGBoost", "LightGBM"):
        model = learn.get_pipeline(family, SEASON, n_estimators=3).fit(rows)
        scored = model.transform(rows).select(
            F.lit(family).alias("family"), schema.KEY, schema.TIME, schema.TARGET, F.round("prediction", 3).alias("prediction")
        )
        out = scored if out is None else out.unionByName(scored)
    return out


@query("k3_grid")
def grid(spark, sf_dir):
    """Scores of every candidate on every expanding fold."""
    _, scores, _ = plans.train(
        features(spark, sf_dir), SEQ_LEN, folds=3, grids=GRID, season=SEASON
    )
    return scores.withColumn("rmse", F.round("rmse", 4))


def _fold_sql(folds: int) -> str:
    return f"""{FEATURES}, train AS (SELECT *, row_number() OVER (PARTITION BY sub_region_code ORDER BY date) AS rn
      FROM features WHERE date < (SELECT max(date) - INTERVAL 90 DAY FROM features)),
    placed AS (SELECT row_number() OVER (ORDER BY date, sub_region_code) - 1 AS ordinal, count(*) OVER () AS n FROM train WHERE rn > {SEQ_LEN}),
    folded AS (SELECT greatest(0, CAST(floor((ordinal - (n - (n // {folds + 1}) * {folds})) / (n // {folds + 1})) AS BIGINT) + 1) AS fold FROM placed),
    sizes AS (SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n_scored, CAST(sum(count(*)) OVER (ORDER BY fold) - count(*) AS BIGINT) AS n_train
      FROM folded GROUP BY fold)"""


TREE_GRID = {"XGBoost": {"n_estimators": [2, 4], "max_depth": [2, 3], "learning_rate": [0.3]}, "LightGBM": {"num_leaves": [4], "n_estimators": [3]}}


@query(
    "k3_scored_folds",
    f"""WITH {_fold_sql(3)}, c AS (
      SELECT CAST(2 * (i // 2) + j AS INTEGER) AS candidate, 'XGBoost' AS family, CAST(2 + i // 2 * 2 AS VARCHAR) AS n_estimators, CAST(2 + j AS VARCHAR) AS max_depth
        FROM (VALUES (0), (2)) a(i), (VALUES (0), (1)) b(j)
      UNION ALL SELECT 4, 'LightGBM', '3', NULL)
    SELECT candidate, family, n_estimators, max_depth, fold, n_train, n_scored, TRUE AS scored FROM c, sizes WHERE fold > 0""",
)
def scored_folds(spark, sf_dir):
    """Which candidates are scored on which rows, from shared fits."""
    _, scores, _ = plans.train(features(spark, sf_dir), SEQ_LEN, folds=3, grids=TREE_GRID, season=SEASON)
    given = F.from_json("params", "map<string,string>")
    return scores.select(
        "candidate", "family", given["n_estimators"].alias("n_estimators"), given["max_depth"].alias("max_depth"), "fold", "n_train", "n_scored",
        (F.col("rmse") > 0).alias("scored"),
    )


@query(
    "k1_scored_keys",
    f"""WITH {FEATURES}, train AS (SELECT *, row_number() OVER (PARTITION BY sub_region_code ORDER BY date) AS rn
      FROM features WHERE date < (SELECT max(date) - INTERVAL 90 DAY FROM features))
    SELECT family, sub_region_code, date, demand AS target_demand_next_hour, TRUE AS scored
    FROM train, (VALUES ('XGBoost'), ('LightGBM')) f(family) WHERE rn > {SEQ_LEN}""",
)
def family_keys(spark, sf_dir):
    """Both families score every training window with a number."""
    scored = families(spark, sf_dir)
    number = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return scored.select("family", schema.KEY, schema.TIME, schema.TARGET, number.alias("scored"))


@query("k8_batch_scores")
def batch_scores(spark, sf_dir):
    _, test = holdout_split(features(spark, sf_dir))
    scored = quick_model(spark, sf_dir).transform(windows.lag_windows(test, SEQ_LEN))
    return scored.select(schema.KEY, schema.TIME, schema.TARGET, F.round("prediction", 3).alias("prediction"))


HOLDOUT_WINDOWS = f"""{FEATURES}, held AS (SELECT *, row_number() OVER (PARTITION BY sub_region_code ORDER BY date) AS rn
  FROM features WHERE date >= (SELECT max(date) - INTERVAL 90 DAY FROM features)),
  windows AS (SELECT * FROM held WHERE rn > {SEQ_LEN})"""


@query(
    "k8_scored_keys",
    f"""WITH {HOLDOUT_WINDOWS}
    SELECT sub_region_code, date, demand AS target_demand_next_hour, TRUE AS scored FROM windows""",
)
def scored_keys(spark, sf_dir):
    """What is scored, and that every window gets a number."""
    _, test = holdout_split(features(spark, sf_dir))
    scored = quick_model(spark, sf_dir).transform(windows.lag_windows(test, SEQ_LEN))
    number = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return scored.select(schema.KEY, schema.TIME, schema.TARGET, number.alias("scored"))


@query(
    "k_one_split",
    f"""WITH {FEATURES}, c AS (SELECT month, count(*) AS n, sum(demand) AS s FROM features GROUP BY month),
    r AS (SELECT month, sum(n) OVER (ORDER BY month) AS nl, sum(s) OVER (ORDER BY month) AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM c),
    best AS (SELECT month AS cut, sl / nl AS below, (s - sl) / (n - nl) AS above FROM r WHERE nl < n
      ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)
    SELECT month, CAST(n AS BIGINT) AS n, round(CASE WHEN month <= cut THEN below ELSE above END, 4) AS prediction FROM c, best""",
)
def one_split(spark, sf_dir):
    """One tree of depth 1 over the months of all rows: the best split and its two means are exact."""
    rows = features(spark, sf_dir).select("month", F.col(schema.VALUE).alias(schema.TARGET), F.array().cast("array<double>").alias(windows.LAGS))
    vectors = learn.LagVector(scalars=["month"]).transform(rows)
    model = learn.regressor("XGBoost", n_estimators=1, max_depth=1).fit(vectors)
    scored = model.transform(vectors).groupBy("month", F.round("prediction", 4).alias("prediction"))
    return scored.agg(F.count("*").alias("n")).select("month", "n", "prediction")


@query("k9_predict")
def predict(spark, sf_dir):
    """The next day of every zone; zones without enough recent days are left out."""
    base = features(spark, sf_dir)
    return plans.predict_next(
        base, quick_model(spark, sf_dir), newest(base), SEQ_LEN, lookback_days=90, grain="1 day"
    )


@query(
    "k9_predicted_keys",
    f"""WITH {FEATURES}, m AS (SELECT max(date) AS last FROM features),
    recent AS (SELECT f.sub_region_code, f.date AS seen, m.last FROM features f, m WHERE f.date BETWEEN m.last - INTERVAL 90 DAY AND m.last)
    SELECT sub_region_code, last AS date, max(seen) AS feature_time, max(seen) + INTERVAL 1 DAY AS target_time, TRUE AS predicted
    FROM recent GROUP BY sub_region_code, last HAVING count(*) >= {SEQ_LEN}""",
)
def predicted_keys(spark, sf_dir):
    """Which zones get a prediction, from which day and for which."""
    base = features(spark, sf_dir)
    found = plans.predict_next(base, quick_model(spark, sf_dir), newest(base), SEQ_LEN, lookback_days=90, grain="1 day")
    return found.select(schema.KEY, schema.TIME, "feature_time", "target_time", F.col("predicted_demand").isNotNull().alias("predicted"))


@query("k10_evaluate")
def evaluate(spark, sf_dir):
    return plans.evaluate(features(spark, sf_dir), quick_model(spark, sf_dir), SEQ_LEN)


@query(
    "k10_identities",
    f"""WITH {HOLDOUT_WINDOWS} SELECT count(*) AS n_samples, TRUE AS rmse_is_root, TRUE AS r2_fits_mse, TRUE AS improvement_fits, TRUE AS errors_in_order FROM windows""",
)
def evaluation_identities(spark, sf_dir):
    """The sample of an evaluation, and what must hold between its metrics and the targets, whatever the model."""
    base = features(spark, sf_dir)
    m = plans.evaluate(base, quick_model(spark, sf_dir), SEQ_LEN)
    _, test = holdout_split(base)
    spread = windows.lag_windows(test, SEQ_LEN).agg(F.var_pop(schema.TARGET)).scalar()
    near = lambda a, b: F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    return m.withColumn("v", spread).select(
        "n_samples", near(F.col("rmse") * F.col("rmse"), F.col("mse")).alias("rmse_is_root"), near(F.col("r2_score"), 1 - F.col("mse") / F.col("v")).alias("r2_fits_mse"),
        near(F.col("forecast_improvement_percent"), (10 - F.col("mape")) * 10).alias("improvement_fits"), (F.col("mae") <= F.col("rmse")).alias("errors_in_order"),
    )


@query("b10_model_roundtrip", f"WITH {HOLDOUT_WINDOWS} SELECT count(*) AS n, count(*) AS equal FROM windows")
def model_roundtrip(spark, sf_dir):
    """Predictions of a model before and after it was stored."""
    model = quick_model(spark, sf_dir, "LightGBM")
    path = scratch_path(spark, "model")
    learn.save_model(model, path)
    _, test = holdout_split(features(spark, sf_dir))
    rows = windows.lag_windows(test, SEQ_LEN)
    before = model.transform(rows).select(schema.KEY, schema.TIME, F.col("prediction").alias("before"))
    after = learn.load_model(path).transform(rows).select(schema.KEY, schema.TIME, F.col("prediction").alias("after"))
    both = before.join(after, [schema.KEY, schema.TIME])
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") == F.col("after")).alias("equal"))
