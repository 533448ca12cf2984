"""Boosted-tree regression on lag windows with time-ordered model selection, on Spark ML."""

from __future__ import annotations

import itertools
import math
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline import schema
from hourline.operators.clean import require_numeric
from hourline.operators.windows import LAGS, seasonal_mean
from hourline.session import stage

SEASONAL = "average_demand_last_4_weeks"

# The search grid of both families.
GRIDS = {
    "XGBoost": {"n_estimators": [100, 200], "max_depth": [5, 7], "learning_rate": [0.05, 0.1]},
    "LightGBM": {"num_leaves": [50, 100], "learning_rate": [0.05, 0.1], "n_estimators": [100, 200]},
}
# The families' own defaults where a parameter is not given.
DEFAULTS = {
    "XGBoost": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3},
    "LightGBM": {"n_estimators": 100, "num_leaves": 31, "learning_rate": 0.1},
}
PARAMETERS = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "max_bin": "maxBins",
    "random_state": "seed",
}


class SeasonalMean(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the mean of the readings 1 to 4 seasons back; applying it twice changes nothing."""

    season = Param(Params._dummy(), "season", "steps per season", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, season: int = schema.SEASON):
        super().__init__()
        self._setDefault(season=schema.SEASON)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return seasonal_mean(dataset, self.getOrDefault(self.season))


class LagVector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Puts the lag array and the scalar columns into one feature vector.

    A missing lag takes the mean of its own window; a missing scalar becomes NaN, which the trees send to the right.
    """

    scalars = Param(Params._dummy(), "scalars", "scalar feature columns", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, scalars: list[str] | None = None, outputCol: str = "features"):
        super().__init__()
        self._setDefault(scalars=[*schema.COVARIATES, SEASONAL], outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        known = F.filter(LAGS, lambda x: x.isNotNull())
        mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(known), F.lit(0))
        has_gap = F.exists(LAGS, lambda x: x.isNull())
        filled = F.when(has_gap, F.transform(LAGS, lambda x: F.coalesce(x, F.col("_mean"), F.lit(0.0))))
        scalars = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.getOrDefault(self.scalars)]
        values = F.concat(F.coalesce(filled, F.col(LAGS)), F.array(*scalars))
        return (
            dataset.withColumn("_mean", F.when(has_gap, mean))
            .withColumn(self.getOrDefault(self.outputCol), array_to_vector(values))
            .drop("_mean")
        )


def regressor(model_type: str, **params) -> GBTRegressor:
    """A boosted-tree regressor under the parameter names of either family."""
    if model_type not in DEFAULTS:
        raise ValueError(f"{schema.MODEL_TYPE} one of {sorted(DEFAULTS)}")
    merged = {**DEFAULTS[model_type], **params}
    leaves = merged.pop("num_leaves", None)
    if leaves:
        merged["max_depth"] = math.ceil(math.log2(leaves))
    unknown = sorted(set(merged) - set(PARAMETERS))
    if unknown:
        raise ValueError(f"Unknown model parameters: {unknown}")
    settings = {PARAMETERS[k]: v for k, v in merged.items()}
    return GBTRegressor(labelCol=schema.TARGET, featuresCol="features", **{"seed": 42, **settings})


def preparation(season: int = schema.SEASON, covariates: list[str] | None = None) -> list[Transformer]:
    scalars = [*(schema.COVARIATES if covariates is None else covariates), SEASONAL]
    return [SeasonalMean(season=season), LagVector(scalars=scalars)]


def get_pipeline(model_type: str, season: int = schema.SEASON, covariates: list[str] | None = None, **params) -> Pipeline:
    """Seasonal mean → feature vector → regressor."""
    return Pipeline(stages=[*preparation(season, covariates), regressor(model_type, **params)])


def lags_of(model: PipelineModel) -> int:
    """How many lags a fitted pipeline was trained on: its features without the scalars of its vector step."""
    scalars = next(len(s.getOrDefault(s.scalars)) for s in model.stages if isinstance(s, LagVector))
    return model.stages[-1].numFeatures - scalars


def check_lags(model: PipelineModel, seq_len: int) -> None:
    """Trees find features by their place, so windows of another length would be scored without a word."""
    trained = lags_of(model)
    if seq_len != trained:
        raise ValueError(f"The model was trained on windows of {trained} lags and cannot score windows of {seq_len}")


def candidates(grids: dict[str, dict[str, list]]) -> list[tuple[str, dict]]:
    """Every parameter combination of every family, families in their given order."""
    out = []
    for family, grid in grids.items():
        out += [(family, dict(zip(grid, values))) for values in itertools.product(*grid.values())]
    return out


def best_candidate(scores: DataFrame) -> DataFrame:
    """(family, params, mean_rmse) of the winner from (candidate, family, params, fold, rmse); the first wins ties."""
    means = scores.groupBy("candidate", "family", "params").agg(F.avg("rmse").alias("mean_rmse"))
    best = means.agg(F.min_by(F.struct("candidate", "family", "params", "mean_rmse"), F.struct("mean_rmse", "candidate")).alias("_b"))
    return best.select("_b.*")


def best_per_family(scores: DataFrame) -> DataFrame:
    """(family, candidate, params, cv_best_rmse): per family the candidate with the lowest mean over its folds."""
    means = scores.groupBy("family", "candidate", "params").agg(F.avg("rmse").alias("mean"))
    best = means.groupBy("family").agg(F.min_by(F.struct("candidate", "params", "mean"), F.struct("mean", "candidate")).alias("_b"))
    return best.select("family", "_b.candidate", "_b.params", F.col("_b.mean").alias("cv_best_rmse"))


def trainable(windows: DataFrame, covariates: list[str] | None = None) -> DataFrame:
    """Windows a model can learn from: with a target and with every covariate."""
    return windows.dropna(subset=[schema.TARGET, *(schema.COVARIATES if covariates is None else covariates)])


def shared_fits(listed: list[tuple[str, dict]]) -> list[tuple[str, dict, dict[int, int]]]:
    """Candidates that differ only in their number of trees, as one fit each: (family, parameters of the largest,
    {candidate: trees}). The first trees of a boosted ensemble are those of a smaller one."""
    groups: dict[tuple, dict[int, int]] = {}
    for number, (family, params) in enumerate(listed):
        rest = tuple(sorted((k, v) for k, v in params.items() if k != "n_estimators"))
        groups.setdefault((family, rest), {})[number] = params.get("n_estimators", DEFAULTS[family]["n_estimators"])
    return [(family, {**dict(rest), "n_estimators": max(trees.values())}, trees) for (family, rest), trees in groups.items()]


def stopped_at(curve: list[float], patience: int) -> int:
    """The number of trees with the lowest score before the first ``patience`` trees in a row that bring no lower one."""
    best = 0
    for k, value in enumerate(curve):
        if value < curve[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def grid_search(
    folded: DataFrame,
    grids: dict[str, dict[str, list]] | None = None,
    season: int = schema.SEASON,
    covariates: list[str] | None = None,
    parallelism: int = 4,
    patience: int | None = None,
) -> tuple[PipelineModel, DataFrame, dict]:
    """Search all candidates over the expanding folds, then fit the best one on all rows.

    ``folded`` carries a ``fold`` column (see ``expanding_folds``). Fold j is scored by a model that saw the smaller
    fold numbers only. The vectors are built once and written to the shared folder; fits of different candidates and
    folds run side by side. Candidates that differ only in their number of trees share one fit, scored after each of its
    trees. With ``patience`` each such fit adds one candidate more, with the number of trees at which the mean over the
    folds last fell before so many trees that did not lower it. Returns the fitted model, the scores, with the rows that
    each fold was trained and scored on, and a description of the winner.
    """
    require_numeric(folded, [LAGS, schema.TARGET, *(schema.COVARIATES if covariates is None else covariates)])
    grids = grids or GRIDS
    steps = preparation(season, covariates)
    vectors = folded
    for step in steps:
        vectors = step.transform(vectors)
    vectors = stage(vectors.select("fold", "features", schema.TARGET), "train-vectors")
    # One row per fold.
    sizes = {r["fold"]: r["count"] for r in vectors.groupBy("fold").count().collect()}
    folds = sorted(f for f in sizes if f > 0)
    listed = candidates(grids)
    fits = shared_fits(listed)

    def curve(task: tuple[int, int]) -> list[float]:
        """RMSE of the fold after each tree."""
        family, params, _ = fits[task[0]]
        model = regressor(family, **params).fit(vectors.where(F.col("fold") < task[1]))
        return [math.sqrt(e) for e in model.evaluateEachIteration(vectors.where(F.col("fold") == task[1]), "squared")]

    tasks = [(n, f) for n in range(len(fits)) for f in folds]
    with ThreadPool(processes=min(parallelism, len(tasks))) as pool:
        curves = dict(zip(tasks, pool.map(inheritable_thread_target(folded.sparkSession)(curve), tasks)))
    rows = []
    for n, (family, params, trees) in enumerate(fits):
        if patience is not None:
            mean = [sum(values) / len(folds) for values in zip(*(curves[n, f] for f in folds))]
            trees = {**trees, len(listed): stopped_at(mean, patience)}
            listed.append((family, {**params, "n_estimators": trees[len(listed)]}))
        for number, k in trees.items():
            named = {key: str(v) for key, v in listed[number][1].items()}
            for f in folds:
                rows.append((number, family, named, f, curves[n, f][k - 1], sum(s for g, s in sizes.items() if g < f), sizes[f]))
    spark = folded.sparkSession
    scores = spark.createDataFrame(
        rows, "candidate int, family string, params map<string,string>, fold int, rmse double, n_train long, n_scored long"
    )
    # A map cannot be a grouping key, the candidate number stands for it.
    named = scores.withColumn("params", F.to_json("params"))
    won = best_candidate(named).first()
    family, params = listed[won["candidate"]]
    fitted = regressor(family, **params).fit(vectors)
    summary = {"model_name": family, "params": params, "score": won["mean_rmse"]}
    return PipelineModel([*steps, fitted]), named, summary


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
