"""Pooled Spark ML models over the whole panel."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators.boosting import BoostedTrees, fit_trees
from seriesworks.operators.metrics import METRICS, forecast_metrics
from seriesworks.session import cut_lineage

#: Spark ML's limit, and the depth that stands for "unlimited" unless another is given.
MAX_TREE_DEPTH = 30
UNLIMITED_DEPTH = 5


def boosting_arguments(params: dict, unlimited_depth: int = UNLIMITED_DEPTH) -> tuple[dict, dict]:
    """Arguments for GBTRegressor, and the parameters that have no counterpart there.

    Spark ML grows trees level by level and has no unlimited depth: a negative
    ``max_depth`` becomes ``unlimited_depth``.  A depth above Spark's limit is an error.
    """
    p = config.BOOSTING_PARAMS | params
    depth = int(p["max_depth"])
    depth = unlimited_depth if depth < 0 else depth
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth {depth} is above {MAX_TREE_DEPTH}, the most that Spark ML can grow")
    arguments = {
        "maxIter": int(p["num_boost_round"]),
        "stepSize": float(p["learning_rate"]),
        "maxDepth": depth,
        "minInstancesPerNode": int(p["min_data_in_leaf"]),
        "featureSubsetStrategy": str(float(p["feature_fraction"])),
        "subsamplingRate": float(p["bagging_fraction"]),
        "minInfoGain": float(p["min_gain_to_split"]),
        "seed": int(p["random_state"]),
    }
    used = {
        "num_boost_round", "learning_rate", "max_depth", "min_data_in_leaf", "feature_fraction",
        "bagging_fraction", "min_gain_to_split", "random_state",
    }
    return arguments, {k: v for k, v in p.items() if k not in used}


def fit_boosting(
    df: DataFrame,
    features: Sequence[str],
    target: str = config.TARGET,
    params: dict | None = None,
    categorical: Sequence[str] = (),
    split: str = "split",
    unlimited_depth: int = UNLIMITED_DEPTH,
) -> PipelineModel:
    """Gradient-boosted trees on the train rows, stopped early on the valid rows.

    Only the columns named ``categorical`` are split by category, whatever the number
    of their values; the values' names are part of the model.  Parameters without a
    counterpart in Spark ML are kept as ``unused_params`` of the result.
    """
    arguments, unused = boosting_arguments(params or {}, unlimited_depth)
    rows = df.where(F.col(split).isin("train", "valid")).withColumn("_is_valid", F.col(split) == "valid")
    rows = rows.select(*features, *[c for c in categorical if c not in features], target, "_is_valid")
    indexed = [f"{c}_index" for c in categorical]
    numbers = [f for f in features if f not in categorical]
    stages, bins = [], 32
    if categorical:
        indexer = StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep").fit(rows)
        bins = max(bins, *[len(labels) + 1 for labels in indexer.labelsArray])  # a bin a category
        stages.append(indexer)
    stages.append(VectorAssembler(inputCols=[*numbers, *indexed], outputCol="_x"))
    stages.append(
        GBTRegressor(
            featuresCol="_x",
            labelCol=target,
            predictionCol="predicted",
            validationIndicatorCol="_is_valid",
            maxBins=bins,
            **arguments,
        )
    )
    model = Pipeline(stages=stages).fit(rows)
    model.unused_params = unused
    return model


def predict(model: PipelineModel | BoostedTrees, df: DataFrame, target: str = config.TARGET) -> DataFrame:
    scored = model.transform(df)
    helpers = [c for c in scored.columns if c not in df.columns and c != "predicted"]
    return scored.drop(*helpers).withColumn("actual", F.col(target).cast("double"))


def _feature_names(model: PipelineModel) -> list[str]:
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return assembler.getInputCols()


def feature_importance(model: PipelineModel | BoostedTrees, spark: SparkSession, kind: str = "gain") -> DataFrame:
    """Importance per feature, largest first: gain of trees, |coefficient| of linear models.

    Boosted trees of :mod:`boosting` also know ``kind="split"``, the number of splits.
    """
    if isinstance(model, BoostedTrees):
        return model.importance(spark, kind)
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = abs(last.coefficients.toArray())
    else:
        raise ValueError("the model has no feature importance")
    rows = [(n, float(v)) for n, v in zip(_feature_names(model), values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def top_importance(importance: DataFrame, k: int = 10) -> DataFrame:
    """The k most important features with their share of the maximum."""
    top = importance.agg(F.max("importance")).scalar()
    return (
        importance.withColumn("share_of_max", F.try_divide(F.col("importance"), top))
        .orderBy(F.col("importance").desc(), "feature")
        .limit(k)
    )


def save_model(model: PipelineModel, path: str, spark: SparkSession, params: dict | None = None) -> None:
    """The model plus its feature names and parameters."""
    model.write().overwrite().save(f"{path}/model")
    rows = [(i, n, json.dumps(params or {})) for i, n in enumerate(_feature_names(model))]
    spark.createDataFrame(rows, "position int, feature string, params string").write.mode("overwrite").parquet(
        f"{path}/meta"
    )


def load_model(path: str, spark: SparkSession) -> tuple[PipelineModel, list[str], dict]:
    meta = spark.read.parquet(f"{path}/meta").orderBy("position").collect()  # one row per feature
    return PipelineModel.load(f"{path}/model"), [r.feature for r in meta], json.loads(meta[0].params)


def sample_params(n_trials: int, space: dict = config.SEARCH_SPACE, seed: int = 42) -> list[dict]:
    """Random trials: whole numbers uniform, the learning rate log-uniform, fractions uniform."""
    rng = random.Random(seed)

    def draw(name, low, high):
        if isinstance(low, int) and isinstance(high, int):
            return rng.randint(low, high)
        if name == "learning_rate":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    return [{name: draw(name, *bounds) for name, bounds in space.items()} for _ in range(n_trials)]


def grid_params(grid: dict[str, Sequence]) -> list[dict]:
    """Every combination of the listed values."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def search(
    df: DataFrame,
    features: Sequence[str],
    trials: Sequence[dict],
    target: str = config.TARGET,
    metric: str = "rmse",
    fit: Callable[..., PipelineModel] = fit_boosting,
    split: str = "split",
    **fixed,
) -> DataFrame:
    """Fit each trial on train, score it on valid: (trial, params, score).

    Each fit is a distributed job; trials run one after the other.
    """
    rows = []
    for i, params in enumerate(trials):
        model = fit(df, features, target, params=fixed | params, split=split)
        scored = predict(model, df.where(F.col(split) == "valid"), target)
        rows.append((i, json.dumps(params), float(forecast_metrics(scored).first()[metric])))
    return df.sparkSession.createDataFrame(rows, "trial int, params string, score double")


def search_halving(
    df: DataFrame,
    features: Sequence[str],
    trials: Sequence[dict],
    path: str,
    rungs: Sequence[int] = (8, 32, 128),
    keep: float = 1 / 3,
    target: str = config.TARGET,
    metric: str = "rmse",
    fit: Callable = fit_trees,
    split: str = "split",
    at_once: int = 4,
    **fixed,
) -> DataFrame:
    """Successive halving: (rung, trial, params, rounds, score), one row per fit.

    All trials train for the first rung's rounds; the best ``keep`` of them, by their
    error on the valid rows, go on to the next rung's, and so on.  Up to ``at_once`` fits
    run at a time, each a distributed job in a pool of its own.  Every fit's result is
    written to its own part of the rung table at ``path`` when it is done: a search that
    was cut off goes on where it ended, and a finished one gives the same rows without
    any fit.  Ties go to the earlier trial.
    """
    spark = df.sparkSession
    valid = df.where(F.col(split) == "valid")
    result = "params string, rounds int, score double"
    schema = f"{result}, rung int, trial int"

    def known() -> dict[tuple[int, int], tuple[str, float]]:
        rows = spark.read.schema(schema).parquet(path).collect()  # one row per fit
        return {(r.rung, r.trial): (r.params, r.score) for r in rows}

    # an empty part, so that there is a table to read from the start
    spark.createDataFrame([], result).write.mode("ignore").parquet(f"{path}/rung=-1/trial=-1")
    done = known()

    def run(job: tuple[int, int, int]) -> None:
        rung, trial, rounds = job
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{trial}")
        params = trials[trial]
        model = fit(df, features, target, params=fixed | params | {"num_boost_round": rounds}, split=split)
        score = float(forecast_metrics(predict(model, valid, target)).first()[metric])
        row = spark.createDataFrame([(json.dumps(params), rounds, score)], result)
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/rung={rung}/trial={trial}")

    alive = list(range(len(trials)))
    for rung, rounds in enumerate(rungs):
        changed = [t for t in alive if (rung, t) in done and done[rung, t][0] != json.dumps(trials[t])]
        if changed:
            raise ValueError(f"the rung table at {path} is of other trials")
        with ThreadPoolExecutor(at_once) as pool:
            jobs = [pool.submit(inheritable_thread_target(spark)(run), (rung, t, rounds)) for t in alive if (rung, t) not in done]
            for job in jobs:
                job.result()
        done = known()
        alive.sort(key=lambda t: (done[rung, t][1], t))
        alive = sorted(alive[: max(1, math.ceil(len(alive) * keep))])
    return spark.read.schema(schema).parquet(path).select("rung", "trial", "params", "rounds", "score")


def halving_winner(rungs: DataFrame) -> dict:
    """Parameters of the best trial of the last rung; the earlier one on ties."""
    return json.loads(rungs.orderBy(F.col("rung").desc(), "score", "trial").first().params)


def best_params(trials: DataFrame, minimize: bool = True) -> dict:
    """Parameters of the best trial; the earlier one on ties."""
    order = F.col("score").asc() if minimize else F.col("score").desc()
    return json.loads(trials.orderBy(order, "trial").first().params)


def refit_best(df: DataFrame, features: Sequence[str], trials: DataFrame, target: str = config.TARGET, **fixed):
    return fit_boosting(df, features, target, params=fixed | best_params(trials))


def weighted_ensemble(
    predictions: DataFrame, by: Sequence[str], weights: dict[str, float] | None = None
) -> DataFrame:
    """Weighted average of (model, predicted) rows; weights are renormalised over the present models.

    Without ``weights`` all models count alike (``config.ENSEMBLE_WEIGHTS`` has a set by name).
    """
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.try_element_at(F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]), F.col("model"))
    weight = F.when(F.col("predicted").isNotNull(), weight)
    return predictions.groupBy(*by).agg(
        F.try_divide(F.sum(weight * F.col("predicted")), F.sum(weight)).alias("predicted"),
        F.count(weight).alias("models"),
    )


def fit_stacking(df: DataFrame, prediction_columns: Sequence[str], target: str = config.TARGET) -> PipelineModel:
    """Linear meta-model on out-of-fold predictions."""
    stages = [
        VectorAssembler(inputCols=list(prediction_columns), outputCol="_x"),
        LinearRegression(featuresCol="_x", labelCol=target, predictionCol="predicted"),
    ]
    return Pipeline(stages=stages).fit(df.select(*prediction_columns, target))


def cross_validate(
    folded: DataFrame,
    features: Sequence[str],
    target: str = config.TARGET,
    n_splits: int = config.CV_FOLDS,
    params: dict | None = None,
) -> DataFrame:
    """Metrics per expanding fold, one row each; ``folded`` comes from ``splits.cv_folds``.

    The rows are written once and read for each fold.
    """
    folded, results = cut_lineage(folded), []
    for f in range(1, n_splits + 1):
        role = F.when(F.col("fold") < f, "train").when(F.col("fold") == f, "valid")
        rows = folded.withColumn("split", role).where(F.col("split").isNotNull())
        model = fit_boosting(rows, features, target, params)
        scored = predict(model, rows.where(F.col("split") == "valid"), target)
        found = forecast_metrics(scored).first()  # one row of metrics per fold
        results.append((f, *[float(found[m]) for m in METRICS]))
    return folded.sparkSession.createDataFrame(results, ["fold", *METRICS])


def log_run(metrics: DataFrame, path: str, run: str, params: dict) -> None:
    """Append (metric, value) rows of a run to the run table."""
    metrics.select(
        F.lit(run).alias("run"), "metric", "value", F.lit(json.dumps(params)).alias("params")
    ).write.mode("append").parquet(path)
