"""End-to-end jobs over the whole panel."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.columns import add_forecast_errors, feature_columns, known, rename_series_columns
from seriesworks.operators import features as feature_ops
from seriesworks.operators import forecast as forecast_ops
from seriesworks.operators import boosting, metrics, models, panel, prep, series_boosting, splits, training
from seriesworks.operators.profile import point_status
from seriesworks.session import cut_lineage
from seriesworks.sources.tables import scan_sales

KEYS, DATE, TARGET = config.KEYS, config.DATE, config.TARGET


def series_rows(sales: DataFrame) -> DataFrame:
    """Sales rows with the series column names, nothing else."""
    return rename_series_columns(sales.select(*config.SERIES_RENAMES))


def clean_panel(rows: DataFrame, outliers: bool = True, start: str | None = None, end: str | None = None) -> DataFrame:
    """Daily sum, dense calendar, forward fill and (for training) outlier clipping."""
    dense = panel.densify(panel.daily_totals(rows, start=start, end=end))
    return prep.treat_outliers(dense) if outliers else dense


def feature_matrix(
    sales: DataFrame, outliers: bool = True, exclude_current: bool = False, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Sales rows to the full feature matrix."""
    dense = clean_panel(series_rows(sales), outliers, start, end)
    return feature_ops.build_features(dense, exclude_current=exclude_current)


def model_features(features: DataFrame) -> list[str]:
    """Numeric columns that are neither key, date nor target."""
    return feature_columns(features)


def train_pooled(
    sales: DataFrame,
    params: dict | None = None,
    test_size: float = config.TEST_SIZE,
    start: str | None = None,
    end: str | None = None,
) -> tuple[boosting.BoostedTrees, DataFrame, DataFrame]:
    """One boosted-tree model over all series: model, test metrics, importance.

    All of ``config.BOOSTING_PARAMS`` count; training ends ``early_stopping_rounds`` after
    the best round on the valid rows.
    """
    # the test rows are read again, so the features are written once
    matrix = cut_lineage(splits.three_way_split(feature_matrix(sales, exclude_current=True, start=start, end=end), test_size))
    model = boosting.fit_trees(matrix, model_features(matrix), TARGET, params)
    scored = models.predict(model, matrix.where(F.col("split") == "test"))
    return model, metrics.forecast_metrics(scored), models.feature_importance(model, sales.sparkSession)


def predict_pooled(
    sales: DataFrame, model: boosting.BoostedTrees | models.PipelineModel, start: str | None = None, end: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Predictions with errors for every feature row, and their summary."""
    matrix = feature_matrix(sales, outliers=False, exclude_current=True, start=start, end=end)
    scored = models.predict(model, matrix).select(*KEYS, DATE, "actual", "predicted")
    errors = add_forecast_errors(scored)
    return errors, metrics.error_summary(errors)


def _series_matrix(sales: DataFrame, min_points: int, start: str | None, end: str | None) -> tuple[DataFrame, DataFrame]:
    """Status of every series, and the features of those with enough rows."""
    rows = panel.between(series_rows(sales).na.drop(subset=list(KEYS)), DATE, start, end)
    day, total = F.col(DATE).cast("date").alias(DATE), F.sum(known(rows, TARGET))
    daily = cut_lineage(
        rows.groupBy(*KEYS, day).agg(F.coalesce(total, F.lit(0)).alias(TARGET), F.count(F.lit(1)).alias("_rows"))
    )
    status = point_status(daily.groupBy(*KEYS).agg(F.sum("_rows").alias("data_points")), min_points)
    ready = status.where(F.col("status") == "ready").select(*KEYS)
    panel_rows = daily.drop("_rows").join(ready, list(KEYS), "left_semi")
    dense = prep.treat_outliers(panel.densify(panel_rows))
    return status, feature_ops.build_features(dense, exclude_current=True)


def batch_train(
    sales: DataFrame,
    min_points: int = config.MIN_POINTS,
    test_size: float = config.TEST_SIZE,
    fit: training.Fit = training.fit_ridge,
    model_path: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One model per series with enough rows: result rows and the models.

    Rows with a NULL key belong to no series and are left out.  The sales table is read once: the daily panel, with its row counts, is written and
    feeds both the status rows and the features.  The models are written once too.
    """
    status, matrix = _series_matrix(sales, min_points, start, end)
    names = model_features(matrix)
    trained = cut_lineage(
        training.train_series(matrix, names, test_size=test_size, min_rows=min_points // 2, fit=fit)
    )
    return training.batch_results(status, trained, model_path=model_path), trained


def batch_train_boosted(
    sales: DataFrame,
    params: dict | None = None,
    min_points: int = config.MIN_POINTS,
    test_size: float = config.TEST_SIZE,
    model_path: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> tuple[DataFrame, series_boosting.SeriesTrees]:
    """As :func:`batch_train`, with boosted trees for each series, all trained in the same passes.

    Params are those of ``config.BOOSTING_PARAMS``.
    """
    status, matrix = _series_matrix(sales, min_points, start, end)
    # the test rows are read again, so the features are written once
    matrix = cut_lineage(splits.three_way_split(matrix, test_size))
    sizes = matrix.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("feature_rows"))
    enough = F.col("feature_rows") >= min_points // 2
    ready = matrix.join(sizes.where(enough).select(*KEYS), list(KEYS), "left_semi")
    model = series_boosting.fit_series_trees(ready, model_features(matrix), TARGET, params)
    scored = models.predict(model, ready.where(F.col("split") == "test"))
    measured = metrics.forecast_metrics(scored, list(KEYS)).select(*KEYS, "rmse", "mae", "mape", "r2")
    has_model = F.coalesce("_model", F.lit(False))
    short = F.concat(F.lit("not enough rows after features ("), F.col("feature_rows").cast("string"), F.lit(")"))
    trained = sizes.join(measured, list(KEYS), "left").join(model.series.select(*KEYS, F.lit(True).alias("_model")), list(KEYS), "left").select(
        *KEYS, F.when(has_model, "success").otherwise("failed").alias("status"), F.when(has_model, "trained").otherwise(short).alias("message"),
        "feature_rows", "rmse", "mae", "mape", "r2",
    )
    return training.batch_results(status, trained, model_path=model_path), model


def batch_predict(
    sales: DataFrame, trained: DataFrame, requests: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Predictions of the per-series models for the requested pairs."""
    wanted = series_rows(sales).join(requests.select(*KEYS).distinct(), list(KEYS), "left_semi")
    dense = clean_panel(wanted, outliers=False, start=start, end=end)
    matrix = feature_ops.build_features(dense, exclude_current=True)
    scored = training.predict_series(matrix, trained, model_features(matrix))
    return training.batch_predictions(requests, scored)


def batch_forecast(
    sales: DataFrame,
    trained: DataFrame,
    periods: int = config.FORECAST_HORIZON,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The next days of every series that has a model, each day from the ones before it."""
    good = trained.where(F.col("status") == "success").select(*KEYS)
    wanted = series_rows(sales).join(good, list(KEYS), "left_semi")
    history = clean_panel(wanted, outliers=False, start=start, end=end)
    return training.forecast_series(history, trained, feature_ops.feature_names(), periods)


def daily_run(
    sales: DataFrame,
    as_of: Date,
    horizon: int = config.FORECAST_HORIZON,
    min_points: int = config.MIN_POINTS,
    products: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Load the five years up to ``as_of``, train per series, forecast, check the error."""
    recent = scan_sales(sales, as_of=as_of, last_five_years=True, columns=list(config.SERIES_RENAMES))
    if products is not None:
        recent = recent.where(F.col("gcode").isin(list(products)))
    results, _ = batch_train(recent, min_points)
    results = cut_lineage(results)
    good = results.where(F.col("status") == "success").select(*KEYS)
    history = clean_panel(series_rows(recent).join(good, list(KEYS), "left_semi"))
    return {
        "results": results,
        "summary": metrics.batch_summary(results),
        "forecast": forecast_ops.forecast(history, horizon),
        "performance": metrics.rmse_alert(results.where(F.col("status") == "success")),
    }
