"""Forecast metrics, error summaries and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators.ranks import (
    attach_group_values,
    exact_quantiles,
    group_values,
    null_safe_join,
    quantile_columns,
    value_counts,
)
from seriesworks.session import cut_lineage

METRICS = ["rmse", "mae", "r2", "mape"]


def metric_columns(actual: str = "actual", predicted: str = "predicted") -> dict[str, Column]:
    """rmse, mae, r2 and mape (percent, over non-zero actuals; infinite without any)."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    pairs = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    residual = F.sum(error * error)
    total = F.var_pop(F.when(pairs, y)) * F.count_if(pairs)
    constant = F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    share = F.when(pairs & (y != 0), F.abs(F.try_divide(error, y)))
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "r2": F.when(F.count_if(pairs) > 0, F.coalesce(1 - F.try_divide(residual, total), constant)),
        "mape": F.when(F.count_if(pairs) > 0, F.coalesce(F.avg(share) * 100, F.lit(float("inf")))),
    }


def detail_columns(actual: str = "actual", predicted: str = "predicted") -> dict[str, Column]:
    error = F.col(actual) - F.col(predicted)
    return {
        "mean_error": F.avg(error),
        "std_error": F.stddev_pop(error),
        "max_error": F.max(F.abs(error)),
        "min_error": F.min(F.abs(error)),
    }


def forecast_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    actual: str = "actual",
    predicted: str = "predicted",
    details: bool = False,
) -> DataFrame:
    """One row of metrics per group; partial aggregates do the work before the shuffle.

    ``n`` counts the rows that the metrics see: those with both values known.
    """
    exprs = metric_columns(actual, predicted)
    if details:
        exprs |= detail_columns(actual, predicted)
    pairs = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    return df.groupBy(*by).agg(F.count_if(pairs).alias("n"), *[e.alias(n) for n, e in exprs.items()])


def metrics_long(metrics: DataFrame, by: Sequence[str] = (), names: Sequence[str] | None = None) -> DataFrame:
    """(metric, value) rows."""
    names = list(names or [c for c in metrics.columns if c not in by])
    return metrics.select(*by, *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        list(by), names, "metric", "value"
    )


def evaluation_report(
    df: DataFrame, by: Sequence[str] = (), actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """All metrics and the sample count in long form."""
    return metrics_long(forecast_metrics(df, by, actual, predicted, details=True), by)


def cv_summary(fold_metrics: DataFrame, by: Sequence[str] = (), names: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """Mean and population standard deviation of each metric over the folds."""
    aggregates = []
    for n in names:
        aggregates += [F.avg(n).alias(f"{n}_mean"), F.stddev_pop(n).alias(f"{n}_std")]
    return fold_metrics.groupBy(*by).agg(F.count(F.lit(1)).alias("folds"), *aggregates)


def horizon_metrics(
    df: DataFrame,
    horizon: str = "horizon",
    actual: str = "actual",
    predicted: str = "predicted",
    lower: str | None = None,
    upper: str | None = None,
) -> DataFrame:
    """mse, rmse, mae, mape, mdape, smape (fractions) and coverage per forecast horizon.

    A horizon holds one row per series and cutoff, so the median is taken by exact
    ranks over value ranges rather than by collecting a group.
    """
    y, p = F.col(actual), F.col(predicted)
    error = F.abs(y - p)
    needed = [horizon, actual, predicted, *[c for c in (lower, upper) if c]]
    # read twice below, for the averages and for the median
    rows = cut_lineage(df.select(*needed)).withColumns(
        {
            "_ape": F.try_divide(error, F.abs(y)),
            "_sape": F.coalesce(F.try_divide(2 * error, F.abs(y) + F.abs(p)), F.lit(0.0)),
        }
    )
    aggregates = [
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("mae"),
        F.avg("_ape").alias("mape"),
        F.avg("_sape").alias("smape"),
    ]
    if lower and upper:
        inside = ((y >= F.col(lower)) & (y <= F.col(upper))).cast("double")
        aggregates.append(F.avg(inside).alias("coverage"))
    counted = value_counts(group_values(rows, [horizon], "_ape"), [horizon])
    median = quantile_columns(exact_quantiles(counted, [horizon], [0.5]), [horizon], {0.5: "mdape"})
    return null_safe_join(rows.groupBy(horizon).agg(*aggregates), median, [horizon], "left")


def rolling_horizon_metrics(
    df: DataFrame,
    horizon: str = "horizon",
    actual: str = "actual",
    predicted: str = "predicted",
    rolling_window: float = 0.1,
) -> DataFrame:
    """mse, rmse, mae and smape over a window of ``rolling_window`` of all rows up to each horizon.

    The window takes the last rows by horizon; of the horizon that it enters it counts
    a part, by that horizon's mean.  Horizons with too few rows up to them have no
    result.  Rows are averaged per horizon first, so the windows run over horizons only.
    """
    y, p = F.col(actual), F.col(predicted)
    error = F.abs(y - p)
    sape = F.coalesce(F.try_divide(2 * error, F.abs(y) + F.abs(p)), F.lit(0.0))
    sums = {"mse": F.sum(error * error), "mae": F.sum(error), "smape": F.sum(F.when(error.isNotNull(), sape))}
    each = df.where(error.isNotNull()).groupBy(horizon).agg(F.count(F.lit(1)).alias("n"), *[e.alias(m) for m, e in sums.items()])
    so_far = Window.orderBy(horizon).rowsBetween(Window.unboundedPreceding, 0)  # one row a horizon
    upto = each.withColumns({"_total": F.sum("n").over(so_far)} | {f"_{m}": F.sum(m).over(so_far) for m in sums})
    parts = F.struct("n", "_total", *sums, *[f"_{m}" for m in sums])
    everything = Window.orderBy(horizon).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    size = F.greatest(F.floor(F.sum("n").over(everything) * rolling_window), F.lit(1))
    windows = upto.withColumns({"_size": size, "_parts": F.collect_list(parts).over(so_far)}).where(F.col("_total") >= F.col("_size"))
    skipped = F.col("_total") - F.col("_size")  # rows before the window
    entered = F.get(F.filter("_parts", lambda x: x["_total"] > skipped), F.lit(0))
    windows = windows.withColumn("_first", entered).withColumn("_skipped", skipped)
    first = F.col("_first")
    result = {}
    for m in sums:
        before = first[f"_{m}"] - first[m] + (F.col("_skipped") - first["_total"] + first["n"]) * first[m] / first["n"]
        result[m] = (F.col(f"_{m}") - before) / F.col("_size")
    return windows.select(
        horizon, F.col("_size").cast("long").alias("n"), result["mse"].alias("mse"), F.sqrt(result["mse"]).alias("rmse"),
        result["mae"].alias("mae"), result["smape"].alias("smape"),
    )


def prediction_summary(
    df: DataFrame, by: Sequence[str] = config.KEYS, predicted: str = "predicted", date: str = config.DATE
) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.avg(predicted).alias("avg_prediction"),
        F.max(predicted).alias("max_prediction"),
        F.min(predicted).alias("min_prediction"),
        F.min(date).alias("start_date"),
        F.max(date).alias("end_date"),
    )


def error_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summary of the columns made by ``add_forecast_errors``."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        F.avg("error").alias("mean_error"),
        F.avg("abs_error").alias("mean_abs_error"),
        F.avg("percentage_error").alias("mean_percentage_error"),
        F.max("predicted").alias("max_prediction"),
        F.min("predicted").alias("min_prediction"),
    )


def residual_histogram(
    df: DataFrame,
    by: Sequence[str],
    actual: str = "actual",
    predicted: str = "predicted",
    bins: int = config.RESIDUAL_BINS,
) -> DataFrame:
    """Counts in equal-width bins over each group's residual range, empty bins included.

    Residuals are counted per distinct value first, and the group's limits are attached
    by (group, value range), so a hot group is binned by many tasks.
    """
    by = list(by)
    rows = df.select(*by, (F.col(actual) - F.col(predicted)).alias("residual"))
    counted = value_counts(group_values(rows, by, "residual"), by)
    limited = attach_group_values(
        counted,
        by,
        {"_low": F.min("value"), "_high": F.max("value")},
        {"_first": F.min("_low"), "_last": F.max("_high")},
    )
    flat = F.col("_first") == F.col("_last")
    low = F.when(flat, F.col("_first") - 0.5).otherwise(F.col("_first"))
    high = F.when(flat, F.col("_last") + 0.5).otherwise(F.col("_last"))
    width = (F.col("high") - F.col("low")) / bins
    place = F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(bins - 1)).cast("int")
    filled = (
        limited.withColumns({"low": low, "high": high})
        .groupBy(*by, "low", "high", place.alias("bin"))
        .agg(F.sum("n").alias("count"))
    )
    # at most ``bins`` rows per group from here on
    frame = filled.select(*by, "low", "high").distinct()
    frame = frame.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return null_safe_join(frame, filled.drop("low", "high"), [*by, "bin"], "left").select(
        *by,
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def compare_models(long_metrics: DataFrame, names: Sequence[str] = tuple(METRICS)) -> DataFrame:
    """model x metric table from (model, metric, value) rows."""
    return long_metrics.groupBy("model").pivot("metric", list(names)).agg(F.first("value"))


def batch_summary(results: DataFrame) -> DataFrame:
    """Status counts, success rate in percent and mean metrics of the successes."""
    done = F.col("status") == "success"
    total = F.count(F.lit(1))
    return results.agg(
        total.alias("total"),
        F.count_if(done).alias("succeeded"),
        F.count_if(~done).alias("failed"),
        (F.try_divide(F.count_if(done), total) * 100).alias("success_rate"),
        *[F.avg(F.when(done, F.col(m))).alias(f"avg_{m}") for m in ("rmse", "mae", "mape", "r2")],
    )


def failed_series(results: DataFrame, keys: Sequence[str] = config.KEYS) -> DataFrame:
    return results.where(F.col("status") == "failed").select(*keys, "message", "data_points")


def rmse_alert(results: DataFrame, threshold: float = config.RMSE_ALERT) -> DataFrame:
    """Average RMSE and whether it is above the threshold."""
    average = F.avg("rmse")
    status = (
        F.when(average.isNull(), F.lit("no_results")).when(average > threshold, F.lit("alert")).otherwise(F.lit("ok"))
    )
    return results.agg(average.alias("avg_rmse"), status.alias("status"))


def running_best(
    trials: DataFrame, score: str = "score", trial: str = "trial", by: Sequence[str] = (), minimize: bool = True
) -> DataFrame:
    """Best score so far; one row per trial, so the trial table is small."""
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    so_far = w.orderBy(trial).rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumn("best_so_far", (F.min if minimize else F.max)(score).over(so_far))
