"""Missing values, outliers and scaling, per series.

The input is a panel (unique keys and date), see ``panel.daily_totals``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.columns import nan_to_null, numeric_columns
from seriesworks.operators.panel import series_window, whole_series


def _carried(c: Column, w) -> Column:
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def _descending(keys: Sequence[str], date: str):
    # "next known value" as a running frame over the reversed order: linear, while
    # a frame up to unboundedFollowing is evaluated anew for every row
    return Window.partitionBy(*keys).orderBy(F.col(date).desc())


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column, one row per column."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "missing")


def fill_missing(
    df: DataFrame,
    method: str = "forward_fill",
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
) -> DataFrame:
    """Fill NULLs within each series; NaN counts as NULL.

    Methods: forward_fill, backward_fill, interpolate, mean, median, drop.
    Numeric values that stay NULL become 0; other types stay NULL.
    """
    numbers = set(numeric_columns(df))
    columns = list(columns or [c for c in df.columns if c not in (*keys, date)])
    df = nan_to_null(df, columns)
    if method == "drop":
        return df.na.drop(subset=columns)
    up, down = series_window(keys, date), _descending(keys, date)
    if method == "forward_fill":
        filled = {c: _carried(F.col(c), up) for c in columns}
    elif method == "backward_fill":
        filled = {c: _carried(F.col(c), down) for c in columns}
    elif method in ("mean", "median"):
        whole = whole_series(keys, date)

        def centre(c: str) -> Column:
            return F.avg(c) if method == "mean" else F.percentile(c, F.lit(0.5))

        filled = {c: F.coalesce(F.col(c), centre(c).over(whole)) for c in columns if c in numbers}
    elif method == "interpolate":
        return _interpolate(df, [c for c in columns if c in numbers], up, down)
    else:
        raise ValueError(f"unknown method: {method}")
    zero = F.lit(0)
    return df.withColumns({c: F.coalesce(e, zero) if c in numbers else e for c, e in filled.items()})


def _interpolate(df: DataFrame, columns: Sequence[str], up, down) -> DataFrame:
    """Linear in the row position; after the last known value that value is kept."""
    numbered = df.withColumn("_row", F.row_number().over(up))
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_row").alias("r"), F.col(c).alias("v"))) for c in columns}
    ends = numbered.withColumns(
        {f"_before_{c}": _carried(known[c], up) for c in columns}
        | {f"_after_{c}": _carried(known[c], down) for c in columns}
    )
    result = {}
    for c in columns:
        before, after = F.col(f"_before_{c}"), F.col(f"_after_{c}")
        share = F.try_divide(F.col("_row") - before["r"], after["r"] - before["r"])
        line = before["v"] + (after["v"] - before["v"]) * share
        result[c] = F.coalesce(F.col(c).cast("double"), line, before["v"], F.lit(0.0))
    helpers = ["_row", *[f"_before_{c}" for c in columns], *[f"_after_{c}" for c in columns]]
    return ends.withColumns(result).drop(*helpers)


def _with_bounds(
    df: DataFrame, column: str, methods: Sequence[str], threshold: float, keys: Sequence[str], date: str
) -> DataFrame:
    """Add ``_low_*`` and ``_high_*`` per method; each series' quantiles are taken once."""
    whole = whole_series(keys, date)
    low_p, high_p = config.WINSOR_LIMITS
    exprs = {}
    if "iqr" in methods or "clip" in methods:
        points = F.array(*[F.lit(p) for p in (0.25, 0.75, low_p, high_p)])
        exprs["_q"] = F.percentile(column, points).over(whole)
    if "zscore" in methods:
        exprs["_mean"], exprs["_std"] = F.avg(column).over(whole), F.stddev_samp(column).over(whole)
    spread = (F.col("_q")[1] - F.col("_q")[0]) * threshold
    width = F.col("_std") * threshold
    bounds = {
        "iqr": lambda: (F.col("_q")[0] - spread, F.col("_q")[1] + spread),
        "clip": lambda: (F.col("_q")[2], F.col("_q")[3]),
        "zscore": lambda: (F.col("_mean") - width, F.col("_mean") + width),
    }
    unknown = [m for m in methods if m not in bounds]
    if unknown:
        raise ValueError(f"unknown methods: {unknown}")
    columns = {}
    for m in methods:
        columns[f"_low_{m}"], columns[f"_high_{m}"] = bounds[m]()
    return df.withColumns(exprs).withColumns(columns)


def treat_outliers(
    df: DataFrame,
    column: str = config.TARGET,
    method: str = "iqr",
    threshold: float = config.OUTLIER_THRESHOLD,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
) -> DataFrame:
    """iqr and clip pull values back to the bounds; zscore replaces them by the mean."""
    bounded = _with_bounds(nan_to_null(df, [column]), column, [method], threshold, keys, date)
    x, low, high = F.col(column), F.col(f"_low_{method}"), F.col(f"_high_{method}")
    if method == "zscore":
        treated = F.when((x < low) | (x > high), F.col("_mean")).otherwise(x)
    else:
        # least/greatest skip NULLs, so a NULL value has to be kept apart
        treated = F.when(x.isNotNull(), F.least(F.greatest(x, low), high))
    return bounded.withColumn(column, treated).select(*df.columns)


def outlier_counts(
    df: DataFrame,
    column: str = config.TARGET,
    threshold: float = config.OUTLIER_THRESHOLD,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
) -> DataFrame:
    """Rows outside the iqr, zscore and clip bounds per series."""
    methods = ("iqr", "zscore", "clip")
    x = F.col(column)
    return (
        _with_bounds(df, column, methods, threshold, keys, date)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("points"),
            *[
                F.count_if((x < F.col(f"_low_{m}")) | (x > F.col(f"_high_{m}"))).alias(f"{m}_outliers")
                for m in methods
            ],
        )
    )


def fit_scaler(
    df: DataFrame, columns: Sequence[str], method: str = "minmax", keys: Sequence[str] = config.KEYS
) -> DataFrame:
    """Shift and scale per series and column, as a table to keep and reuse."""
    aggregates = []
    for c in columns:
        if method == "minmax":
            shift, scale = F.min(c), F.max(c) - F.min(c)
        elif method == "zscore":
            shift, scale = F.avg(c), F.stddev_pop(c)
        else:
            raise ValueError(f"unknown method: {method}")
        aggregates += [
            shift.cast("double").alias(f"{c}_shift"),
            F.coalesce(F.nullif(scale.cast("double"), F.lit(0.0)), F.lit(1.0)).alias(f"{c}_scale"),
        ]
    return df.groupBy(*keys).agg(*aggregates)


def apply_scaler(
    df: DataFrame, scaler: DataFrame, columns: Sequence[str], keys: Sequence[str] = config.KEYS
) -> DataFrame:
    joined = df.join(scaler, list(keys), "left")
    scaled = {c: (F.col(c) - F.col(f"{c}_shift")) / F.col(f"{c}_scale") for c in columns}
    helpers = [f"{c}_{part}" for c in columns for part in ("shift", "scale")]
    return joined.withColumns(scaled).drop(*helpers)


def scale(
    df: DataFrame, columns: Sequence[str], method: str = "minmax", keys: Sequence[str] = config.KEYS
) -> DataFrame:
    """Min-max or standard scaling in one pass; a constant column becomes 0."""
    whole = Window.partitionBy(*keys)
    scaled = {}
    for c in columns:
        if method == "minmax":
            shift, width = F.min(c).over(whole), F.max(c).over(whole) - F.min(c).over(whole)
        elif method == "zscore":
            shift, width = F.avg(c).over(whole), F.stddev_pop(c).over(whole)
        else:
            raise ValueError(f"unknown method: {method}")
        centred = F.col(c) - shift
        scaled[c] = F.when(width == 0, centred * 0.0).otherwise(F.try_divide(centred, width))
    return df.withColumns(scaled)
