"""Lag, rolling, difference and expanding features, and feature selection.

All columns are expressions over one window specification, so a full feature
build is one shuffle and one sort of the panel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.columns import feature_columns, feature_family, nan_to_null
from seriesworks.functions.dates import calendar_columns
from seriesworks.operators.panel import series_window


def lag_columns(target: str, w, lags: Sequence[int] = tuple(config.LAGS)) -> dict[str, Column]:
    return {f"{target}_lag_{n}": F.lag(target, n).over(w) for n in lags}


def _rolling_columns(
    target: str, w, windows: Sequence[int], statistics: Sequence[str], source: str, only_full: bool = False
) -> dict[str, Column]:
    """Statistics of the last n rows, from the rows themselves; NULL for incomplete windows.

    Sums that run from the start of the series would cost the same for any n, but lose
    all digits after a spike.  ``only_full`` says that incomplete windows are filtered
    out by their count (``_n_*``) later on.
    """
    unknown = [s for s in statistics if s not in config.STATISTICS]
    if unknown:
        raise ValueError(f"unknown statistics: {unknown}")
    new = {}
    for n in windows:
        frame = w.rowsBetween(1 - n, 0)
        value = {
            "mean": F.avg(source),
            "std": F.stddev_samp(source),
            "min": F.min(source),
            "max": F.max(source),
            "median": F.percentile(source, F.lit(0.5)),
        }
        full = F.count(source).over(frame)
        if only_full:
            new[f"_n_{n}"] = full
        for s in statistics:
            result = value[s].over(frame)
            new[f"{target}_rolling_{n}_{s}"] = result if only_full else F.when(full == n, result)
    return new


def diff_columns(target: str, w, periods: Sequence[int] = tuple(config.DIFF_PERIODS)) -> dict[str, Column]:
    return {f"{target}_diff_{p}": F.col(target) - F.lag(target, p).over(w) for p in periods}


def expanding_columns(target: str, w, source: str | None = None) -> dict[str, Column]:
    """Running sum, mean and standard deviation from the start of the series."""
    source = source or target
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    known = F.col(source).isNotNull()
    return {
        f"{target}_cumsum": F.when(known, F.sum(source).over(so_far)),
        f"{target}_cummean": F.avg(source).over(so_far),
        f"{target}_cumstd": F.stddev_samp(source).over(so_far),
    }


def _add(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in new.items()])


def add_lags(df, keys=config.KEYS, date=config.DATE, target=config.TARGET, lags=tuple(config.LAGS)):
    return _add(nan_to_null(df, [target]), lag_columns(target, series_window(keys, date), lags))


def add_rolling(
    df,
    keys=config.KEYS,
    date=config.DATE,
    target=config.TARGET,
    windows=tuple(config.WINDOWS),
    statistics=tuple(config.STATISTICS),
):
    """Statistics over the last n rows, current one included; NULL unless all n are known."""
    w = series_window(keys, date)
    return _add(nan_to_null(df, [target]), _rolling_columns(target, w, windows, statistics, target))


def add_diffs(df, keys=config.KEYS, date=config.DATE, target=config.TARGET, periods=tuple(config.DIFF_PERIODS)):
    return _add(nan_to_null(df, [target]), diff_columns(target, series_window(keys, date), periods))


def add_expanding(df, keys=config.KEYS, date=config.DATE, target=config.TARGET):
    return _add(nan_to_null(df, [target]), expanding_columns(target, series_window(keys, date)))


def build_features(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    lags: Sequence[int] = tuple(config.LAGS),
    windows: Sequence[int] = tuple(config.WINDOWS),
    statistics: Sequence[str] = tuple(config.STATISTICS),
    periods: Sequence[int] = tuple(config.DIFF_PERIODS),
    date_features: Sequence[str] = tuple(config.DATE_FEATURES),
    exclude_current: bool = False,
    drop_incomplete: bool = True,
) -> DataFrame:
    """The full feature matrix: keys, date, target and 45 features by default.

    By default rolling, difference and expanding features see the current target.
    ``exclude_current`` makes them end on the row before, for honest forecasts.
    """
    w = series_window(keys, date)
    df = nan_to_null(df, [target])
    source, matrix = target, df
    if exclude_current:
        source = "_previous"
        matrix = _add(df, {source: F.lag(target).over(w)})
    lagged = lag_columns(target, w, lags)
    differences = {f"{target}_diff_{p}": F.col(source) - F.lag(source, p).over(w) for p in periods}
    expanding = expanding_columns(target, w, source)
    rolling = _rolling_columns(target, w, windows, statistics, source, only_full=drop_incomplete)
    matrix = _add(matrix, lagged | differences | expanding | rolling)
    if drop_incomplete:
        # a full window is known by its count, so 20 rolling columns need 4 tests
        for n in windows:
            matrix = matrix.where(F.col(f"_n_{n}") == n)
        matrix = matrix.na.drop(subset=[*df.columns, *lagged, *differences, *expanding])
    # calendar columns come last, so that they are not carried through the windows
    return matrix.select(
        *df.columns,
        *[c.alias(n) for n, c in calendar_columns(date, date_features).items()],
        *lagged,
        *[n for n in rolling if not n.startswith("_n_")],
        *differences,
        *expanding,
    )


def feature_names(
    target: str = config.TARGET,
    lags: Sequence[int] = tuple(config.LAGS),
    windows: Sequence[int] = tuple(config.WINDOWS),
    statistics: Sequence[str] = tuple(config.STATISTICS),
    periods: Sequence[int] = tuple(config.DIFF_PERIODS),
    date_features: Sequence[str] = tuple(config.DATE_FEATURES),
) -> list[str]:
    """The features of ``build_features`` with the same arguments, in its order."""
    return [
        *date_features, "month_sin", "month_cos", "dayofweek_sin", "dayofweek_cos",
        *[f"{target}_lag_{n}" for n in lags],
        *[f"{target}_rolling_{n}_{s}" for n in windows for s in statistics],
        *[f"{target}_diff_{n}" for n in periods],
        *[f"{target}_{s}" for s in ("cumsum", "cummean", "cumstd")],
    ]


def feature_catalogue(df: DataFrame, keys=config.KEYS, date=config.DATE, target=config.TARGET) -> DataFrame:
    """Feature, its family and how many rows have it."""
    names = feature_columns(df, keys, date, target)
    counts = df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "non_null")
    families = F.create_map(*[F.lit(x) for n in names for x in (n, feature_family(n))])
    return counts.select("feature", families[F.col("feature")].alias("family"), "non_null")


def select_features(
    df: DataFrame,
    method: str = "correlation",
    threshold: float = config.SELECT_THRESHOLD,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
) -> DataFrame:
    """Score of each feature and whether it passes, from one aggregation pass.

    Rows are turned to (feature, value) and aggregated per feature with partial
    aggregates, which stays compact however many features there are.  Correlations use
    the rows where both values are known; a constant feature has a NULL score.
    """
    names = feature_columns(df, keys, date, target)
    cells = F.posexplode(F.array(*[F.col(c).cast("double") for c in names])).alias("_i", "_x")
    rows = df.select(F.col(target).cast("double").alias("_y"), cells)
    x, y = F.col("_x"), F.col("_y")
    if method == "correlation":
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        score = F.abs(F.try_divide(F.covar_pop(x, y), spread))
    elif method == "variance":
        score = F.var_samp(x)
    else:
        raise ValueError(f"unknown method: {method}")
    scores = rows.groupBy("_i").agg(score.alias("score"))
    feature = F.get(F.array(*[F.lit(c) for c in names]), "_i").alias("feature")
    return scores.select(feature, "score", F.coalesce(F.col("score") > threshold, F.lit(False)).alias("selected"))
