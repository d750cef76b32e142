"""Additive forecasts: piecewise linear trend plus seasonal Fourier terms."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.dates import next_periods, period_end
from seriesworks.operators.splits import rolling_cutoffs, rolling_origin_rows
from seriesworks.session import cut_lineage

CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_SCALE = 0.05
SEASONAL_SCALE = 10.0
#: Share of the values that an interval is to hold.
INTERVAL_WIDTH = 0.8

Seasonalities = Sequence[tuple[str, float, int]]


def _epoch_days(date: str) -> Column:
    return F.date_diff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date"))


def fourier_names(seasonalities: Seasonalities = tuple(config.SEASONALITIES)) -> list[str]:
    return [f"{name}_{f}_{k}" for name, _, order in seasonalities for k in range(1, order + 1) for f in ("sin", "cos")]


def fourier_columns(
    date: str = config.DATE, seasonalities: Seasonalities = tuple(config.SEASONALITIES)
) -> dict[str, Column]:
    """sin and cos of each harmonic, by days since 1970-01-01."""
    t = _epoch_days(date)
    new = {}
    for name, period, order in seasonalities:
        for k in range(1, order + 1):
            angle = 2 * F.pi() * F.lit(k) * t / F.lit(period)
            new[f"{name}_sin_{k}"] = F.sin(angle)
            new[f"{name}_cos_{k}"] = F.cos(angle)
    return new


def add_fourier(
    df: DataFrame, date: str = config.DATE, seasonalities: Seasonalities = tuple(config.SEASONALITIES)
) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in fourier_columns(date, seasonalities).items()])


def future_frame(
    df: DataFrame,
    periods: int = config.FORECAST_HORIZON,
    freq: str = "D",
    include_history: bool = False,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
) -> DataFrame:
    """The next ``periods`` dates after each series' end, optionally with its own dates."""
    last = df.groupBy(*keys).agg(F.max(F.col(date).cast("date")).alias("_last"))
    first = period_end(F.date_add("_last", 1), freq)
    dates = F.concat(F.array(first), next_periods(first, F.lit(periods - 1), freq))
    future = last.select(*keys, F.explode(dates).alias(date), F.lit(True).alias("is_future"))
    if not include_history:
        return future
    history = df.select(*keys, F.col(date).cast("date").alias(date), F.lit(False).alias("is_future"))
    return history.unionByName(future)


def fit_additive(
    history: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    seasonalities: Seasonalities = tuple(config.SEASONALITIES),
    changepoints: int = CHANGEPOINTS,
) -> DataFrame:
    """One row of coefficients per series (ridge; a group is one daily series).

    The trend may bend at ``changepoints`` places at most; without any, and without
    seasonalities, the fit is a straight regression line.
    """
    keys = list(keys)
    names = fourier_names(seasonalities)
    key_fields = [f"{f.name} {f.dataType.simpleString()}" for f in history.select(*keys).schema.fields]
    schema = ", ".join(
        [
            *key_fields,
            "message string, intercept double, slope double, origin double",
            "changepoints array<double>, changes array<double>, seasonal array<double>",
            "last double, variance double, bend_rate double, bend_spread double",
        ]
    )

    def fit_one(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {k: pdf[k].iloc[0] for k in keys} | {
            "message": "", "intercept": None, "slope": None, "origin": None,
            "changepoints": None, "changes": None, "seasonal": None,
            "last": None, "variance": None, "bend_rate": None, "bend_spread": None,
        }
        try:
            pdf = pdf.dropna(subset=[target]).sort_values("_t")
            t, y = pdf["_t"].to_numpy(dtype=float), pdf[target].to_numpy(dtype=float)
            if len(y) < 2:
                raise ValueError("fewer than two rows")
            span, scale = t[-1] - t[0] or 1.0, np.abs(y).max() or 1.0
            u = (t - t[0]) / span
            inner = int(len(u) * CHANGEPOINT_RANGE)
            count = min(changepoints, max(inner - 1, 0))
            knots = u[np.linspace(0, max(inner - 1, 0), count + 1).round().astype(int)][1:]
            hinges = np.maximum(u[:, None] - knots[None, :], 0.0)
            x = np.column_stack([np.ones_like(u), u, hinges, pdf[names].to_numpy(dtype=float)])
            penalty = np.concatenate(
                [[1e-9, 1e-6], np.full(count, CHANGEPOINT_SCALE**-2), np.full(len(names), SEASONAL_SCALE**-2)]
            )
            square = x.T @ x
            beta = np.linalg.solve(square + np.diag(penalty), x.T @ (y / scale)) * scale
            # rows less what the fit has used up of them (the trace of the matrix that smooths y)
            free = len(y) - np.trace(np.linalg.solve(square + np.diag(penalty), square))
            changes = beta[2 : 2 + count] / span
            row |= {
                "message": "trained",
                "intercept": float(beta[0]),
                "slope": float(beta[1] / span),
                "origin": float(t[0]),
                "changepoints": [float(v) for v in t[0] + knots * span],
                "changes": [float(v) for v in changes],
                "seasonal": [float(v) for v in beta[2 + count :]],
                "last": float(t[-1]),
                "variance": float(((y - x @ beta) ** 2).sum() / max(free, 1.0)),
                "bend_rate": count / span,
                "bend_spread": float(np.abs(changes).mean()) if count else 0.0,
            }
        except Exception as problem:  # one bad series must not stop the job
            row["message"] = f"{type(problem).__name__}: {problem}"
        return pd.DataFrame([row])

    rows = history.select(
        *keys,
        _epoch_days(date).alias("_t"),
        F.col(target).cast("double").alias(target),
        *[c.alias(n) for n, c in fourier_columns(date, seasonalities).items()],
    )
    return rows.groupBy(*keys).applyInPandas(fit_one, schema)


def predict_additive(
    frame: DataFrame,
    models: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    seasonalities: Seasonalities = tuple(config.SEASONALITIES),
) -> DataFrame:
    """Trend, seasonal part and their sum for each (series, date) of ``frame``."""
    joined = frame.join(models.where(F.col("intercept").isNotNull()), list(keys))
    t = _epoch_days(date)
    steps = F.zip_with("changes", "changepoints", lambda d, at: d * F.greatest(t - at, F.lit(0.0)))
    terms = F.zip_with("seasonal", F.array(*fourier_columns(date, seasonalities).values()), lambda b, x: b * x)
    base = F.col("intercept") + F.col("slope") * (t - F.col("origin"))
    trend = F.aggregate(steps, base, lambda total, s: total + s)
    seasonal = F.aggregate(terms, F.lit(0.0), lambda total, s: total + s)
    return joined.select(*frame.columns, trend.alias("trend"), seasonal.alias("seasonal_part")).withColumn(
        "predicted", F.col("trend") + F.col("seasonal_part")
    )


def add_interval(
    predictions: DataFrame,
    models: DataFrame,
    width: float = INTERVAL_WIDTH,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
) -> DataFrame:
    """Add ``lower`` and ``upper``: ``width`` of the values are expected between them.

    The variance is the residuals' plus, for days after the series' end, the trend's.  The
    trend goes on bending as often as in the past and by changes of the same mean size
    (double exponential): h days ahead that adds ``rate * 2 * size ** 2 * h ** 3 / 3``.
    """
    z = NormalDist().inv_cdf(0.5 + width / 2)
    spread = models.select(*keys, "last", "variance", "bend_rate", "bend_spread")
    joined = predictions.join(spread, list(keys), "left")
    ahead = F.greatest(_epoch_days(date) - F.col("last"), F.lit(0.0))
    trend = F.col("bend_rate") * 2 * F.col("bend_spread") * F.col("bend_spread") * ahead * ahead * ahead / 3
    half = z * F.sqrt(F.col("variance") + trend)
    lower, upper = (F.col("predicted") - half).alias("lower"), (F.col("predicted") + half).alias("upper")
    return joined.select(*predictions.columns, lower, upper)


def forecast_with_interval(
    history: DataFrame,
    periods: int = config.FORECAST_HORIZON,
    freq: str = "D",
    width: float = INTERVAL_WIDTH,
    include_history: bool = False,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    **options,
) -> DataFrame:
    """The additive forecast with its interval; ``options`` go to the fit."""
    models = cut_lineage(fit_additive(history, keys, date, target, **options))  # read for the forecast and for its interval
    frame = future_frame(history, periods, freq, include_history, keys, date)
    seasonalities = {k: options[k] for k in ("seasonalities",) if k in options}
    return add_interval(predict_additive(frame, models, keys, date, **seasonalities), models, width, keys, date)


def forecast(
    history: DataFrame,
    periods: int = config.FORECAST_HORIZON,
    freq: str = "D",
    include_history: bool = False,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
) -> DataFrame:
    models = fit_additive(history, keys, date, target)
    frame = future_frame(history, periods, freq, include_history, keys, date)
    return predict_additive(frame, models, keys, date)


def cross_validate_additive(
    history: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    seasonalities: Seasonalities = tuple(config.SEASONALITIES),
    initial: int = config.CV_INITIAL_DAYS,
    period: int = config.CV_PERIOD_DAYS,
    horizon: int = config.CV_HORIZON_DAYS,
) -> DataFrame:
    """Rolling-origin forecasts: each series is fitted anew up to each of its cutoffs.

    One row per (series, cutoff, day of the horizon) with ``actual`` and ``predicted``.
    The fits are groups of (series, cutoff), so they run side by side.
    """
    keys = list(keys)
    cutoffs = rolling_cutoffs(history, keys, date, initial, period, horizon).select(*keys, "cutoff")
    training = history.join(cutoffs, keys).where(F.col(date) <= F.col("cutoff"))
    models = fit_additive(training, [*keys, "cutoff"], date, target, seasonalities)
    rows = rolling_origin_rows(history, keys, date, initial, period, horizon)
    scored = predict_additive(rows, models, [*keys, "cutoff"], date, seasonalities)
    return scored.select(*keys, "cutoff", date, "horizon", F.col(target).cast("double").alias("actual"), "predicted")


def seasonal_naive(period: int = 7) -> Callable[[np.ndarray], float]:
    """A model that repeats the value of ``period`` days before."""
    return lambda past: past[-period] if len(past) >= period else float("nan")


def forecast_recursive(
    history: DataFrame,
    model: Callable[[np.ndarray], float],
    periods: int = config.FORECAST_HORIZON,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
) -> DataFrame:
    """The next ``periods`` days of each daily series, each from the ones before it.

    ``model`` gets the values so far, forecasts included, and returns the next one: that
    is how models on lags see further than one day.  NaN becomes NULL.
    """
    keys = list(keys)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in history.select(*keys).schema.fields]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t")
        values = np.empty(len(pdf) + periods)
        values[: len(pdf)] = pdf["_y"].to_numpy(dtype=float)
        for i in range(len(pdf), len(values)):
            values[i] = model(values[:i])
        rows = {k: pdf[k].iloc[0] for k in keys} | {"_t": pdf["_t"].iloc[-1] + np.arange(1, periods + 1)}
        return pd.DataFrame(rows | {"step": np.arange(1, periods + 1), "predicted": values[len(pdf) :]})

    rows = history.select(*keys, _epoch_days(date).alias("_t"), F.col(target).cast("double").alias("_y"))
    done = rows.groupBy(*keys).applyInPandas(one, ", ".join([*fields, "_t int, step int, predicted double"]))
    value = F.nanvl(F.col("predicted"), F.lit(None).cast("double"))
    return done.select(*keys, F.date_from_unix_date("_t").alias(date), "step", value.alias("predicted"))
