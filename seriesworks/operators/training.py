"""One small model per series, trained in parallel over the panel.

A group handed to Python is one series of a daily panel, so its size is bounded by
the number of days.  A failing series becomes a row with a message; the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.dates import cyclic_parts, date_parts

PENALTIES = (0.1, 1.0, 10.0, 100.0)

Fit = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[float, np.ndarray]]


def ridge(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of ridge regression on standardised columns."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1.0
    z = (x - mean) / spread
    weights = np.linalg.solve(z.T @ z + penalty * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    coefficients = weights / spread
    return float(y.mean() - mean @ coefficients), coefficients


def fit_ridge(
    x: np.ndarray, y: np.ndarray, x_valid: np.ndarray, y_valid: np.ndarray
) -> tuple[float, np.ndarray]:
    """Ridge with the penalty that does best on the validation rows."""
    fits = [ridge(x, y, p) for p in PENALTIES]
    if len(y_valid) == 0:
        return fits[1]
    errors = [np.mean((y_valid - a - x_valid @ b) ** 2) for a, b in fits]
    return fits[int(np.argmin(errors))]


def score(y: np.ndarray, predicted: np.ndarray) -> dict[str, float | None]:
    """rmse, mae, mape and r2 of one series."""
    if len(y) == 0:
        return dict.fromkeys(("rmse", "mae", "mape", "r2"))
    error = y - predicted
    residual, total = float(error @ error), float(np.sum((y - y.mean()) ** 2))
    moving = y != 0
    return {
        "rmse": float(np.sqrt(np.mean(error**2))),
        "mae": float(np.mean(np.abs(error))),
        "mape": float(np.mean(np.abs(error[moving] / y[moving])) * 100) if moving.any() else float("inf"),
        "r2": 1 - residual / total if total > 0 else float(residual == 0),
    }


def train_series(
    features: DataFrame,
    names: Sequence[str],
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    test_size: float = config.TEST_SIZE,
    min_rows: int = config.MIN_POINTS // 2,
    fit: Fit = fit_ridge,
) -> DataFrame:
    """Fit every series; one result row each with metrics on its last rows."""
    keys, names = list(keys), list(names)
    key_fields = [f"{f.name} {f.dataType.simpleString()}" for f in features.select(*keys).schema.fields]
    schema = ", ".join(
        [
            *key_fields,
            "status string, message string, feature_rows bigint, rmse double, mae double, mape double, r2 double",
            "intercept double, coefficients array<double>",
        ]
    )

    def train_one(pdf: pd.DataFrame) -> pd.DataFrame:
        row = {k: pdf[k].iloc[0] for k in keys} | {
            "status": "failed", "message": "", "feature_rows": len(pdf),
            "rmse": None, "mae": None, "mape": None, "r2": None, "intercept": None, "coefficients": None,
        }
        try:
            if len(pdf) < min_rows:
                row["message"] = f"not enough rows after features ({len(pdf)})"
            else:
                pdf = pdf.sort_values(date)
                x, y = pdf[names].to_numpy(dtype=float), pdf[target].to_numpy(dtype=float)
                train = int(len(pdf) * (1 - test_size))
                fitted = train - int(train * config.VALIDATION_SHARE)
                intercept, coefficients = fit(x[:fitted], y[:fitted], x[fitted:train], y[fitted:train])
                row |= score(y[train:], intercept + x[train:] @ coefficients)
                row |= {
                    "status": "success", "message": "trained",
                    "intercept": float(intercept), "coefficients": [float(c) for c in coefficients],
                }
        except Exception as problem:  # one bad series must not stop the job
            row["message"] = f"{type(problem).__name__}: {problem}"
        return pd.DataFrame([row])

    needed = features.select(*keys, date, F.col(target).cast("double").alias(target), *[F.col(n).cast("double").alias(n) for n in names])
    return needed.groupBy(*keys).applyInPandas(train_one, schema)


def batch_results(
    status: DataFrame,
    trained: DataFrame,
    keys: Sequence[str] = config.KEYS,
    model_path: str | None = None,
) -> DataFrame:
    """One result row per series of ``profile.series_status``, short series included."""
    points = status.select(*keys, "data_points", F.col("status").alias("_ready"), F.col("message").alias("_short"))
    trained = trained.withColumnRenamed("message", "_message").withColumnRenamed("status", "_status")
    skipped = F.when(F.col("_ready") == "skipped", F.col("_short"))
    return points.join(trained, list(keys), "left").select(
        *keys,
        F.coalesce("_status", F.lit("failed")).alias("status"),
        F.coalesce("_message", skipped, F.lit("not enough rows after features (0)")).alias("message"),
        "data_points",
        "rmse",
        "mae",
        "mape",
        "r2",
        F.when(F.col("_status") == "success", F.lit(model_path)).alias("model_path"),
    )


def predict_series(
    features: DataFrame,
    models: DataFrame,
    names: Sequence[str],
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
) -> DataFrame:
    """Dot product of each feature row with its series' coefficients, inside the JVM."""
    keys = list(keys)
    x = F.array(*[F.col(n).cast("double") for n in names])
    terms = F.zip_with("coefficients", x, lambda a, b: a * b)
    scored = features.join(models.where(F.col("status") == "success").select(*keys, "intercept", "coefficients"), keys)
    return scored.select(
        *keys,
        date,
        F.col(target).cast("double").alias("actual"),
        F.aggregate(terms, F.col("intercept"), lambda total, t: total + t).alias("predicted"),
    )


def next_features(values: np.ndarray, names: Sequence[str], target: str = config.TARGET) -> np.ndarray:
    """Features of the day after ``values``, as ``build_features(exclude_current=True)`` has them; NaN for calendar names."""
    out = np.full(len(names), np.nan)
    for i, name in enumerate(names):
        kind, *rest = name.removeprefix(f"{target}_").split("_")
        if not name.startswith(f"{target}_"):
            continue
        if kind == "lag":
            out[i] = values[-int(rest[0])]
        elif kind == "rolling":
            last = values[-int(rest[0]) :]
            out[i] = {"mean": np.mean, "min": np.min, "max": np.max, "median": np.median}.get(rest[1], lambda x: np.std(x, ddof=1))(last)
        elif kind == "diff":
            out[i] = values[-1] - values[-1 - int(rest[0])]
        else:
            out[i] = {"cumsum": np.sum, "cummean": np.mean}.get(kind, lambda x: np.std(x, ddof=1))(values)
    return out


def forecast_series(
    history: DataFrame,
    models: DataFrame,
    names: Sequence[str],
    periods: int = config.FORECAST_HORIZON,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
) -> DataFrame:
    """The next ``periods`` days of each daily series by its trained model, (keys, date, step, predicted).

    Models on lags see one day ahead, so each forecast becomes a value that the later ones
    are computed from.  ``names`` are the features in the order of the coefficients.  A
    series is one row here: its values, its coefficients and the calendar features of the
    days to come; series without a model, or shorter than the longest look-back, give NULL.
    """
    keys, names = list(keys), list(names)
    calendar = [n for n in names if not n.startswith(f"{target}_")]
    day = F.col(date).cast("date")
    past = history.where(F.col(target).isNotNull()).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(day.alias("d"), F.col(target).cast("double").alias("y")))).alias("_past")
    )
    joined = past.join(models.where(F.col("status") == "success").select(*keys, "intercept", "coefficients"), keys, "left")
    last = F.element_at("_past", -1)["d"]
    ahead = F.sequence(F.date_add(last, 1), F.date_add(last, periods))

    def parts(d):
        own = date_parts(d) | cyclic_parts(d)
        return F.array(*[own[n].cast("double") for n in calendar], F.lit(0.0))

    rows = joined.select(
        *keys, ahead.alias("_dates"), F.transform(ahead, parts).alias("_calendar"), F.transform("_past", lambda p: p["y"]).alias("_values"),
        "intercept", "coefficients",
    )
    place = [names.index(n) for n in calendar]
    back = max([int(n) for name in names for n in name.split("_") if n.isdigit() and name.startswith(f"{target}_")] or [0]) + 1

    @F.pandas_udf("array<double>")
    def run(past: pd.Series, calendar_rows: pd.Series, intercept: pd.Series, coefficients: pd.Series) -> pd.Series:
        out = []
        for own, days, a, b in zip(past, calendar_rows, intercept, coefficients):
            if b is None or a is None or len(own) < back:
                out.append([None] * periods)
                continue
            values, weights = np.empty(len(own) + periods), np.asarray(b, float)
            values[: len(own)] = own
            for step in range(periods):
                end = len(own) + step
                x = next_features(values[:end], names, target)
                x[place] = np.asarray(days[step], float)[:-1]
                values[end] = a + x @ weights
            out.append(values[len(own) :].tolist())
        return pd.Series(out)

    done = rows.withColumn("_predicted", run("_values", "_calendar", "intercept", "coefficients"))
    return done.select(*keys, F.posexplode(F.arrays_zip("_dates", "_predicted")).alias("step", "_day")).select(
        *keys, F.col("_day._dates").alias(date), (F.col("step") + 1).alias("step"), F.col("_day._predicted").alias("predicted")
    )


def batch_predictions(requests: DataFrame, predictions: DataFrame, keys: Sequence[str] = config.KEYS) -> DataFrame:
    """Predictions for the requested pairs; a pair without any becomes an error row."""
    joined = requests.join(predictions, list(keys), "left")
    return joined.withColumn("error", F.when(F.col("predicted").isNull(), F.lit("no model or no data")))
