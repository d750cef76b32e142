import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import days
from pyspark.sql import functions as F

from seriesworks.functions.columns import add_forecast_errors
from seriesworks.operators import metrics, splits

A, B, C = ("a", "x"), ("b", "y"), ("c", "z")


def sizes(df, column="split"):
    return {(r.drug_id, r[column]): r["count"] for r in df.groupBy("drug_id", column).count().collect()}


def test_demo_split_sizes(make_panel):
    df = make_panel({A: days("2020-01-01", range(1736)), B: days("2020-01-01", range(5))})
    assert sizes(splits.time_split(df)) == {("a", "train"): 1388, ("a", "test"): 348, ("b", "train"): 4, ("b", "test"): 1}
    got = sizes(splits.three_way_split(df))
    assert got[("a", "train")] + got[("a", "valid")] == 1388 and got[("a", "valid")] == 138
    assert ("b", "valid") not in got and got[("b", "train")] == 4


def test_split_is_in_time_order(make_panel):
    df = splits.three_way_split(make_panel({A: days("2020-01-01", range(100))}))
    edges = {r.split: (r.lo, r.hi) for r in df.groupBy("split").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()}
    assert edges["train"][1] < edges["valid"][0] and edges["valid"][1] < edges["test"][0]


@pytest.mark.parametrize("n", [6, 7, 23, 60])
def test_cv_folds_follow_time_series_split(make_panel, n):
    df = splits.cv_folds(make_panel({A: days("2020-01-01", range(n)), C: days("2020-01-01", range(3))}))
    rows = splits.fold_rows(df).where("drug_id = 'a'").toPandas()
    size = n // 6
    for i in range(1, 6):
        start = n - 5 * size + (i - 1) * size
        part = rows[rows["fold"] == i]
        assert sorted(part[part["role"] == "train"]["sales_quantity"]) == list(range(start))
        assert sorted(part[part["role"] == "valid"]["sales_quantity"]) == list(range(start, start + size))
    assert df.where("drug_id = 'c' and fold is not null").count() == 0


def brute_cutoffs(start, end, initial, period, horizon):
    cut, out = end - dt.timedelta(days=horizon), []
    while cut >= start + dt.timedelta(days=initial):
        out.append(cut)
        cut -= dt.timedelta(days=period)
    return out


@pytest.mark.parametrize("initial, period, horizon", [(365, 90, 30), (20, 5, 12), (10, 7, 7)])
def test_rolling_origin(make_panel, initial, period, horizon):
    df = make_panel({A: days("2020-01-01", range(500)), B: days("2020-01-01", range(8))})
    got = splits.rolling_cutoffs(df, initial=initial, period=period, horizon=horizon)
    want = brute_cutoffs(dt.date(2020, 1, 1), dt.date(2020, 1, 1) + dt.timedelta(days=499), initial, period, horizon)
    assert sorted(r.cutoff for r in got.where("drug_id = 'a'").collect()) == sorted(want)
    assert got.where("drug_id = 'b'").count() == 0
    rows = splits.rolling_origin_rows(df, initial=initial, period=period, horizon=horizon)
    pairs = {(r.date, r.cutoff) for r in rows.where("drug_id = 'a'").collect()}
    assert pairs == {(c + dt.timedelta(days=h), c) for c in want for h in range(1, horizon + 1)}


def frame(spark, actual, predicted, **more):
    return spark.createDataFrame(pd.DataFrame({"actual": actual, "predicted": predicted, **more}))


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    y, p = rng.integers(0, 9, 200).astype(float), rng.normal(4, 2, 200)
    row = metrics.forecast_metrics(frame(spark, y, p), details=True).first()
    e = y - p
    assert row.rmse == pytest.approx(np.sqrt((e**2).mean())) and row.mae == pytest.approx(np.abs(e).mean())
    assert row.r2 == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.mape == pytest.approx(np.abs(e[y != 0] / y[y != 0]).mean() * 100)
    assert row.std_error == pytest.approx(e.std()) and row.min_error == pytest.approx(np.abs(e).min())


def test_metric_edge_cases(spark):
    zero = metrics.forecast_metrics(frame(spark, [0.0, 0.0], [1.0, 0.0])).first()
    assert zero.mape == float("inf") and zero.r2 == 0.0
    assert metrics.forecast_metrics(frame(spark, [3.0, 3.0], [3.0, 3.0])).first().r2 == 1.0
    empty = metrics.forecast_metrics(frame(spark, [1.0], [1.0]).where("actual > 5")).first()
    assert empty.n == 0 and empty.rmse is None and empty.r2 is None and empty.mape is None


def test_error_columns(spark):
    rows = add_forecast_errors(frame(spark, [0.0, 4.0], [1.0, 5.0])).orderBy("actual").collect()
    assert rows[0].percentage_error is None and rows[1].percentage_error == 25.0 and rows[1].error == -1.0
    summary = metrics.error_summary(add_forecast_errors(frame(spark, [0.0, 4.0], [1.0, 5.0]))).first()
    assert (summary.mean_error, summary.mean_abs_error, summary.mean_percentage_error) == (-1.0, 1.0, 25.0)


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.5, 9.0, 9.0, -3.0], [4.0, 4.0]])
def test_histogram_matches_numpy(spark, values):
    got = metrics.residual_histogram(frame(spark, values, [0.0] * len(values), m="a"), ["m"]).orderBy("bin").toPandas()
    counts, edges = np.histogram(values, bins=50)
    assert got["count"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["bin_start"], edges[:-1], atol=1e-9)


def test_report_compare_and_cv_summary(spark):
    report = {r.metric: r.value for r in metrics.evaluation_report(frame(spark, [1.0, 3.0], [1.0, 2.0])).collect()}
    assert report["n"] == 2 and report["mae"] == 0.5 and set(report) == {"n", "rmse", "mae", "r2", "mape", "mean_error", "std_error", "max_error", "min_error"}
    table = spark.createDataFrame([("a", "rmse", 1.0), ("a", "mae", 2.0), ("b", "rmse", 3.0)], "model string, metric string, value double")
    got = {r.model: r for r in metrics.compare_models(table).collect()}
    assert got["a"].mae == 2.0 and got["b"].mae is None
    folds = spark.createDataFrame([(1.0,), (3.0,)], "rmse double")
    row = metrics.cv_summary(folds, names=["rmse"]).first()
    assert (row.rmse_mean, row.rmse_std) == (2.0, 1.0)


def test_horizon_metrics(spark):
    df = frame(spark, [1.0, 2.0, 0.0, 4.0], [1.5, 1.0, 1.0, 4.0], horizon=[1, 1, 1, 2], lo=[0.0] * 4, hi=[1.0] * 4)
    got = {r.horizon: r for r in metrics.horizon_metrics(df, lower="lo", upper="hi").collect()}
    assert got[1].mdape == pytest.approx(0.5) and got[1].mape == pytest.approx(0.5)
    assert got[1].smape == pytest.approx(np.mean([2 * 0.5 / 2.5, 2 / 3, 2.0])) and got[1].coverage == pytest.approx(2 / 3)
    assert got[2].mse == 0 and got[2].mdape == 0 and got[2].coverage == 0


def test_batch_summary_and_alert(spark):
    schema = "drug_id string, hospital_id string, status string, message string, data_points bigint, rmse double, mae double, mape double, r2 double"
    df = spark.createDataFrame(
        [("a", "x", "success", "", 200, 10.0, 5.0, 1.0, 0.5), ("b", "y", "failed", "short", 3, None, None, None, None)], schema
    )
    row = metrics.batch_summary(df).first()
    assert (row.total, row.succeeded, row.failed, row.success_rate, row.avg_rmse) == (2, 1, 1, 50.0, 10.0)
    assert [tuple(r) for r in metrics.failed_series(df).collect()] == [("b", "y", "short", 3)]
    assert metrics.rmse_alert(df).first().status == "ok" and metrics.rmse_alert(df, 5.0).first().status == "alert"
    assert metrics.rmse_alert(df.where("false")).first().status == "no_results"


def test_running_best(spark):
    df = spark.createDataFrame([(0, 5.0), (1, 7.0), (2, 3.0)], "trial int, score double")
    assert [r.best_so_far for r in metrics.running_best(df).orderBy("trial").collect()] == [5.0, 5.0, 3.0]
