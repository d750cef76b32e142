import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from conftest import days
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators import forecast, metrics, models, profile, splits, training
from seriesworks.plans import jobs
from seriesworks.session import cut_lineage

SMALL = {"num_boost_round": 5, "learning_rate": 0.3, "max_depth": 3, "min_data_in_leaf": 1, "bagging_fraction": 1.0, "feature_fraction": 1.0}


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(0)
    n = 400
    pdf = pd.DataFrame({"drug_id": rng.choice(["a", "b"], n), "hospital_id": "x", "f1": rng.normal(size=n), "f2": rng.normal(size=n), "noise": rng.normal(size=n)})
    pdf["sales_quantity"] = 5 * pdf["f1"] + 2 * pdf["f2"] + 20.0 * (pdf["drug_id"] == "b")
    pdf["split"] = ["train"] * 280 + ["valid"] * 40 + ["test"] * 80
    return cut_lineage(spark.createDataFrame(pdf))


def test_parameter_map():
    with pytest.raises(ValueError):
        models.boosting_arguments({"max_depth": 99})
    arguments, unused = models.boosting_arguments({"max_depth": 30})
    assert arguments["maxDepth"] == 30 and arguments["maxIter"] == 1000 and arguments["seed"] == 42
    assert models.boosting_arguments({})[0]["maxDepth"] == 5
    assert {"num_leaves", "lambda_l1", "lambda_l2", "bagging_freq"} <= set(unused)


def test_boosting_save_load_importance(spark, matrix, tmp_path):
    names = ["f1", "f2", "noise"]
    model = models.fit_boosting(matrix, names, params=SMALL, categorical=["drug_id"])
    scored = models.predict(model, matrix)
    assert set(scored.columns) == set(matrix.columns) | {"predicted", "actual"}
    fit = metrics.forecast_metrics(scored.where("split = 'test'")).first()
    assert fit.r2 > 0.7
    importance = models.feature_importance(model, spark)
    assert importance.first().feature == "drug_id_index"
    top = models.top_importance(importance, 2).collect()
    assert len(top) == 2 and top[0].share_of_max == 1.0
    models.save_model(model, str(tmp_path / "m"), spark, SMALL)
    loaded, features, params = models.load_model(str(tmp_path / "m"), spark)
    assert features == [*names, "drug_id_index"] and params == SMALL
    assert metrics.forecast_metrics(models.predict(loaded, matrix.where("split = 'test'"))).first().rmse == pytest.approx(fit.rmse)


def test_search_and_refit(spark, matrix):
    trials = models.sample_params(3, seed=1)
    assert trials == models.sample_params(3, seed=1)
    for t in trials:
        assert 20 <= t["num_leaves"] <= 100 and 0.01 <= t["learning_rate"] <= 0.3 and 3 <= t["max_depth"] <= 12
    grid = models.grid_params({"max_depth": [1, 3], "learning_rate": [0.3]})
    assert grid == [{"max_depth": 1, "learning_rate": 0.3}, {"max_depth": 3, "learning_rate": 0.3}]
    fixed = {k: v for k, v in SMALL.items() if k not in ("max_depth", "learning_rate")}
    tried = models.search(matrix, ["f1", "f2"], grid, **fixed)
    rows = tried.orderBy("trial").collect()
    assert rows[1].score < rows[0].score and models.best_params(tried) == grid[1]
    assert json.loads(rows[0].params) == grid[0]
    best = models.refit_best(matrix, ["f1", "f2"], tried, **fixed)
    assert metrics.forecast_metrics(models.predict(best, matrix.where("split = 'valid'"))).first().rmse == pytest.approx(rows[1].score)


def test_cross_validation_trains_on_earlier_folds_only(spark, make_panel):
    rng = np.random.default_rng(1)
    df = make_panel({("a", "x"): days("2020-01-01", rng.normal(10, 2, 120))}).withColumn("f", F.col("sales_quantity") * 2)
    found = models.cross_validate(splits.cv_folds(df, 2), ["f"], n_splits=2, params=SMALL)
    assert [r.fold for r in found.orderBy("fold").collect()] == [1, 2]
    summary = metrics.cv_summary(found).first()
    assert summary.folds == 2 and summary.r2_mean > 0.5


def test_ensembles(spark):
    rows = [(1, "lightgbm", 10.0), (1, "xgboost", 20.0), (1, "prophet", 30.0), (2, "lightgbm", 10.0), (2, "prophet", None), (2, "other", 99.0)]
    df = spark.createDataFrame(rows, "id int, model string, predicted double")
    got = {r.id: r for r in models.weighted_ensemble(df, ["id"], config.ENSEMBLE_WEIGHTS).collect()}
    assert got[1].predicted == pytest.approx(17.0) and got[1].models == 3
    assert got[2].predicted == pytest.approx(10.0) and got[2].models == 1
    x = np.random.default_rng(0).normal(size=(50, 2))
    stacked = spark.createDataFrame(pd.DataFrame({"p1": x[:, 0], "p2": x[:, 1], "sales_quantity": x @ [0.7, 0.3] + 1}))
    model = models.fit_stacking(stacked, ["p1", "p2"])
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), [0.7, 0.3], atol=1e-6)
    assert models.feature_importance(model, spark).first().feature == "p1"


def test_run_log(spark, tmp_path):
    table = spark.createDataFrame([("rmse", 1.0)], "metric string, value double")
    for run in ("r1", "r2"):
        models.log_run(table, str(tmp_path / "runs"), run, {"k": 1})
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_ridge_recovers_line():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    intercept, beta = training.ridge(x, x @ [1.0, -2.0, 0.0] + 4, 1e-6)
    assert intercept == pytest.approx(4, abs=1e-4)
    np.testing.assert_allclose(beta, [1, -2, 0], atol=1e-4)


def test_series_training_isolates_failures(spark, make_panel):
    df = make_panel({("a", "x"): days("2020-01-01", range(100)), ("b", "x"): days("2020-01-01", range(100)), ("c", "x"): days("2020-01-01", range(10))})
    df = df.withColumn("f", F.col("sales_quantity") + 1)

    def fit(x, y, xv, yv):
        if len(y) and x[0, 0] > 0 and y[0] == 0 and fit.fail:
            raise RuntimeError("broken series")
        return training.fit_ridge(x, y, xv, yv)

    fit.fail = False
    trained = training.train_series(df, ["f"], fit=fit)
    got = {r.drug_id: r for r in trained.collect()}
    assert got["a"].status == "success" and got["a"].r2 > 0.99 and len(got["a"].coefficients) == 1
    assert got["c"].status == "failed" and got["c"].message == "not enough rows after features (10)"
    scored = training.predict_series(df, trained, ["f"])
    np.testing.assert_allclose(*zip(*[(r.actual, r.predicted) for r in scored.collect()]), atol=0.5)
    fit.fail = True
    broken = {r.drug_id: r for r in training.train_series(df, ["f"], fit=fit).collect()}
    assert broken["a"].message == "RuntimeError: broken series" and broken["a"].rmse is None
    results = {r.drug_id: r for r in training.batch_results(profile.series_status(df, min_points=50), trained, model_path="p").collect()}
    assert results["a"].model_path == "p" and results["c"].status == "failed"
    asked = spark.createDataFrame([("a", "x"), ("z", "x")], "drug_id string, hospital_id string")
    answers = training.batch_predictions(asked, scored)
    assert answers.where("drug_id = 'a' and error is null").count() == 100
    assert answers.where("drug_id = 'z'").first().error == "no model or no data"


def test_future_frame(make_panel):
    df = make_panel({("a", "x"): [("2024-01-30", 1), ("2024-01-31", 1)]})
    dates = lambda *a, **k: [r.date for r in forecast.future_frame(df, *a, **k).orderBy("date").collect()]
    assert dates(2) == [dt.date(2024, 2, 1), dt.date(2024, 2, 2)]
    assert dates(2, "W") == [dt.date(2024, 2, 4), dt.date(2024, 2, 11)]
    assert dates(3, "M") == [dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 4, 30)]
    assert len(dates(1, include_history=True)) == 3


def test_additive_forecast_follows_trend_and_week(spark, make_panel):
    n = 400
    t = np.arange(n)
    first = dt.date(2021, 1, 1)
    y = 100 + 0.5 * t + 10 * np.sin(2 * np.pi * (t + first.weekday()) / 7)
    df = make_panel({("a", "x"): days("2021-01-01", y), ("short", "x"): days("2021-01-01", [1.0])})
    got = forecast.forecast(df, 14).orderBy("date").toPandas()
    assert set(got["drug_id"]) == {"a"} and len(got) == 14
    future = np.arange(n, n + 14)
    want = 100 + 0.5 * future + 10 * np.sin(2 * np.pi * (future + first.weekday()) / 7)
    assert np.abs(got["predicted"] - want).max() < 15
    models_table = forecast.fit_additive(df)
    assert models_table.where("drug_id = 'short'").first().message == "ValueError: fewer than two rows"


@pytest.fixture(scope="module")
def sales(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in ("p", "q"):
        for i in range(300):
            rows.append((g, "x", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(10 + 5 * np.sin(2 * np.pi * i / 7) + rng.normal(0, 0.5)), dt.date(2020, 12, 1)))
    rows += [("r", "x", dt.date(2020, 1, 1), 1.0, dt.date(2020, 12, 1))]
    return spark.createDataFrame(rows, "gcode string, cust_name string, create_dt date, qty double, dt date")


def test_batch_job(sales, spark):
    results, trained = jobs.batch_train(sales)
    got = {r.drug_id: r for r in results.collect()}
    assert got["p"].status == "success" and got["p"].r2 > 0.8 and got["p"].data_points == 300
    assert got["r"].status == "failed" and got["r"].message == "not enough data points (1 < 100)"
    asked = spark.createDataFrame([("p", "x"), ("r", "x")], "drug_id string, hospital_id string")
    answers = jobs.batch_predict(sales, trained, asked)
    assert answers.where("drug_id = 'p' and predicted is not null").count() == 300 - 90
    assert answers.where("drug_id = 'r'").first().error is not None


def test_pooled_job(sales):
    model, test, importance = jobs.train_pooled(sales, SMALL)
    assert test.first().n == 2 * (210 - int(210 * 0.8)) and importance.count() == 45
    errors, summary = jobs.predict_pooled(sales, model)
    assert errors.count() == 420 and summary.first().records == 420


def test_daily_job(sales):
    out = jobs.daily_run(sales, dt.date(2020, 10, 26), horizon=7)
    assert out["summary"].first().succeeded == 2
    assert out["forecast"].count() == 14
    assert out["performance"].first().status == "ok"
    assert config.RMSE_ALERT == 100.0
