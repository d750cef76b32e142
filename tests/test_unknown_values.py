"""NaN, NULL, repeated days and groups, as the operators define them."""

import math

import pytest
from conftest import days

from seriesworks import config
from seriesworks.operators import drift, features, metrics, models, panel, prep, profile, ranks
from seriesworks.plans import jobs

NAN = float("nan")
SCHEMA = "drug_id string, hospital_id string, date date, sales_quantity double"


def test_rolling_after_a_spike_keeps_all_digits(make_panel):
    rows = make_panel({("a", "x"): days("2024-01-01", [1e9] + [1, 2, 3, 4, 5] * 8)})
    last = features.add_rolling(rows, windows=[7]).orderBy("date").collect()[-1]
    values = [4, 5, 1, 2, 3, 4, 5]
    mean = sum(values) / 7
    assert last["sales_quantity_rolling_7_mean"] == pytest.approx(mean, rel=1e-12)
    assert last["sales_quantity_rolling_7_std"] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / 6), rel=1e-12)


def test_nan_counts_as_null(make_panel):
    rows = make_panel({("a", "x"): days("2024-01-01", [1.0, NAN, 2.0, 3.0, 4.0, 5.0])})
    out = [r["sales_quantity_rolling_3_mean"] for r in features.add_rolling(rows, windows=[3]).orderBy("date").collect()]
    assert out == [None, None, None, None, 3.0, 4.0]
    filled = [r["sales_quantity"] for r in prep.fill_missing(rows, columns=["sales_quantity"]).orderBy("date").collect()]
    assert filled == [1.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    treated = [r["sales_quantity"] for r in prep.treat_outliers(rows).orderBy("date").collect()]
    assert treated[1] is None
    dense = [r["sales_quantity"] for r in panel.densify(rows).orderBy("date").collect()]
    assert dense == [1.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert features.add_expanding(rows).orderBy("date").collect()[-1]["sales_quantity_cumsum"] == 15.0


def test_a_day_without_known_values_is_zero(make_panel):
    rows = make_panel({("a", "x"): [("2024-01-01", None), ("2024-01-01", NAN), ("2024-01-02", 2.0)]})
    assert [r["sales_quantity"] for r in panel.daily_totals(rows).orderBy("date").collect()] == [0.0, 2.0]


def test_repeated_days_invent_no_days(make_panel):
    rows = make_panel({("a", "x"): [("2024-01-01", 1.0), ("2024-01-01", 2.0), ("2024-01-03", 3.0)]})
    found = [(str(r["date"])) for r in panel.densify(rows).orderBy("date").collect()]
    assert found == ["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-03"]


def test_times_of_day_are_one_day(spark):
    rows = spark.sql(
        "SELECT 'a' AS drug_id, 'x' AS hospital_id, explode(array(timestamp'2024-01-01 08:00:00', timestamp'2024-01-01 20:00:00')) AS date, "
        "1.5 AS sales_quantity"
    )
    assert [float(r["sales_quantity"]) for r in panel.daily_totals(rows).collect()] == [3.0]


def test_stray_dates_are_cut_off(spark, make_panel):
    rows = make_panel({("a", "x"): [("1810-01-01", 1.0), ("2024-01-01", 2.0)]})
    assert jobs.clean_panel(rows, outliers=False, start="2020-01-01").count() == 1


def test_null_groups_stay(spark):
    rows = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, x double")
    out = {r["g"]: (r["mean"], r["median"]) for r in profile.describe_column(rows, "x", ["g"]).collect()}
    assert out == {None: (2.0, 2.0), "a": (5.0, 5.0)}
    pairs = spark.createDataFrame([(None, 1.0, 0.0), (None, 2.0, 0.0), (1, 2.0, 1.0)], "horizon int, actual double, predicted double")
    assert {r["horizon"]: r["mdape"] for r in metrics.horizon_metrics(pairs).collect()} == {None: 1.0, 1: 0.5}
    histogram = metrics.residual_histogram(pairs, ["horizon"], bins=2).collect()
    assert sum(r["count"] for r in histogram if r["horizon"] is None) == 2


def test_columns_without_values_stay_in_the_baseline(spark):
    rows = spark.createDataFrame([(1.0, None), (3.0, None)], "x double, y double")
    out = {r["feature"]: r["mean"] for r in drift.baseline_stats(rows, ["x", "y"]).collect()}
    assert out == {"x": 2.0, "y": None}


def test_infinite_metrics_on_both_sides_are_no_drift(spark):
    one = spark.createDataFrame([("mape", float("inf")), ("rmse", 1.0)], "metric string, value double")
    two = spark.createDataFrame([("mape", float("inf")), ("rmse", 2.0)], "metric string, value double")
    assert {r["metric"]: r["is_drift"] for r in drift.performance_drift(one, two).collect()} == {"mape": False, "rmse": True}


def test_metrics_count_known_pairs(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (2.0, None)], "actual double, predicted double")
    assert metrics.forecast_metrics(rows).first()["n"] == 1


def test_best_so_far_either_way(spark):
    trials = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 2.0)], "trial int, score double")
    best = lambda minimize: [r["best_so_far"] for r in metrics.running_best(trials, minimize=minimize).orderBy("trial").collect()]
    assert best(True) == [1.0, 1.0, 1.0] and best(False) == [1.0, 3.0, 3.0]


def test_ensemble_without_weights_is_the_mean(spark):
    rows = spark.createDataFrame([(1, "m", 2.0), (1, "n", 4.0), (1, "o", None)], "id int, model string, predicted double")
    r = models.weighted_ensemble(rows, ["id"]).first()
    assert (r["predicted"], r["models"]) == (3.0, 2)


def test_ranges_follow_the_rows(spark, monkeypatch):
    rows = spark.range(2000).selectExpr("cast(id AS double) AS value")
    monkeypatch.setattr(ranks, "ROWS_PER_RANGE", 100)
    assert len(ranks.cut_points(rows, "value")) > 10
    monkeypatch.setattr(ranks, "ROWS_PER_RANGE", 1000)
    assert len(ranks.cut_points(rows, "value")) <= 2


def test_depth_that_cannot_be_grown_is_an_error():
    with pytest.raises(ValueError):
        models.boosting_arguments({"max_depth": 31})
    assert models.boosting_arguments({"max_depth": -1}, unlimited_depth=9)[0]["maxDepth"] == 9
    assert "early_stopping_rounds" in models.boosting_arguments({})[1] or "early_stopping_rounds" not in config.BOOSTING_PARAMS


def test_a_thousand_categories(spark):
    rows = spark.range(2000).selectExpr(
        "cast(id % 1000 AS string) AS shop", "cast(id % 7 AS double) AS x", "cast(id % 10 AS double) AS sales_quantity",
        "CASE WHEN id < 1600 THEN 'train' ELSE 'valid' END AS split",
    )
    model = models.fit_boosting(rows, ["x", "shop"], params={"num_boost_round": 2, "max_depth": 2}, categorical=["shop"])
    assert models.predict(model, rows).count() == 2000 and isinstance(model.unused_params, dict)
