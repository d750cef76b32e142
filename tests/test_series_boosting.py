import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesworks.operators import models, series_boosting
from seriesworks.operators.boosting import bin_rows
from seriesworks.session import cut_lineage
from test_boosting import PLAIN, brute_tree

KEYS = ["drug_id", "hospital_id"]
NAMES = ["a", "b"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    parts = []
    for k, (n, scale) in enumerate([(300, 4.0), (120, -3.0), (90, 0.0)]):
        pdf = pd.DataFrame({"drug_id": f"d{k}", "hospital_id": "h", "a": rng.normal(size=n).round(1), "b": rng.integers(0, 9, n).astype(float)})
        pdf["sales_quantity"] = scale * (pdf["a"] > 0.3) + scale / 2 * (pdf["b"] > 5) * (pdf["a"] < -0.2) + rng.normal(0, 0.3, n) * (scale != 0)
        pdf.loc[::7, "a"] = np.nan
        pdf["split"] = ["train"] * (n * 2 // 3) + ["valid"] * (n // 6) + ["test"] * (n - n * 2 // 3 - n // 6)
        parts.append(pdf)
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def table(spark, frame):
    odd = frame.head(4).assign(drug_id=[None, "only valid", "d0", "d1"], sales_quantity=[1.0, 2.0, None, np.nan], split=["train", "valid", "train", "train"])
    rows = pd.concat([frame, odd], ignore_index=True)
    return cut_lineage(spark.createDataFrame(rows.astype(object).where(rows.notna(), None), "drug_id string, hospital_id string, a double, b double, sales_quantity double, split string").repartition(5))


@pytest.mark.parametrize("more", [{}, {"lambda_l1": 2.0, "lambda_l2": 4.0}, {"num_leaves": 4, "min_data_in_leaf": 15}, {"max_depth": 1}])
def test_every_series_equals_brute_force(spark, frame, table, more):
    params = PLAIN | {"num_leaves": 31, "learning_rate": 0.4, "num_boost_round": 2, "max_depth": 3} | more
    model = series_boosting.fit_series_trees(table.where("split <> 'valid'"), NAMES, params=params)
    got = models.predict(model, table.where("split = 'train' AND sales_quantity IS NOT NULL")).toPandas()
    for key in ("d0", "d1"):
        train = frame[(frame["drug_id"] == key) & (frame["split"] == "train")].reset_index(drop=True)
        x = train[NAMES].to_numpy()
        x = bin_rows(x, [series_boosting.series_edges(x[:, i], series_boosting.MAX_BINS) for i in range(2)]).astype(int)
        y = train["sales_quantity"].to_numpy()
        want = np.full(len(y), y.mean())
        for tree in range(2):
            values, gains = brute_tree(x, y - want, params["num_leaves"], params["min_data_in_leaf"], params.get("lambda_l1", 0), params.get("lambda_l2", 0), params["max_depth"])
            mine = model.nodes.where((F.col("drug_id") == key) & (F.col("tree") == tree) & F.col("gain").isNotNull()).toPandas()
            np.testing.assert_allclose(sorted(mine["gain"]), sorted(gains), rtol=1e-6)
            want += 0.4 * values
        own = got[got["drug_id"] == key].sort_values(["sales_quantity", "b"])["predicted"].to_numpy()
        np.testing.assert_allclose(own, want[train.sort_values(["sales_quantity", "b"]).index], atol=1e-9)
    # nothing to gain in a constant series: its mean is the model
    assert model.nodes.where("drug_id = 'd2'").count() == 0 and set(got[got["drug_id"] == "d2"]["predicted"]) == {0.0}


def test_each_series_stops_by_itself(spark, frame, table):
    params = {"learning_rate": 0.5, "early_stopping_rounds": 2, "min_data_in_leaf": 3, "num_boost_round": 15, "max_depth": 2}
    model = series_boosting.fit_series_trees(table, NAMES, params=params)
    series = {r.drug_id: r for r in model.series.collect()}
    assert set(series) == {"d0", "d1", "d2"} and series["d2"].rounds == 0 and series["d0"].rounds > 1
    trees = {r.drug_id: r.n for r in model.nodes.groupBy("drug_id").agg(F.countDistinct("tree").alias("n")).collect()}
    assert trees == {k: r.rounds for k, r in series.items() if r.rounds}
    scored = models.predict(model, table.where("split = 'valid'")).toPandas()
    for key in ("d0", "d1"):
        own = scored[scored["drug_id"] == key]
        assert np.sqrt(((own["sales_quantity"] - own["predicted"]) ** 2).mean()) == pytest.approx(series[key].valid_error)
    assert scored[scored["drug_id"] == "only valid"]["predicted"].isna().all()
    again = series_boosting.fit_series_trees(table.repartition(2), NAMES, params=params)
    assert {r.drug_id: r.rounds for r in again.series.collect()} == {k: r.rounds for k, r in series.items()}


def test_no_rows(spark, table):
    model = series_boosting.fit_series_trees(table.limit(0), NAMES)
    assert model.nodes.count() == model.series.count() == 0
    scored = models.predict(model, table)
    assert scored.count() == table.count() and scored.where("predicted IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        series_boosting.fit_series_trees(table, NAMES, max_bins=200)


def test_batch_job_reports_every_series(spark):
    import datetime as dt

    from seriesworks.plans import jobs

    first, rng = dt.date(2020, 1, 1), np.random.default_rng(5)
    rows = [("p1", "c", first + dt.timedelta(days=i), float(10 + 5 * (i % 7 > 4) + rng.normal())) for i in range(420)]
    rows += [("p2", "c", first + dt.timedelta(days=i), 1.0) for i in range(110)] + [("p3", "c", first, 1.0), (None, "c", first, 1.0)]
    sales = spark.createDataFrame(rows, "gcode string, cust_name string, create_dt date, qty double")
    results, model = jobs.batch_train_boosted(sales, {"learning_rate": 0.3, "early_stopping_rounds": 2, "max_depth": 2, "num_boost_round": 6})
    got = {r.drug_id: r for r in results.collect()}
    assert set(got) == {"p1", "p2", "p3"} and got["p3"].status == "failed" and "100" in got["p3"].message
    assert got["p1"].status == "success" and got["p1"].rmse < 2.5 and got["p2"].message.startswith("not enough rows after features (")
    assert [r.drug_id for r in model.series.collect()] == ["p1"]
