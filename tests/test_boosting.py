import numpy as np
import pandas as pd
import pytest
from conftest import days
from pyspark.sql import functions as F

from seriesworks.operators import boosting, encoding, features, forecast, metrics, models, training
from seriesworks.operators.boosting import bin_rows
from seriesworks.plans import jobs
from seriesworks.session import cut_lineage

PLAIN = {"feature_fraction": 1.0, "bagging_freq": 0, "early_stopping_rounds": 0, "min_data_in_leaf": 5}


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(0)
    n = 600
    pdf = pd.DataFrame({"a": rng.normal(size=n).round(2), "b": rng.integers(0, 9, n).astype(float), "noise": rng.normal(size=n).round(2)})
    pdf["sales_quantity"] = 4 * (pdf["a"] > 0.3) + 2 * (pdf["b"] > 5) * (pdf["a"] < -0.2) + rng.normal(0, 0.3, n)
    pdf.loc[::7, "a"] = np.nan
    pdf["split"] = ["train"] * 400 + ["valid"] * 100 + ["test"] * 100
    return pdf


@pytest.fixture(scope="module")
def table(spark, frame):
    return cut_lineage(spark.createDataFrame(frame).repartition(5))


def brute_tree(x, y, leaves, least, l1=0.0, l2=0.0, depth=0):
    """Best-first tree by trying every split of every leaf; returns the leaf values by row and the gains."""

    def shrunk(g):
        return np.sign(g) * max(abs(g) - l1, 0)

    def score(g, n):
        return shrunk(g) ** 2 / (n + l2) if n + l2 > 0 else 0.0

    def best(rows, level):
        found = None
        if depth and level >= depth:
            return None
        for f in range(x.shape[1]):
            for b in np.unique(x[rows, f])[:-1]:
                left, right = rows[x[rows, f] <= b], rows[x[rows, f] > b]
                if min(len(left), len(right)) < least:
                    continue
                gain = score(y[left].sum(), len(left)) + score(y[right].sum(), len(right)) - score(y[rows].sum(), len(rows))
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-12):
                    found = (gain, left, right)
        return found

    open_leaves, gains = [(np.arange(len(y)), 0)], []
    splits_ = [best(*open_leaves[0])]
    while len(open_leaves) < leaves and any(splits_):
        i = max((i for i, s in enumerate(splits_) if s), key=lambda i: splits_[i][0])
        gain, left, right = splits_.pop(i)
        level = open_leaves.pop(i)[1] + 1
        gains.append(gain)
        for part in (left, right):
            open_leaves.append((part, level))
            splits_.append(best(part, level))
    out = np.empty(len(y))
    for rows, _ in open_leaves:
        out[rows] = shrunk(y[rows].sum()) / (len(rows) + l2)
    return out, gains


@pytest.mark.parametrize("more", [{}, {"lambda_l1": 3.0, "lambda_l2": 4.0}, {"max_depth": 2}, {"num_leaves": 4, "min_data_in_leaf": 40}])
def test_rounds_equal_brute_force(spark, frame, table, more):
    names, params = ["a", "b", "noise"], PLAIN | {"num_leaves": 9, "learning_rate": 0.4, "num_boost_round": 3} | more
    model = boosting.fit_trees(table, names, params=params, max_bins=32)
    train = frame[frame["split"] == "train"]
    x, y = bin_rows(train[names].to_numpy(), model.edges).astype(int), train["sales_quantity"].to_numpy()
    want = np.full(len(y), y.mean())
    for tree in model.grown:
        values, gains = brute_tree(
            x, y - want, params["num_leaves"], params["min_data_in_leaf"], params.get("lambda_l1", 0), params.get("lambda_l2", 0), params.get("max_depth", 0)
        )
        np.testing.assert_allclose(sorted(tree.gain[tree.feature >= 0]), sorted(gains), rtol=1e-6)
        assert (tree.feature < 0).sum() == len(gains) + 1
        want += 0.4 * values
    scored = models.predict(model, table.where("split = 'train'")).toPandas()
    key = ["b", "noise", "sales_quantity"]
    got = scored.sort_values(key)["predicted"].to_numpy()
    order = train.reset_index(drop=True).sort_values(key).index
    np.testing.assert_allclose(got, want[order], atol=1e-9)


def test_patience_keeps_the_best_round(table):
    model = boosting.fit_trees(table, ["a", "b", "noise"], params={"learning_rate": 0.5, "early_stopping_rounds": 3, "min_data_in_leaf": 2})
    best = int(np.argmin(model.history))
    assert len(model.trees) == best and len(model.history) == best + 4 and model.rounds == best + 3
    valid = metrics.forecast_metrics(models.predict(model, table.where("split = 'valid'"))).first()
    assert valid.rmse == pytest.approx(min(model.history))
    by_mae = boosting.fit_trees(table, ["a", "b"], params={"metric": "mae", "num_boost_round": 4, "learning_rate": 0.5})
    assert len(by_mae.history) == 5 and by_mae.history[0] > by_mae.history[-1]


def test_sampling_is_the_same_in_any_partitioning(spark, frame, table):
    params = {"num_boost_round": 10, "early_stopping_rounds": 0, "feature_fraction": 0.5, "bagging_freq": 2, "bagging_fraction": 0.5}
    first = boosting.fit_trees(table, ["a", "b", "noise"], params=params)
    again = boosting.fit_trees(table.repartition(3), ["a", "b", "noise"], params=params)
    assert [t.feature.tolist() for t in first.grown] == [t.feature.tolist() for t in again.grown]
    np.testing.assert_allclose(first.history, again.history)
    assert {int(t.rows[0]) for t in first.grown} != {400} and all(150 < t.rows[0] < 250 for t in first.grown)


def test_save_load_importance_and_categories(spark, frame, table, tmp_path):
    rng = np.random.default_rng(1)
    pdf = frame.assign(shop=[f"s{i}" for i in rng.integers(0, 40, len(frame))], date=pd.date_range("2020-01-01", periods=len(frame)).date)
    pdf["sales_quantity"] += pdf["shop"].str[1:].astype(int) / 4
    df = cut_lineage(spark.createDataFrame(pdf))
    model = boosting.fit_trees(df, ["a", "b"], params={"num_boost_round": 20, "learning_rate": 0.3}, categorical=["shop"])
    gain, split = models.feature_importance(model, spark), models.feature_importance(model, spark, "split")
    assert gain.first().feature == "shop_encoded" and {r.feature for r in gain.collect()} == {"a", "b", "shop_encoded"}
    assert split.agg(F.sum("importance")).first()[0] == sum((t.feature >= 0).sum() for t in model.trees)
    boosting.save_trees(model, str(tmp_path / "m"), spark)
    loaded = boosting.load_trees(str(tmp_path / "m"), spark)
    new = spark.createDataFrame([("nowhere", 0.1, 2.0, 1.0), (None, None, None, 1.0)], "shop string, a double, b double, sales_quantity double")
    for rows in (df, new):
        a, b = (sorted(r.predicted for r in models.predict(m, rows).collect()) for m in (model, loaded))
        np.testing.assert_allclose(a, b)


def test_odd_tables(spark, table):
    with pytest.raises(ValueError):
        boosting.fit_trees(table, ["a"], params={"objective": "poisson"})
    constant = table.withColumn("sales_quantity", F.lit(2.0))
    assert boosting.fit_trees(constant, ["a"]).grown == []
    empty = boosting.fit_trees(table.where("false"), ["a", "b"])
    assert empty.grown == [] and empty.base == 0.0
    assert empty.importance(spark).agg(F.sum("importance")).first()[0] == 0
    gaps = table.withColumn("a", F.lit(None).cast("double")).withColumn("sales_quantity", F.when(F.col("b") > 1, F.col("sales_quantity")))
    assert boosting.fit_trees(gaps, ["a", "b"], params={"num_boost_round": 2}).rounds == 2


def test_ordered_encoding_sees_earlier_days_only(spark):
    rows = [("x", 1, 10.0, "train"), ("x", 2, 20.0, "train"), ("x", 2, 40.0, "train"), (None, 2, 8.0, "train"), ("x", 3, 99.0, "valid"), ("new", 3, 1.0, "test"), (None, 3, 5.0, "valid")]
    df = spark.createDataFrame(rows, "c string, date int, sales_quantity double, split string")
    got = {(r.c, r.date, r.sales_quantity): r.c_encoded for r in encoding.encode_ordered(df, ["c"], smoothing=2.0).collect()}
    prior = 78 / 4
    assert got["x", 1, 10.0] == pytest.approx(prior) and got["new", 3, 1.0] == pytest.approx(prior)
    assert got["x", 2, 20.0] == got["x", 2, 40.0] == pytest.approx((10 + 2 * prior) / 3)
    assert got["x", 3, 99.0] == pytest.approx((70 + 2 * prior) / 5)
    assert got[None, 2, 8.0] == pytest.approx(prior) and got[None, 3, 5.0] == pytest.approx((8 + 2 * prior) / 3)


def test_a_hundred_thousand_categories(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 100_000).cast("string").alias("c"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 100_000).cast("int")).alias("date"),
        (F.col("id") % 100_000 / 1000).alias("sales_quantity"), F.when(F.col("id") < 190_000, "train").otherwise("valid").alias("split"),
    )
    model = boosting.fit_trees(df, ["c"], params={"num_boost_round": 2, "learning_rate": 1.0}, categorical=["c"])
    assert model.features == ["c_encoded"] and model.history[-1] < 0.8 * model.history[0]


def test_model_forecast_equals_a_rebuild_day_by_day(spark, make_panel):
    rng = np.random.default_rng(2)
    series = {(k, "x"): days("2020-01-01", rng.normal(20, 5, 130).round(1)) for k in "ab"}
    history = make_panel(series | {("short", "x"): days("2020-01-01", [1.0] * 50)})
    matrix = features.build_features(history, exclude_current=True)
    names = jobs.model_features(matrix)
    assert names == features.feature_names()
    trained = cut_lineage(training.train_series(matrix, names, min_rows=10))
    got = {(r.drug_id, r.step): (r.date, r.predicted) for r in training.forecast_series(history, trained, names, 4).collect()}
    assert len(got) == 12 and got["short", 1][1] is None
    grown = series
    for step in range(1, 5):
        ahead = {k: [*v, (str(pd.Timestamp(v[-1][0]) + pd.Timedelta(days=1))[:10], 0.0)] for k, v in grown.items()}
        rows = training.predict_series(features.build_features(make_panel(ahead), exclude_current=True), trained, names)
        found = {r.drug_id: (r.date, r.predicted) for r in rows.collect()}
        for k in list(ahead):
            last = ahead[k][-1][0]
            value = next(r.predicted for r in rows.where((F.col("drug_id") == k[0]) & (F.col("date") == last)).collect())
            assert got[k[0], step][0].isoformat() == last and got[k[0], step][1] == pytest.approx(value, rel=1e-6)
            ahead[k][-1] = (last, value)
        assert set(found) == {"a", "b"}
        grown = ahead


def test_intervals_hold_their_share(spark, make_panel):
    rng = np.random.default_rng(3)
    series = {(f"s{i}", "x"): days("2020-01-01", 50 + 0.1 * np.arange(300) + rng.normal(0, 4, 300)) for i in range(12)}
    cut = {k: v[:270] for k, v in series.items()}
    found = forecast.forecast_with_interval(make_panel(cut), 30, width=0.8, seasonalities=(), changepoints=3)
    scored = found.join(make_panel(series), ["drug_id", "hospital_id", "date"])
    share = scored.agg(F.avg(F.col("sales_quantity").between(F.col("lower"), F.col("upper")).cast("double"))).first()[0]
    assert 0.7 < share < 0.95 and scored.where("lower >= predicted OR upper <= predicted").count() == 0
    wide = found.groupBy("drug_id").agg(F.max_by(F.col("upper") - F.col("lower"), "date").alias("w"), F.min_by(F.col("upper") - F.col("lower"), "date").alias("v"))
    assert wide.where("w < v").count() == 0


def test_halving_keeps_the_best_and_resumes(spark, table, tmp_path):
    path, calls = str(tmp_path / "rungs"), []
    trials = [{"learning_rate": r, "num_leaves": n} for r in (0.01, 0.2, 0.5) for n in (2, 8)]

    def fit(df, names, target, params, split):
        calls.append((params["learning_rate"], params["num_boost_round"]))
        if len(calls) == 5 and not fit.resumed:
            raise RuntimeError("driver lost")
        return boosting.fit_trees(df, names, target, PLAIN | params, split=split)

    fit.resumed = False
    with pytest.raises(RuntimeError):
        models.search_halving(table, ["a", "b"], trials, path, rungs=(1, 4), keep=0.4, fit=fit, at_once=1)
    fit.resumed = True
    tried = models.search_halving(table, ["a", "b"], trials, path, rungs=(1, 4), keep=0.4, fit=fit, at_once=2)
    rows = tried.orderBy("rung", "trial").collect()
    assert [(r.rung, r.rounds) for r in rows] == [(0, 1)] * 6 + [(1, 4)] * 3
    best = sorted(rows[:6], key=lambda r: (r.score, r.trial))[:3]
    assert {r.trial for r in rows[6:]} == {r.trial for r in best}
    done = len(calls)
    again = models.search_halving(table, ["a", "b"], trials, path, rungs=(1, 4), keep=0.4, fit=fit)
    assert len(calls) == done <= 11 and models.halving_winner(again) == models.halving_winner(tried)
    with pytest.raises(ValueError):
        models.search_halving(table, ["a", "b"], trials[::-1], path, rungs=(1, 4), fit=fit)
