import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesworks.functions.stats import _chi_square_tail, chi_square_p
from seriesworks.operators import drift, profile, ranks


def table(spark, pdf):
    return spark.createDataFrame(pdf)


@pytest.fixture(scope="module")
def skewed():
    """One group has most rows, one value most of that group's rows."""
    rng = np.random.default_rng(11)
    hot = np.concatenate([np.zeros(3000), rng.normal(0, 1, 1500), [1e9, -1e9]])
    return pd.DataFrame(
        {
            "g": ["hot"] * len(hot) + ["b"] * 7 + ["one"],
            "x": np.concatenate([hot, rng.integers(0, 3, 7).astype(float), [4.5]]),
        }
    )


@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_quantiles_exact_for_any_ranges(spark, skewed, ranges):
    probs = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.9, 1.0]
    rows = ranks.group_values(table(spark, skewed), ["g"], "x")
    counted = ranks.with_range(rows.groupBy("g", "value").agg(F.count(F.lit(1)).alias("n")), "value", ranges)
    got = {(r.g, r.prob): r.quantile for r in ranks.exact_quantiles(counted, ["g"], probs).collect()}
    for g, part in skewed.groupby("g"):
        for p in probs:
            assert got[g, p] == pytest.approx(part["x"].quantile(p), rel=1e-9, abs=1e-9)


def test_cumulative_counts(spark, skewed):
    counted = ranks.value_counts(ranks.group_values(table(spark, skewed), ["g"], "x"), ["g"])
    got = ranks.cumulative_counts(counted, ["g"], ["n"]).toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("value")
        assert (part["cum_n"] == part["n"].cumsum()).all()
        assert (part["total_n"] == (skewed["g"] == g).sum()).all()


def test_describe_column(spark, skewed):
    got = profile.describe_column(table(spark, skewed), "x", ["g"]).toPandas().set_index("g")
    want = skewed.groupby("g")["x"].describe()
    for mine, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "median": "50%", "q75": "75%", "max": "max"}.items():
        np.testing.assert_allclose(
            got[mine].astype(float).sort_index(), want[theirs].sort_index(), rtol=1e-9, atol=1e-9
        )
    whole = profile.describe_column(table(spark, skewed), "x").first()
    assert whole.median == pytest.approx(skewed["x"].median())


def test_baseline_stats_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 2), (float("nan"), 3), (3.0, 4)], "a double, b int")
    got = {r.feature: r for r in drift.baseline_stats(df, ["a", "b", "absent"]).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].mean, got["a"].min, got["a"].max, got["a"].median) == (2.0, 1.0, 3.0, 2.0)
    assert got["a"].std == pytest.approx(math.sqrt(2))


def brute_ks(a, b):
    points = np.concatenate([a, b])
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    return np.abs(fa - fb).max()


@pytest.mark.parametrize("seed", range(3))
def test_ks_matches_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    base = pd.DataFrame({"u": np.round(rng.normal(0, 1, 700), 1), "v": rng.integers(0, 4, 700).astype(float), "w": rng.random(700)})
    cur = pd.DataFrame({"u": np.round(rng.normal(0.3, 1, 400), 1), "v": rng.integers(0, 4, 400).astype(float), "w": rng.random(400) + 5})
    got = {r.feature: r for r in drift.ks_test(table(spark, base), table(spark, cur)).collect()}
    for c in base:
        assert got[c].statistic == pytest.approx(brute_ks(base[c].to_numpy(), cur[c].to_numpy()))
        assert (got[c].n_baseline, got[c].n_current) == (700, 400)
    assert got["w"].statistic == 1.0 and got["w"].is_drift and got["w"].p_value < 1e-12
    assert got["u"].is_drift


def test_ks_p_value_known_point(spark):
    # the Kolmogorov distribution has its 5 % point at 1.3581
    n = 100000
    row = spark.range(1).select(
        F.lit(1.3581 / math.sqrt(n / 2)).alias("d"), F.lit(n).alias("a"), F.lit(n).alias("b")
    )
    from seriesworks.functions.stats import kolmogorov_p

    assert row.select(kolmogorov_p(F.col("d"), F.col("a"), F.col("b"))).first()[0] == pytest.approx(0.05, abs=1e-4)


def test_ks_same_sample_is_zero(spark):
    df = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    row = drift.ks_test(df, df).first()
    assert row.statistic == 0 and row.p_value == 1.0 and not row.is_drift


@pytest.mark.parametrize(
    "x, dof, p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (16.918978, 9, 0.05), (21.665994, 9, 0.01), (0.0, 4, 1.0), (18.307038, 10, 0.05)]
)
def test_chi_square_tail(x, dof, p):
    assert _chi_square_tail(x, dof) == pytest.approx(p, rel=1e-5)


def test_chi_square_p_null(spark):
    df = spark.createDataFrame([(None, 3.0), (3.841459, 1.0)], "x double, d double")
    got = [r[0] for r in df.select(chi_square_p(F.col("x"), F.col("d"))).collect()]
    assert got[0] is None and got[1] == pytest.approx(0.05, rel=1e-5)


def hand_chi2(base, cur, bins=10):
    edges = np.unique(np.quantile(np.concatenate([base, cur]), np.linspace(0, 1, bins + 1)))
    k = len(edges) - 1
    place = lambda v: np.clip(np.searchsorted(edges, v, side="left"), 1, k)
    table = np.array([np.bincount(place(s), minlength=k + 1)[1:] for s in (base, cur)], dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    gap = np.abs(table - expected)
    if k == 2:
        gap = gap - np.minimum(0.5, gap)
    return (gap**2 / expected).sum(), k - 1


def test_chi2_matches_hand_table(spark):
    rng = np.random.default_rng(4)
    base = pd.DataFrame({"a": rng.normal(size=900), "two": rng.integers(0, 2, 900).astype(float), "few": rng.integers(0, 5, 900).astype(float), "const": 1.0})
    cur = pd.DataFrame({"a": rng.normal(0.5, 1, 500), "two": (rng.random(500) < 0.4).astype(float), "few": rng.integers(0, 5, 500).astype(float), "const": 1.0})
    got = {r.feature: r for r in drift.chi2_test(table(spark, base), table(spark, cur)).collect()}
    for c in ("a", "few"):
        statistic, dof = hand_chi2(base[c].to_numpy(), cur[c].to_numpy())
        assert got[c].statistic == pytest.approx(statistic) and got[c].dof == dof
    assert got["a"].is_drift
    assert got["const"].statistic is None and "constant" in got["const"].error
    results = drift.detect_drift(table(spark, base), table(spark, cur), method="chi2")
    assert {r.feature for r in results.where("error is not null").collect()} == {"const"}


def test_chi2_yates_for_two_bins(spark):
    # values 0..2 with pooled edges 0, 1, 2: two bins
    base = np.array([0.0] * 5 + [1.0] * 35 + [2.0] * 20)
    cur = np.array([0.0] * 5 + [1.0] * 25 + [2.0] * 30)
    frames = [table(spark, pd.DataFrame({"x": v})) for v in (base, cur)]
    row = drift.chi2_test(*frames, bins=2).first()
    statistic, dof = hand_chi2(base, cur, 2)
    assert dof == row.dof == 1 and row.statistic == pytest.approx(statistic)


def test_detect_drift_reports_every_column(spark):
    a = spark.createDataFrame([(1.0, "t", None), (2.0, "u", None)], "x double, s string, e double")
    got = {r.feature: r for r in drift.detect_drift(a, a, ["x", "s", "e", "absent"]).collect()}
    assert set(got) == {"x", "s", "e"}
    assert got["x"].is_drift is False and got["x"].error is None
    assert got["s"].is_drift is None and got["s"].error == "not a numeric column"
    assert got["e"].error == "no values in one of the samples"
    with pytest.raises(ValueError):
        drift.detect_drift(a, a, method="psi")


def test_aligned_bins_cover_every_bin(spark):
    base = table(spark, pd.DataFrame({"x": np.arange(50.0)}))
    cur = table(spark, pd.DataFrame({"x": np.arange(50.0) + 100}))
    got = drift.aligned_bins(base, cur).orderBy("bin").toPandas()
    assert got["bin"].tolist() == list(range(1, 11))
    assert got["n_baseline"].sum() == got["n_current"].sum() == 50
    assert (got["n_baseline"].iloc[5:] == 0).all()


def test_performance_drift(spark):
    schema = "metric string, value double"
    base = spark.createDataFrame([("rmse", 10.0), ("mae", 0.0), ("gone", 1.0)], schema)
    cur = spark.createDataFrame([("rmse", 11.5), ("mae", 0.05), ("new", 1.0)], schema)
    got = {r.metric: r for r in drift.performance_drift(base, cur).collect()}
    assert set(got) == {"rmse", "mae"}
    assert got["rmse"].is_drift and got["rmse"].relative_change == pytest.approx(0.15)
    assert not got["mae"].is_drift and got["mae"].relative_change == pytest.approx(0.05)


def test_drift_report(spark):
    results = spark.createDataFrame(
        [("a", True, 0.5, 0.01, "ks", None), ("b", False, 0.1, 0.6, "ks", None), ("c", None, None, None, "ks", "bad")],
        "feature string, is_drift boolean, statistic double, p_value double, method string, error string",
    )
    summary = drift.drift_summary(results).first()
    assert (summary.features, summary.drifted) == (3, 1) and summary.drift_ratio == pytest.approx(1 / 3)
    report = drift.drift_report(results).collect()
    assert sorted(r.section for r in report) == ["drifted", "summary"]
