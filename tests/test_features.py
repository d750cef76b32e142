import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import days
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions import columns as cols
from seriesworks.functions import dates
from seriesworks.operators import features

A, B = ("a", "x"), ("b", "y")
Y = "sales_quantity"


def frame(df, key=A):
    return df.where(F.col("drug_id") == key[0]).orderBy("date").toPandas()


def random_series(n, seed=0, missing=0.0):
    rng = np.random.default_rng(seed)
    values = np.round(rng.gamma(2.0, 1000.0, n), 2)
    return [None if rng.random() < missing else float(v) for v in values]


@pytest.mark.parametrize("missing", [0.0, 0.1])
def test_all_families_match_pandas(make_panel, missing):
    x = random_series(150, 5, missing)
    df = make_panel({A: days("2020-01-01", x), B: days("2021-05-01", [7.0] * 20)})
    s = pd.Series(x, dtype=float)
    out = frame(features.add_rolling(df))
    for w in config.WINDOWS:
        for stat in config.STATISTICS:
            expected = getattr(s.rolling(w), stat)()
            np.testing.assert_allclose(out[f"{Y}_rolling_{w}_{stat}"].astype(float), expected, rtol=1e-9, atol=1e-6)
    out = frame(features.add_lags(df))
    for n in config.LAGS:
        np.testing.assert_allclose(out[f"{Y}_lag_{n}"].astype(float), s.shift(n))
    out = frame(features.add_diffs(df))
    for p in config.DIFF_PERIODS:
        np.testing.assert_allclose(out[f"{Y}_diff_{p}"].astype(float), s.diff(p))
    out = frame(features.add_expanding(df))
    np.testing.assert_allclose(out[f"{Y}_cumsum"].astype(float), s.cumsum())
    np.testing.assert_allclose(out[f"{Y}_cummean"].astype(float), s.expanding().mean())
    np.testing.assert_allclose(out[f"{Y}_cumstd"].astype(float), s.expanding().std(), rtol=1e-9)
    flat = frame(features.add_rolling(df), B)
    assert (flat[f"{Y}_rolling_7_std"].dropna() == 0).all() and len(flat[f"{Y}_rolling_7_std"].dropna()) == 14


def test_rolling_std_survives_large_offsets(make_panel):
    x = [1e9 + v for v in (0.0, 1.0, 2.0, 1.0, 0.0, 1.0, 2.0, 3.0, 1.0, 0.0)]
    out = frame(features.add_rolling(make_panel({A: days("2020-01-01", x)}), windows=[3], statistics=["std"]))
    np.testing.assert_allclose(out[f"{Y}_rolling_3_std"].astype(float), pd.Series(x).rolling(3).std(), rtol=1e-6)


@pytest.mark.parametrize("n", [0, 1, 89, 90, 120])
def test_full_build_loses_89_rows(make_panel, n):
    df = make_panel({A: days("2020-01-01", random_series(n, n))} if n else {})
    out = features.build_features(df)
    assert len(out.columns) == 49
    assert out.count() == max(0, n - 89)
    families = [cols.feature_family(c) for c in cols.feature_columns(out)]
    assert len(families) == 45
    assert [families.count(f) for f in ("date", "lag", "rolling", "diff", "cumulative")] == [14, 6, 20, 2, 3]


def test_full_build_relations(make_panel):
    out = frame(features.build_features(make_panel({A: days("2020-01-01", random_series(200, 9))})))
    np.testing.assert_allclose(out[f"{Y}_lag_1"] + out[f"{Y}_diff_1"], out[Y])
    assert (out[f"{Y}_rolling_7_min"] <= out[f"{Y}_rolling_7_median"]).all()
    assert (out[f"{Y}_rolling_7_median"] <= out[f"{Y}_rolling_7_max"]).all()


def test_exclude_current_sees_only_the_past(make_panel):
    x = random_series(60, 2)
    build = dict(lags=[1], windows=[7], exclude_current=True)
    a = frame(features.build_features(make_panel({A: days("2020-01-01", x)}), **build))
    b = frame(features.build_features(make_panel({A: days("2020-01-01", [*x[:-1], 1e6])}), **build))
    own = [c for c in a.columns if c.startswith(f"{Y}_")]
    pd.testing.assert_series_equal(a.iloc[-1][own], b.iloc[-1][own], check_exact=False, rtol=1e-6)
    s = pd.Series(x).shift(1)
    np.testing.assert_allclose(a[f"{Y}_rolling_7_mean"], s.rolling(7).mean().dropna().iloc[-len(a):])


def test_full_build_uses_one_shuffle(make_panel):
    plan = features.build_features(make_panel({A: days("2020-01-01", [1, 2])}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_calendar_matches_pandas(spark):
    df = dates.date_range(spark, "2019-12-25", "2021-01-05")
    out = dates.add_calendar_features(df, features=[*config.DATE_FEATURES, "dayofyear", "weekofyear"]).orderBy("date").toPandas()
    d = pd.to_datetime(out["date"]).dt
    for name in ("year", "month", "day", "dayofweek", "quarter", "dayofyear"):
        assert (out[name] == getattr(d, name)).all()
    for name in ("is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end"):
        assert (out[name] == getattr(d, name).astype(int)).all()
    assert (out["weekofyear"] == d.isocalendar().week.to_numpy()).all()
    assert (out["is_weekend"] == d.dayofweek.isin([5, 6]).astype(int)).all()
    np.testing.assert_allclose(out["month_sin"], np.sin(2 * np.pi * d.month / 12), atol=1e-12)
    np.testing.assert_allclose(out["dayofweek_cos"], np.cos(2 * np.pi * d.dayofweek / 7), atol=1e-12)
    assert dates.add_time_features(df).columns == ["date", *config.DATE_FEATURES]
    with pytest.raises(ValueError):
        dates.add_calendar_features(df, features=["moon"])


def test_holidays(spark):
    df = dates.date_range(spark, "2020-01-01", "2020-01-12")
    out = dates.add_holiday_features(df, holidays=["2020-01-05", "2020-01-12"]).orderBy("date").toPandas()
    assert out["days_to_holiday"].tolist() == [4, 3, 2, 1, 0, 1, 2, 3, 3, 2, 1, 0]
    assert out["is_holiday"].tolist() == [0] * 4 + [1] + [0] * 6 + [1]
    assert out["is_before_holiday"].tolist() == [0] + [1] * 11
    none = dates.add_holiday_features(df).first()
    assert (none.is_holiday, none.days_to_holiday, none.is_before_holiday) == (0, 999, 0)
    far = dates.add_holiday_features(df, holidays=["1990-01-01"]).first()
    assert far.days_to_holiday == 999


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dates(dt.date(2015, 1, 1), dt.date(2025, 12, 31)), min_size=1, max_size=4))
def test_holiday_distance_property(spark, holidays):
    df = dates.date_range(spark, "2020-02-20", "2020-03-10")
    out = dates.add_holiday_features(df, holidays=[h.isoformat() for h in holidays]).collect()
    for r in out:
        assert r.days_to_holiday == min(min(abs((r.date - h).days) for h in holidays), 999)


def test_compact_dates(spark):
    df = spark.createDataFrame([("2024-03-05",), ("not-a-date",), (None,)], "d string")
    assert [r[0] for r in df.select(dates.compact_date(F.col("d"))).collect()] == ["20240305", "notadate", None]


def test_interactions(make_panel):
    df = make_panel({A: days("2020-01-01", [2, 4])}).withColumn("z", F.lit(0.0))
    out = cols.add_interactions(df, [(Y, "z"), (Y, "absent")])
    row = out.orderBy("date").first()
    assert row[f"{Y}_x_z"] == 0 and row[f"{Y}_div_z"] == pytest.approx(2e5)
    assert not [c for c in out.columns if "absent" in c]
    zero = cols.add_interactions(df.withColumn("m", F.lit(-1e-5)), [(Y, "m")]).first()
    assert zero[f"{Y}_div_m"] is None


def test_selection(make_panel):
    df = make_panel({A: days("2020-01-01", [1, 2, 3, 5])}).withColumns(
        {"same": F.col(Y) * 2, "flat": F.lit(3.0), "label": F.lit("t")}
    )
    by_corr = {r.feature: r for r in features.select_features(df).collect()}
    assert set(by_corr) == {"same", "flat"}
    assert by_corr["same"].selected and by_corr["same"].score == pytest.approx(1.0)
    assert not by_corr["flat"].selected and by_corr["flat"].score is None
    by_var = {r.feature: r for r in features.select_features(df, "variance").collect()}
    assert by_var["same"].score == pytest.approx(np.var([2, 4, 6, 10], ddof=1)) and not by_var["flat"].selected
    with pytest.raises(ValueError):
        features.select_features(df, "lasso")


def test_small_columns_helpers(spark):
    df = spark.createDataFrame([(" ",), ("None",), (None,), ("ok",)], "k string")
    assert [r.k for r in df.where(cols.valid_key(F.col("k"))).collect()] == ["ok"]
    name = spark.createDataFrame([("a/b/" + "x" * 30,)], "n string").select(cols.safe_name(F.col("n"))).first()[0]
    assert name == "a_b_" + "x" * 16
