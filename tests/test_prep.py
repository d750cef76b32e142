import numpy as np
import pandas as pd
import pytest
from conftest import days
from pyspark.sql import functions as F

from seriesworks.operators import prep

A, B, C = ("a", "x"), ("b", "y"), ("c", "z")
VALUES = [None, 2, None, None, 8, 4, None, 1, None]


def values(df, key=A, column="sales_quantity"):
    rows = df.where(F.col("drug_id") == key[0]).orderBy("date").collect()
    return [r[column] for r in rows]


@pytest.mark.parametrize("method", ["forward_fill", "backward_fill", "interpolate", "mean", "median"])
def test_fill_matches_pandas(make_panel, method):
    df = make_panel({A: days("2020-01-01", VALUES), B: days("2020-01-01", [None, None]), C: days("2020-01-01", [5])})
    out = prep.fill_missing(df, method)
    s = pd.Series(VALUES, dtype=float)
    expected = {
        "forward_fill": s.ffill,
        "backward_fill": s.bfill,
        "interpolate": s.interpolate,
        "mean": lambda: s.fillna(s.mean()),
        "median": lambda: s.fillna(s.median()),
    }[method]().fillna(0)
    np.testing.assert_allclose(values(out), expected)
    assert values(out, B) == [0, 0] and values(out, C) == [5]


def test_fill_drop_and_text_columns(make_panel):
    df = make_panel({A: days("2020-01-01", [1, None, 3])}).withColumn(
        "note", F.when(F.col("sales_quantity") == 3, "n")
    )
    assert prep.fill_missing(df, "drop", ["sales_quantity"]).count() == 2
    assert values(prep.fill_missing(df, "backward_fill"), column="note") == ["n", "n", "n"]
    assert values(prep.fill_missing(df, "forward_fill"), column="note") == [None, None, "n"]
    with pytest.raises(ValueError):
        prep.fill_missing(df, "guess")


def test_missing_counts(make_panel):
    df = make_panel({A: days("2020-01-01", VALUES)})
    assert {r.column_name: r.missing for r in prep.missing_counts(df).collect()}["sales_quantity"] == 5


def test_outliers_match_pandas(make_panel):
    rng = np.random.default_rng(1)
    x = [float(v) for v in rng.normal(50, 5, 200)] + [500.0, -300.0]
    df = make_panel({A: days("2020-01-01", x), B: days("2020-01-01", [4.0] * 10)})
    s = pd.Series(x)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    np.testing.assert_allclose(
        values(prep.treat_outliers(df, method="iqr")), s.clip(q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1))
    )
    z = ((s - s.mean()) / s.std()).abs()
    np.testing.assert_allclose(values(prep.treat_outliers(df, method="zscore")), s.where(z <= 3, s.mean()))
    np.testing.assert_allclose(
        values(prep.treat_outliers(df, method="clip")), s.clip(s.quantile(0.01), s.quantile(0.99))
    )
    for method in ("iqr", "zscore", "clip"):
        assert values(prep.treat_outliers(df, method=method), B) == [4.0] * 10
    counts = {r.drug_id: r for r in prep.outlier_counts(df).collect()}
    assert counts["a"].iqr_outliers == 2 and counts["a"].zscore_outliers == int((z > 3).sum())
    assert counts["b"].iqr_outliers == counts["b"].zscore_outliers == counts["b"].clip_outliers == 0
    with pytest.raises(ValueError):
        prep.treat_outliers(df, method="other")


def test_outliers_leave_null(make_panel):
    df = make_panel({A: days("2020-01-01", [1, None, 3])})
    for method in ("iqr", "zscore", "clip"):
        assert values(prep.treat_outliers(df, method=method))[1] is None


def test_scaling(make_panel):
    x = [1.0, 4.0, 10.0, 2.0]
    df = make_panel({A: days("2020-01-01", x), B: days("2020-01-01", [3.0, 3.0])})
    a = np.array(x)
    expected = {"minmax": (a - 1) / 9, "zscore": (a - a.mean()) / a.std()}
    for method, want in expected.items():
        direct = prep.scale(df, ["sales_quantity"], method)
        kept = prep.apply_scaler(df, prep.fit_scaler(df, ["sales_quantity"], method), ["sales_quantity"])
        for out in (direct, kept):
            np.testing.assert_allclose(values(out), want, atol=1e-12)
            assert values(out, B) == [0, 0]
    with pytest.raises(ValueError):
        prep.scale(df, ["sales_quantity"], "robust")
