import numpy as np
import pandas as pd
import pytest
from conftest import days
from pyspark.sql import functions as F

from seriesworks.operators import panel

A, B = ("a", "x"), ("b", "y")


def series(df, key=A):
    pdf = df.where((F.col("drug_id") == key[0]) & (F.col("hospital_id") == key[1])).orderBy("date").toPandas()
    return pd.Series(pdf["sales_quantity"].to_numpy(dtype=float), index=pd.to_datetime(pdf["date"]))


def test_daily_totals_sums_duplicates_and_bounds_dates(make_panel):
    df = make_panel({A: [("1810-01-01", 9), ("2020-01-01", 1), ("2020-01-01", 2), ("2020-01-03", 4)]})
    out = panel.daily_totals(df, start="2000-01-01")
    assert series(out).to_dict() == {pd.Timestamp("2020-01-01"): 3.0, pd.Timestamp("2020-01-03"): 4.0}


def test_densify_repeats_last_value(make_panel):
    df = make_panel({A: [("2020-01-01", 1), ("2020-01-04", 5)], B: [("2020-02-01", 7)]})
    out = panel.densify(df)
    assert series(out).tolist() == [1, 1, 1, 5]
    assert series(out, B).tolist() == [7]


@pytest.mark.parametrize("fill, expected", [("zero", [1, 0, 0, 5]), (None, [1, None, None, 5])])
def test_densify_other_fills(make_panel, fill, expected):
    out = panel.densify(make_panel({A: [("2020-01-01", 1), ("2020-01-04", 5)]}), fill=fill)
    assert [None if np.isnan(v) else v for v in series(out)] == expected


def test_densify_known_nulls(make_panel):
    df = make_panel(
        {A: [("2020-01-01", None), ("2020-01-03", 4), ("2020-01-05", None)], B: [("2020-01-01", None), ("2020-01-02", None)]}
    )
    out = panel.densify(df)
    assert series(out).tolist() == [4, 4, 4, 4, 4]
    assert series(out, B).tolist() == [0, 0]


def test_densify_keeps_other_columns_on_seen_days_only(make_panel):
    df = make_panel({A: [("2020-01-01", 1), ("2020-01-03", 5)]}).withColumn("note", F.lit("n"))
    assert [r.note for r in panel.densify(df).orderBy("date").collect()] == ["n", None, "n"]


def test_densify_single_shuffle(make_panel):
    df = panel.densify(make_panel({A: days("2020-01-01", [1, 2])}))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_empty_panel_keeps_schema(make_panel):
    empty = make_panel({})
    assert panel.densify(empty).columns == ["drug_id", "hospital_id", "date", "sales_quantity"]
    assert panel.densify(empty).count() == 0


@pytest.mark.parametrize("freq, rule", [("D", "D"), ("W", "W"), ("M", "ME"), ("Q", "QE")])
@pytest.mark.parametrize("how", ["sum", "mean", "median", "max", "min"])
def test_resample_matches_pandas(make_panel, freq, rule, how):
    rng = np.random.default_rng(3)
    stamps = sorted(rng.choice(pd.date_range("2019-11-20", "2021-02-10"), 40, replace=False))
    stamps = [s for s in stamps if not (pd.Timestamp("2020-03-01") <= s <= pd.Timestamp("2020-08-15"))]
    points = [(pd.Timestamp(s).date().isoformat(), float(rng.integers(0, 50))) for s in stamps]
    out = series(panel.resample(make_panel({A: points, B: [("2020-05-31", 3.0)]}), freq=freq, how=how))
    base = pd.Series([v for _, v in points], index=pd.to_datetime([d for d, _ in points]))
    expected = getattr(base.resample(rule), how)()
    assert list(out.index) == list(expected.index)
    np.testing.assert_allclose(out.to_numpy(), expected.to_numpy())


def test_resample_rejects_unknown(make_panel):
    with pytest.raises(ValueError):
        panel.resample(make_panel({}), how="mode")
    with pytest.raises(ValueError):
        panel.resample(make_panel({}), freq="Y")


def test_sequences(make_panel):
    df = make_panel({A: days("2020-01-01", range(7)), B: days("2020-01-01", range(3))})
    rows = panel.make_sequences(df, n_in=3, n_out=2).orderBy("date").collect()
    assert [r.x for r in rows] == [[0, 1, 2], [1, 2, 3], [2, 3, 4]]
    assert [r.y for r in rows] == [[3, 4], [4, 5], [5, 6]]


def test_sequences_keep_null_positions(make_panel):
    rows = panel.make_sequences(make_panel({A: days("2020-01-01", [1, None, 3])}), n_in=2, n_out=1).collect()
    assert rows[0].x == [1, None] and rows[0].y == [3]
