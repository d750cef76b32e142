import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesworks.operators import drift, sketches


def test_merged_sketches_keep_their_error(spark):
    rng = np.random.default_rng(0)
    rows = [(int(d), float(x), None if i % 5 else float(x * 2)) for i, (d, x) in enumerate(zip(rng.integers(0, 10, 30_000), rng.gamma(2, 3, 30_000)))]
    df = spark.createDataFrame(rows, "day int, x double, y double")
    merged = sketches.merge_sketches(sketches.sketch_features(df, ["x", "y"], by=["day"]))
    assert {r.feature: r.n for r in merged.collect()} == {"x": 30_000, "y": 6_000}
    x = np.sort([r[1] for r in rows])
    for r in sketches.sketch_quantiles(merged.where("feature = 'x'"), [0.05, 0.25, 0.5, 0.75, 0.95]).collect():
        assert abs(np.searchsorted(x, r.value) / len(x) - r.share) <= sketches.rank_error() + 1e-4


@pytest.mark.parametrize("shift", [0.0, 0.3])
def test_drift_from_sketches_is_near_the_exact_test(spark, shift):
    rng = np.random.default_rng(1)
    old = spark.createDataFrame([(float(v),) for v in rng.normal(size=8000)] + [(None,), (float("nan"),)], "v double")
    new = spark.createDataFrame([(float(v + shift),) for v in rng.normal(size=5000)], "v double")
    kept, today = (sketches.sketch_features(d, ["v"]) for d in (old, new))
    got, exact = sketches.sketch_drift(kept, today).first(), drift.ks_test(old, new, ["v"]).first()
    assert (got.n_baseline, got.n_current) == (8000, 5000)
    assert abs(got.statistic - exact.statistic) <= got.max_error
    assert got.is_drift == exact.is_drift == bool(shift)


def test_no_values_no_row(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "day int, v double")
    assert [(r.day, r.n) for r in sketches.sketch_features(df, ["v"], by=["day"]).collect()] == [(2, 1)]
    assert sketches.sketch_features(df.where("false"), ["v"], by=["day"]).count() == 0
    assert sketches.sketch_drift(sketches.sketch_features(df, ["v"]), sketches.sketch_features(df, ["v"])).where(F.col("statistic") > 0).count() == 0
