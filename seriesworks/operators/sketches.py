"""Drift against a stored baseline, from mergeable quantile sketches.

A sketch (KLL) of a feature's values takes a few kilobytes whatever the number of rows.
It is kept per feature and snapshot; sketches of several days merge into one, so a
baseline of months is compared with today without reading its rows again.  Ranks are off
by ``rank_error`` at most with 99 % confidence; ``drift.ks_test`` stays the exact way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.columns import nan_to_null
from seriesworks.functions.stats import kolmogorov_p

#: Size of a sketch, and quantiles of each sample at which the samples are compared.
SKETCH_SIZE, POINTS = 800, 400


def rank_error(size: int = SKETCH_SIZE) -> float:
    """Error of a rank, as a share of the rows, that one sketch keeps with 99 % confidence."""
    return 2.296 / size**0.9723


def sketch_features(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE
) -> DataFrame:
    """(by, feature, n, sketch): one row per group and column; partial sketches are merged by Spark.

    NULL and NaN are left out; a group without values has none of its own.
    """
    columns, by = list(columns), list(by)
    plain = nan_to_null(df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]), columns)
    made = plain.groupBy(*by).agg(
        *[F.kll_sketch_agg_double(c, F.lit(size)).alias(c) for c in columns], *[F.count(c).alias(f"_n_{c}") for c in columns]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_n_{c}").alias("n"), F.col(c).alias("sketch")) for c in columns])
    return made.select(*by, F.explode(rows).alias("_row")).select(*by, "_row.*").where(F.col("n") > 0)


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of several groups as one per feature, without their rows."""
    merged = F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    return sketches.groupBy(*by, "feature").agg(F.sum("n").alias("n"), merged)


def sketch_quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(..., quantile share, value) of each sketch."""
    values = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(s)) for s in shares]))
    pairs = F.arrays_zip(F.array(*[F.lit(float(s)) for s in shares]).alias("share"), values.alias("value"))
    rest = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*rest, F.explode(pairs).alias("_q")).select(*rest, F.col("_q.share").alias("share"), F.col("_q.value").alias("value"))


def sketch_drift(
    baseline: DataFrame, current: DataFrame, level: float = config.DRIFT_LEVEL, size: int = SKETCH_SIZE, points: int = POINTS
) -> DataFrame:
    """Kolmogorov-Smirnov test per feature from merged sketches (feature, n, sketch) of both samples.

    ``max_error`` bounds how far ``statistic`` is from the exact one (with 99 %
    confidence for each sketch): both rank errors and the distance of the points, between
    which the shares of a sample are not told apart.
    """
    shares = F.array(*[F.lit(i / points) for i in range(points + 1)])
    both = baseline.select("feature", F.col("n").alias("n_baseline"), F.kll_sketch_get_quantile_double("sketch", shares).alias("_b")).join(
        current.select("feature", F.col("n").alias("n_current"), F.kll_sketch_get_quantile_double("sketch", shares).alias("_c")), "feature"
    )

    def upto(quantiles: str, x):  # the share of a sample that is x or less is this many points, or less than one more
        return F.size(F.filter(quantiles, lambda v: v <= x))

    gaps = F.transform(F.array_union("_b", "_c"), lambda x: F.abs(upto("_b", x) - upto("_c", x)))
    tested = both.select("feature", "n_baseline", "n_current", (F.array_max(gaps) / points).alias("statistic"))
    p = kolmogorov_p(F.col("statistic"), F.col("n_baseline"), F.col("n_current"))
    tested = tested.withColumn("max_error", F.lit(2 * rank_error(size) + 1 / points)).withColumn("p_value", p)
    return tested.withColumn("is_drift", F.col("p_value") < level)
