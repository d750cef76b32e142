"""Distribution and performance drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.columns import numeric_columns
from seriesworks.functions.stats import chi_square_p, exact_kolmogorov_p, kolmogorov_p
from seriesworks.operators.ranks import (
    cumulative_counts,
    exact_quantiles,
    long_values,
    moments,
    quantile_columns,
    value_counts,
)

_QUARTILES = {0.25: "q25", 0.5: "median", 0.75: "q75"}
_FEATURE = ["feature"]
#: Rows of either sample up to which an exact p-value is computed, if asked for.
EXACT_ROWS = 10_000


def baseline_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, std, min, max, median and quartiles per feature; unknown columns are skipped.

    A column without a known value has a row of NULLs.
    """
    columns = [c for c in columns or numeric_columns(df) if c in df.columns]
    counted = value_counts(long_values(df, columns), _FEATURE)
    quartiles = quantile_columns(exact_quantiles(counted, _FEATURE, list(_QUARTILES)), _FEATURE, _QUARTILES)
    wanted = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return (
        wanted.join(moments(counted, _FEATURE), "feature", "left")
        .join(quartiles, "feature", "left")
        .select("feature", "mean", "std", "min", "max", "median", "q25", "q75")
    )


def pool(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both samples stacked, with a flag for the current one."""
    return baseline.select(*columns, F.lit(False).alias("is_current")).unionByName(
        current.select(*columns, F.lit(True).alias("is_current"))
    )


def _shared_columns(baseline: DataFrame, current: DataFrame, columns: Sequence[str] | None) -> list[str]:
    wanted = columns or numeric_columns(baseline)
    return [c for c in wanted if c in baseline.columns and c in current.columns]


def _sample_counts(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = long_values(pool(baseline, current, columns), columns, keep=["is_current"])
    return value_counts(
        rows,
        _FEATURE,
        n_baseline=F.count_if(~F.col("is_current")),
        n_current=F.count_if(F.col("is_current")),
    )


def ks_test(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    level: float = config.DRIFT_LEVEL,
    exact: bool = False,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per feature; NULLs are left out.

    The p-value is the asymptotic one.  With ``exact`` it is exact for features with
    ``EXACT_ROWS`` rows or fewer in both samples, and ``method`` says which one it is.
    """
    columns = _shared_columns(baseline, current, columns)
    names = ["n_baseline", "n_current"]
    running = cumulative_counts(_sample_counts(baseline, current, columns), _FEATURE, names)
    gap = F.abs(
        F.try_divide(F.col("cum_n_baseline"), F.col("total_n_baseline"))
        - F.try_divide(F.col("cum_n_current"), F.col("total_n_current"))
    )
    sizes = F.col("n_baseline"), F.col("n_current")
    tested = (
        running.groupBy("feature")
        .agg(
            F.max(gap).alias("statistic"),
            F.max("total_n_baseline").alias("n_baseline"),
            F.max("total_n_current").alias("n_current"),
        )
        .withColumn("p_value", kolmogorov_p(F.col("statistic"), *sizes))
    )
    if exact:
        small = F.greatest(*sizes) <= EXACT_ROWS
        # large samples are not handed over
        of_small = [F.when(small, c) for c in (F.col("statistic"), *sizes)]
        tested = tested.withColumn("p_value", F.when(small, exact_kolmogorov_p(*of_small)).otherwise(F.col("p_value")))
        tested = tested.withColumn("method", F.when(small, "exact").otherwise("asymptotic"))
    return tested.withColumn("is_drift", F.col("p_value") < level)


def pooled_bins(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """Counts of both samples per feature and pooled-quantile bin; bins are (a, b]."""
    counted = _sample_counts(baseline, current, columns)
    both = counted.withColumn("n", F.col("n_baseline") + F.col("n_current"))
    edges = (
        exact_quantiles(both, _FEATURE, [i / bins for i in range(bins + 1)])
        .groupBy("feature")
        .agg(F.sort_array(F.collect_set("quantile")).alias("edges"))  # at most bins + 1 numbers
    )
    below = F.size(F.filter("edges", lambda e: e < F.col("value")))
    return (
        # one row per tested column with at most bins + 1 numbers: safe to broadcast
        counted.join(F.broadcast(edges), "feature")
        .groupBy("feature", (F.size("edges") - 1).alias("bins"), F.greatest(below, F.lit(1)).alias("bin"))
        .agg(F.sum("n_baseline").alias("n_baseline"), F.sum("n_current").alias("n_current"))
    )


def aligned_bins(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, bins: int = config.DRIFT_BINS
) -> DataFrame:
    """Every bin of every feature with both counts, 0 where a sample has none."""
    columns = _shared_columns(baseline, current, columns)
    table = pooled_bins(baseline, current, columns, bins)
    every = table.groupBy("feature").agg(F.max("bins").alias("bins")).where(F.col("bins") > 0)
    every = every.select("feature", F.explode(F.sequence(F.lit(1), F.col("bins"))).alias("bin"))
    counts = table.drop("bins")
    return every.join(counts, ["feature", "bin"], "left").select(
        "feature",
        "bin",
        F.coalesce("n_baseline", F.lit(0)).alias("n_baseline"),
        F.coalesce("n_current", F.lit(0)).alias("n_current"),
    )


def chi2_test(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = config.DRIFT_BINS,
    level: float = config.DRIFT_LEVEL,
) -> DataFrame:
    """Chi-square test on pooled-quantile bins per feature.

    Yates' correction applies to a 2x2 table only.  A feature that cannot be
    tested (constant, or an empty bin) gets an error text instead of a result.
    """
    columns = _shared_columns(baseline, current, columns)
    table = pooled_bins(baseline, current, columns, bins)
    per_feature = table.groupBy("feature").agg(
        F.max("bins").alias("k"),
        # one entry per bin: bounded by the number of bins
        F.collect_list(F.struct("n_baseline", "n_current")).alias("cells"),
        F.sum("n_baseline").alias("n_baseline"),
        F.sum("n_current").alias("n_current"),
    )
    total = (F.col("n_baseline") + F.col("n_current")).cast("double")

    def cell_term(observed, row_total, column_total):
        expected = row_total * column_total / total
        distance = F.abs(observed - expected)
        yates = F.when(F.col("k") == 2, F.least(distance, F.lit(0.5))).otherwise(F.lit(0.0))
        return (distance - yates) * (distance - yates) / expected

    def add_bin(acc, cell):
        column_total = cell["n_baseline"] + cell["n_current"]
        return (
            acc
            + cell_term(cell["n_baseline"], F.col("n_baseline"), column_total)
            + cell_term(cell["n_current"], F.col("n_current"), column_total)
        )

    error = (
        F.when(F.col("k") < 1, F.lit("constant feature: no bins"))
        .when((F.col("n_baseline") == 0) | (F.col("n_current") == 0), F.lit("empty sample"))
        .when(F.size("cells") < F.col("k"), F.lit("empty bin: expected frequency is zero"))
    )
    statistic = F.when(
        F.col("error").isNull(),
        F.when(F.col("k") == 1, F.lit(0.0)).otherwise(F.aggregate("cells", F.lit(0.0), add_bin)),
    )
    return (
        per_feature.withColumn("error", error)
        .withColumn("statistic", statistic)
        .withColumn("dof", F.col("k") - 1)
        .withColumn(
            "p_value",
            F.when(F.col("statistic").isNotNull() & (F.col("dof") == 0), F.lit(1.0)).otherwise(
                chi_square_p(F.col("statistic"), F.col("dof"))
            ),
        )
        .withColumn("is_drift", F.col("p_value") < level)
        .select("feature", "statistic", "dof", "p_value", "is_drift", "n_baseline", "n_current", "error")
    )


def detect_drift(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "ks",
    level: float = config.DRIFT_LEVEL,
) -> DataFrame:
    """One row per feature: is_drift, statistic, p_value, method, error.

    All features are tested in one job.  Columns missing on a side are skipped; a
    column that is not numeric or has no values becomes an error row.
    """
    wanted = _shared_columns(baseline, current, columns)
    numbers = set(numeric_columns(baseline)) & set(numeric_columns(current))
    tested = [c for c in wanted if c in numbers]
    others = [c for c in wanted if c not in numbers]
    if method not in ("ks", "chi2"):
        raise ValueError(f"unknown method: {method}")
    spark = baseline.sparkSession
    schema = "feature string, error string"
    asked = spark.createDataFrame(
        [(c, None) for c in tested] + [(c, "not a numeric column") for c in others], schema
    )
    if tested:
        result = (
            ks_test(baseline, current, tested, level).withColumn("problem", F.lit(None).cast("string"))
            if method == "ks"
            else chi2_test(baseline, current, tested, level=level).withColumnRenamed("error", "problem")
        )
    else:
        result = spark.createDataFrame(
            [], "feature string, statistic double, p_value double, is_drift boolean, problem string"
        )
    missing = F.when(F.col("statistic").isNull(), F.lit("no values in one of the samples"))
    return asked.join(result, "feature", "left").select(
        "feature",
        "is_drift",
        "statistic",
        "p_value",
        F.lit(method).alias("method"),
        F.coalesce("error", "problem", missing).alias("error"),
    )


def performance_drift(
    baseline: DataFrame,
    current: DataFrame,
    tolerance: float = config.PERFORMANCE_TOLERANCE,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Compare (metric, value) tables; metrics missing on a side are skipped.

    A change that is no number, as between two infinite values, is no drift.
    """
    on = [*keys, "metric"]
    joined = baseline.select(*on, F.col("value").alias("baseline")).join(
        current.select(*on, F.col("value").alias("current")), on
    )
    change = F.col("current") - F.col("baseline")
    relative = F.when(F.col("baseline") == 0, F.abs(change)).otherwise(
        F.abs(F.try_divide(change, F.col("baseline")))
    )
    return joined.select(
        *on,
        ((relative > tolerance) & ~F.isnan(relative)).alias("is_drift"),
        "baseline",
        "current",
        relative.alias("relative_change"),
        change.alias("absolute_change"),
    )


def drift_summary(results: DataFrame) -> DataFrame:
    """Number of tested and drifted features and their ratio."""
    drifted = F.count_if(F.coalesce(F.col("is_drift"), F.lit(False)))
    return results.agg(
        F.count(F.lit(1)).alias("features"),
        drifted.alias("drifted"),
        F.try_divide(drifted, F.count(F.lit(1))).alias("drift_ratio"),
    )


def drift_report(results: DataFrame) -> DataFrame:
    """Totals as the first section, then one row per drifted feature."""
    totals = drift_summary(results).select(
        F.lit("summary").alias("section"),
        F.lit("all").alias("feature"),
        "features",
        "drifted",
        "drift_ratio",
        F.lit(None).cast("string").alias("method"),
        F.lit(None).cast("double").alias("statistic"),
        F.lit(None).cast("double").alias("p_value"),
    )
    details = results.where("is_drift").select(
        F.lit("drifted").alias("section"), "feature", "method", "statistic", "p_value"
    )
    return totals.unionByName(details, allowMissingColumns=True)
