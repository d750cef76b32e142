"""Exact ranks, quantiles and moments for groups of any size.

``percentile`` keeps all distinct values of a group in one task, and a window
ordered by the value needs the whole group in one task.  Both are fine for one
daily series, neither for a whole column.  Here rows are first counted per (group,
value), with partial counts before the shuffle, and that table is written once.
Then the value axis is cut into ranges: a small table of range totals gives each
range its offset, and running counts are taken inside a range.  The cut points only
balance the work; results are exact for any cut points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesworks.session import cut_lineage

RANGE = "_range"
#: Rows that a range holds, about.
ROWS_PER_RANGE = 100_000


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, NULL being a group like others; they come from the left."""
    names = {c: f"_right_{c}" for c in on}
    same = F.lit(True)
    for c, renamed in names.items():
        same = same & F.col(c).eqNullSafe(F.col(renamed))
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


def cut_points(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Approximate quantiles of a column; at most one number per range reaches the driver.

    The number of ranges follows the rows, so a range stays a task's work at any size.
    """
    n = ranges or max(2, -(-df.count() // ROWS_PER_RANGE))
    found = df.approxQuantile(column, [i / n for i in range(1, n)], 1.0 / (2 * n))
    return sorted(set(found)) or [0.0]


def with_range(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    """Add the number of the range a value falls in (order-preserving).

    Ranges are cut over all groups together and hold about equally many rows, so a
    group with a third of all rows is spread over a third of the ranges.
    """
    inf = float("inf")
    splits = [-inf, *cut_points(df, column, ranges), inf]
    ranged = Bucketizer(splits=splits, inputCol=column, outputCol=RANGE, handleInvalid="keep").transform(df)
    return ranged.withColumn(RANGE, F.col(RANGE).cast("int"))


def number(c: str | Column) -> Column:
    """As double, with NaN as NULL."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(feature, value) rows of the numeric ``columns``; NULL and NaN left out."""
    names = F.array(*[F.lit(c) for c in columns])
    cells = df.select(*keep, F.posexplode(F.array(*[number(c) for c in columns])).alias("_i", "value"))
    known = cells.where(F.col("value").isNotNull())
    return known.select(*keep, F.get(names, "_i").alias("feature"), "value")


def group_values(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """(groups, value) rows, for quantiles of one column per group."""
    return df.select(*groups, number(value).alias("value")).where(F.col("value").isNotNull())


def value_counts(rows: DataFrame, groups: Sequence[str], **counts: Column) -> DataFrame:
    """Counts per distinct value with the value's range, written once and reused.

    ``counts`` maps a name to a counting expression; the default is ``n``.
    """
    exprs = [e.alias(n) for n, e in counts.items()] or [F.count(F.lit(1)).alias("n")]
    return with_range(cut_lineage(rows.groupBy(*groups, "value").agg(*exprs)), "value")


def _range_offsets(counted: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per range: rows before it and rows in the whole group.  One row per (group, range)."""
    totals = counted.groupBy(*groups, RANGE).agg(*[F.sum(n).alias(n) for n in names])
    before = Window.partitionBy(*groups).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    return totals.select(
        *groups,
        RANGE,
        *[F.col(n).alias(f"_in_{n}") for n in names],
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in names],
        *[F.sum(n).over(whole).alias(f"total_{n}") for n in names],
    )


def cumulative_counts(counted: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Add ``cum_*`` (rows up to and including the value) and ``total_*`` per group."""
    offsets = _range_offsets(counted, groups, names)
    w = Window.partitionBy(*groups, RANGE).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    joined = null_safe_join(counted, offsets, [*groups, RANGE])
    return joined.select(
        *groups,
        "value",
        *names,
        *[(F.col(f"_before_{n}") + F.sum(n).over(w)).alias(f"cum_{n}") for n in names],
        *[f"total_{n}" for n in names],
    )


def exact_quantiles(counted: DataFrame, groups: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles: one row per (group, prob) with ``quantile``.

    ``counted`` has ``value`` and ``n`` as made by :func:`value_counts`.  Only the
    ranges that hold a wanted rank are sorted.
    """
    offsets = _range_offsets(counted, groups, ["n"])
    last = F.col("total_n") - 1
    wanted = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("prob"),
                side.cast("bigint").alias("rank"),
                (p * last - F.floor(p * last)).alias("share"),
                F.lit(upper).alias("upper"),
            )
            for p in probs
            for upper, side in ((False, F.floor(p * last)), (True, F.ceil(p * last)))
        ]
    )
    inside = F.filter(
        wanted,
        lambda t: (t["rank"] >= F.col("_before_n")) & (t["rank"] < F.col("_before_n") + F.col("_in_n")),
    )
    targets = offsets.select(*groups, RANGE, F.col("_before_n"), inside.alias("_targets")).where(
        F.size("_targets") > 0
    )
    w = Window.partitionBy(*groups, RANGE).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = null_safe_join(counted, targets, [*groups, RANGE]).select(
        *groups, "value", "n", "_targets", (F.col("_before_n") + F.sum("n").over(w)).alias("_upto")
    )
    here = F.filter(
        "_targets", lambda t: (t["rank"] < F.col("_upto")) & (t["rank"] >= F.col("_upto") - F.col("n"))
    )
    hits = upto.select(*groups, "value", F.explode(here).alias("t"))
    low = F.max(F.when(~F.col("t.upper"), F.col("value")))
    high = F.max(F.when(F.col("t.upper"), F.col("value")))
    return hits.groupBy(*groups, F.col("t.prob").alias("prob")).agg(
        (low + (high - low) * F.max("t.share")).alias("quantile")
    )


def quantile_columns(quantiles: DataFrame, groups: Sequence[str], names: dict[float, str]) -> DataFrame:
    """One column per probability."""
    return quantiles.groupBy(*groups).agg(
        *[F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(n) for p, n in names.items()]
    )


def attach_group_values(
    counted: DataFrame, groups: Sequence[str], per_range: dict[str, Column], per_group: dict[str, Column]
) -> DataFrame:
    """Add values of the whole group to every row, without joining on the group alone.

    ``per_range`` aggregates rows to (group, range); ``per_group`` combines those few
    rows per group.  The join is on (group, range), so a hot group stays spread.
    """
    partial = counted.groupBy(*groups, RANGE).agg(*[e.alias(n) for n, e in per_range.items()])
    whole = Window.partitionBy(*groups)
    values = partial.select(*groups, RANGE, *[e.over(whole).alias(n) for n, e in per_group.items()])
    return null_safe_join(counted, values, [*groups, RANGE])


def moments(counted: DataFrame, groups: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min and max per group from distinct values and counts."""
    n, v = F.col("n"), F.col("value")
    rows = attach_group_values(
        counted,
        groups,
        {"_n": F.sum(n), "_s": F.sum(v * n)},
        {"_count": F.sum("_n"), "_sum": F.sum("_s")},
    )
    away = v - F.col("_sum") / F.col("_count")
    return rows.groupBy(*groups).agg(
        F.max("_count").alias("count"),
        F.max(F.col("_sum") / F.col("_count")).alias("mean"),
        F.sqrt(F.try_divide(F.sum(away * away * n), F.max("_count") - 1)).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )
