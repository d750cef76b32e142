"""From transactions to a regular panel: daily roll-up, calendar, resampling.

After ``daily_totals`` a series has at most one row per day, so however many
transactions a product or customer has, one window partition never holds more
rows than there are days between the date bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.columns import known, nan_to_null
from seriesworks.functions.dates import next_periods, period_end, periods_between


def daily_totals(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Sum per series and day; NULL and NaN add nothing, so a day without a known value has 0.

    Dates are cut to days, so times of day do not split a day.  Partial sums are formed before the shuffle on (keys, date), which spreads a
    hot series over its days.  ``start``/``end`` drop stray dates first.
    """
    rows = between(df, date, start, end).groupBy(*keys, F.col(date).cast("date").alias(date))
    total = F.sum(known(df, target))
    return rows.agg(F.coalesce(total, F.lit(0)).alias(target))


def between(df: DataFrame, date: str, start: str | None, end: str | None) -> DataFrame:
    """Rows from day ``start`` to day ``end``, both included; None sets no limit."""
    day = F.col(date).cast("date")
    if start is not None:
        df = df.where(day >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(day <= F.lit(end).cast("date"))
    return df


def by_series(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash-partition by series: the session's shuffle partitions, or three tasks per core.

    This is the shuffle the series windows need anyway.  Stating it keeps adaptive
    execution from merging partitions by their size in bytes: a dense panel with 45
    features is many times larger and more work than the rows shuffled here.
    """
    spark = df.sparkSession
    parts = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism
    )
    return df.repartition(parts, *keys)


def series_window(keys: Sequence[str], date: str):
    return Window.partitionBy(*keys).orderBy(date)


def whole_series(keys: Sequence[str], date: str):
    """All rows of a series, in the order the other windows use, so one sort serves all."""
    return series_window(keys, date).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def so_far(keys: Sequence[str], date: str):
    return series_window(keys, date).rowsBetween(Window.unboundedPreceding, 0)


def densify(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    fill: str | None = "last",
) -> DataFrame:
    """One row per day from the first to the last day of each series.

    Each row is stretched up to the day before the
    next one, so there is a single shuffle on the keys and no join with a
    calendar.  ``fill="last"`` repeats the last known target on the added days
    (a leading NULL takes the first known one, an empty series 0);
    ``fill="zero"`` writes 0, ``fill=None`` leaves NULL.  Other columns are NULL
    on added days.  NaN counts as NULL.  Rows that share a day stay as they are, and no
    day is added for them.
    """
    df = nan_to_null(df, [target]).withColumn(date, F.col(date).cast("date"))
    w = series_window(keys, date)
    y = F.col(target)
    others = [c for c in df.columns if c not in (*keys, date, target)]
    following = F.greatest(F.date_sub(F.lead(date).over(w), 1), F.col(date))
    value = y
    if fill == "last":
        last_known = F.last(y, ignorenulls=True).over(so_far(keys, date))
        first_known = F.first(y, ignorenulls=True).over(whole_series(keys, date))
        value = F.coalesce(last_known, first_known, F.lit(0).cast(df.schema[target].dataType))
    elif fill not in ("zero", None):
        raise ValueError(f"unknown fill: {fill}")

    day = F.col(date).cast("date")
    sparse = by_series(df, keys).select(
        *keys,
        *others,
        F.col(date).cast("date").alias("_seen"),
        value.alias("_value"),
        F.sequence(day, F.coalesce(following, day)).alias("_days"),
    )
    rows = sparse.withColumn(date, F.explode("_days"))
    seen = F.col(date) == F.col("_seen")
    if fill == "last":
        filled = F.col("_value")
    elif fill == "zero":
        filled = F.coalesce(F.when(seen, F.col("_value")), F.lit(0).cast(df.schema[target].dataType))
    else:
        filled = F.when(seen, F.col("_value"))
    return rows.select(
        *keys, date, filled.alias(target), *[F.when(seen, F.col(c)).alias(c) for c in others]
    )


_RESAMPLE = {
    "sum": F.sum,
    "mean": F.avg,
    "median": lambda c: F.percentile(c, F.lit(0.5)),
    "max": F.max,
    "min": F.min,
}


def resample(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    freq: str = "D",
    how: str = "sum",
) -> DataFrame:
    """Aggregate a daily panel to periods labelled by their last day.

    Periods without rows between a series' first and last one are emitted too:
    0 for sums, NULL otherwise.  A group holds at most one quarter of days.
    """
    if how not in _RESAMPLE:
        raise ValueError(f"unknown aggregation: {how}")
    label = period_end(F.col(date).cast("date"), freq)
    grouped = df.groupBy(*keys, label.alias("_label")).agg(_RESAMPLE[how](target).alias("_value"))
    if how == "sum":
        grouped = grouped.withColumn("_value", F.coalesce("_value", F.lit(0.0)))
    w = Window.partitionBy(*keys).orderBy("_label")
    here = F.col("_label")
    empty = F.coalesce(periods_between(here, F.lead("_label").over(w), freq) - 1, F.lit(0))
    labels = grouped.select(*keys, "_label", "_value", empty.alias("_empty")).select(
        *keys,
        "_label",
        "_value",
        F.explode(F.concat(F.array(here), next_periods(here, F.col("_empty"), freq))).alias(date),
    )
    missing = F.lit(0.0) if how == "sum" else F.lit(None)
    return labels.select(
        *keys, date, F.when(F.col(date) == here, F.col("_value")).otherwise(missing).alias(target)
    )


def make_sequences(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    target: str = config.TARGET,
    n_in: int = config.SEQUENCE_IN,
    n_out: int = config.SEQUENCE_OUT,
) -> DataFrame:
    """Stride-1 supervised windows: ``x`` of length n_in followed by ``y`` of n_out."""
    w = series_window(keys, date)
    value = F.struct(F.col(target).alias("v"))  # a struct keeps NULL targets in place
    x = F.collect_list(value).over(w.rowsBetween(0, n_in - 1))
    y = F.collect_list(value).over(w.rowsBetween(n_in, n_in + n_out - 1))
    return (
        df.select(*keys, date, x.alias("_x"), y.alias("_y"))
        .where((F.size("_x") == n_in) & (F.size("_y") == n_out))
        .select(*keys, date, F.col("_x.v").alias("x"), F.col("_y.v").alias("y"))
    )
