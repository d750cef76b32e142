"""Time-ordered splits, cross-validation folds and rolling origins.

Rows are numbered inside their own series; nothing is shuffled at random.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators.panel import series_window


def _numbered(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """``_pos`` counts from 0, ``_n`` is the length of the series."""
    return df.withColumns(
        {
            "_pos": F.row_number().over(series_window(keys, date)) - 1,
            "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
        }
    )


def time_split(
    df: DataFrame,
    test_size: float = config.TEST_SIZE,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
) -> DataFrame:
    """Add ``split``: the first int(n * (1 - test_size)) rows are train, the rest test."""
    train_rows = F.floor(F.col("_n") * F.lit(1 - test_size))
    split = F.when(F.col("_pos") < train_rows, "train").otherwise("test")
    return _numbered(df, keys, date).withColumn("split", split).drop("_pos", "_n")


def three_way_split(
    df: DataFrame,
    test_size: float = config.TEST_SIZE,
    validation_share: float = config.VALIDATION_SHARE,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
) -> DataFrame:
    """train / valid / test; valid is the last part of the training rows and may be empty."""
    train_rows = F.floor(F.col("_n") * F.lit(1 - test_size))
    valid_rows = F.floor(train_rows * F.lit(validation_share))
    split = (
        F.when(F.col("_pos") < train_rows - valid_rows, "train")
        .when(F.col("_pos") < train_rows, "valid")
        .otherwise("test")
    )
    return _numbered(df, keys, date).withColumn("split", split).drop("_pos", "_n")


def cv_folds(
    df: DataFrame,
    n_splits: int = config.CV_FOLDS,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
) -> DataFrame:
    """Add ``fold``: the fold a row validates, 0 for the initial training part.

    A row trains every later fold, so fold f trains on ``fold < f`` and validates on
    ``fold = f`` without copying rows.  A series that is too short has NULL folds.
    """
    size = F.floor(F.col("_n") / (n_splits + 1))
    first = F.col("_n") - n_splits * size
    fold = F.when(F.col("_pos") < first, F.lit(0)).otherwise(
        (F.floor(F.try_divide(F.col("_pos") - first, size)) + 1).cast("int")
    )
    return _numbered(df, keys, date).withColumn("fold", F.when(size > 0, fold)).drop("_pos", "_n")


def fold_rows(folded: DataFrame, n_splits: int = config.CV_FOLDS) -> DataFrame:
    """One row per (row, fold it takes part in) with its role; at most n_splits copies."""
    start = F.greatest(F.col("fold"), F.lit(1))
    copies = folded.where(F.col("fold").isNotNull()).withColumn(
        "_fold", F.explode(F.sequence(start, F.lit(n_splits)))
    )
    role = F.when(F.col("fold") == F.col("_fold"), "valid").otherwise("train")
    return copies.withColumn("role", role).withColumn("fold", F.col("_fold")).drop("_fold")


def rolling_cutoffs(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    initial: int = config.CV_INITIAL_DAYS,
    period: int = config.CV_PERIOD_DAYS,
    horizon: int = config.CV_HORIZON_DAYS,
) -> DataFrame:
    """Cutoffs from end - horizon backwards by period, none before start + initial."""
    spans = df.groupBy(*keys).agg(F.min(date).alias("_start"), F.max(date).alias("_end"))
    last = F.date_sub("_end", horizon)
    steps = F.floor((F.date_diff(last, F.col("_start")) - initial) / period).cast("int")
    cutoffs = F.transform(F.sequence(F.lit(0), F.col("_steps")), lambda i: F.date_sub(last, i * period))
    return (
        spans.withColumn("_steps", steps)
        .where(F.col("_steps") >= 0)
        .select(*keys, F.col("_start").alias("train_start"), F.explode(cutoffs).alias("cutoff"))
        .withColumn("valid_end", F.date_add("cutoff", horizon))
    )


def rolling_origin_rows(
    df: DataFrame,
    keys: Sequence[str] = config.KEYS,
    date: str = config.DATE,
    initial: int = config.CV_INITIAL_DAYS,
    period: int = config.CV_PERIOD_DAYS,
    horizon: int = config.CV_HORIZON_DAYS,
) -> DataFrame:
    """Validation rows with their cutoff and horizon in days.

    The cutoffs a row belongs to follow from its distance to the series' end, so no
    join with the cutoff table is needed.
    """
    whole = Window.partitionBy(*keys)
    spans = df.withColumns({"_start": F.min(date).over(whole), "_end": F.max(date).over(whole)})
    back = F.date_diff(F.col("_end"), F.col(date))
    first = F.greatest(F.ceil((back - horizon + 1) / period), F.lit(0)).cast("int")
    last = F.floor(back / period).cast("int")
    steps = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    return (
        spans.withColumn("_step", F.explode(steps))
        .withColumn("cutoff", F.date_sub(F.col("_end"), horizon + F.col("_step") * period))
        .where(F.col("cutoff") >= F.date_add("_start", initial))
        .withColumn("horizon", F.date_diff(F.col(date), F.col("cutoff")))
        .drop("_start", "_end", "_step")
    )
