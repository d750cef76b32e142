"""Wide categorical columns as numbers: ordered target statistics.

A training row gets the smoothed mean target of its category's rows on earlier dates
only, so no row sees its own target; other rows get the mean of all training rows.  The
table of categories is a DataFrame throughout: it is joined, never collected, so its
number is free.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesworks import config

#: Weight of the prior, in rows.
SMOOTHING = 10.0


def _smooth(total: Column, n: Column, prior: Column | float, smoothing: float) -> Column:
    prior = F.lit(prior) if isinstance(prior, float) else prior
    return (F.coalesce(total, F.lit(0.0)) + prior * smoothing) / (F.coalesce(n, F.lit(0)) + F.lit(smoothing))


def category_statistics(
    train: DataFrame, category: str, target: str = config.TARGET, date: str = config.DATE
) -> DataFrame:
    """(category, date, running sums before the date, and up to it).

    Rows are summed by category and date first, so a category with a third of all rows
    is a window of as many rows as there are dates.
    """
    daily = (
        train.where(F.col(target).isNotNull())
        .groupBy(category, date)
        .agg(F.sum(F.col(target).cast("double")).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    )
    upto = Window.partitionBy(category).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        category,
        date,
        (F.sum("_sum").over(upto) - F.col("_sum")).alias("sum_before"),
        (F.sum("_rows").over(upto) - F.col("_rows")).alias("rows_before"),
        F.sum("_sum").over(upto).alias("sum_upto"),
        F.sum("_rows").over(upto).alias("rows_upto"),
    )


def category_table(train: DataFrame, category: str, target: str = config.TARGET, smoothing: float = SMOOTHING) -> DataFrame:
    """(category, encoded): the smoothed mean of all training rows of each category, for new rows."""
    prior = float(train.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0)
    total = F.sum(F.col(target).cast("double"))
    return train.groupBy(category).agg(_smooth(total, F.count(target), prior, smoothing).alias("encoded"))


def encode_ordered(
    df: DataFrame,
    categorical: Sequence[str],
    target: str = config.TARGET,
    date: str = config.DATE,
    split: str = "split",
    smoothing: float = SMOOTHING,
    suffix: str = "_encoded",
) -> DataFrame:
    """Add ``<column>_encoded`` for each categorical column.

    Rows whose ``split`` is ``train`` see earlier dates only; the others all training
    rows.  NULL is a category like others; an unknown one gets the prior, the mean
    target of the training rows.
    """
    train = df.where(F.col(split) == "train")
    prior = float(train.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0)
    for c in categorical:
        stats = category_statistics(train, c, target, date)
        before = stats.select(F.col(c).alias("_c"), F.col(date).alias("_d"), F.col("sum_before").alias("_s"), F.col("rows_before").alias("_n"))
        total = train.groupBy(F.col(c).alias("_c")).agg(F.sum(F.col(target).cast("double")).alias("_s_all"), F.count(target).alias("_n_all"))
        df = df.join(before, F.col(c).eqNullSafe(F.col("_c")) & (F.col(date) == F.col("_d")), "left").drop("_c", "_d")
        df = df.join(total, F.col(c).eqNullSafe(F.col("_c")), "left").drop("_c")
        is_train = F.coalesce(F.col(split) == "train", F.lit(False))
        encoded = F.when(is_train, _smooth(F.col("_s"), F.col("_n"), prior, smoothing)).otherwise(
            _smooth(F.col("_s_all"), F.col("_n_all"), prior, smoothing)
        )
        df = df.withColumn(f"{c}{suffix}", encoded).drop("_s", "_n", "_s_all", "_n_all")
    return df


def encode_with(df: DataFrame, tables: dict[str, DataFrame], prior: float, suffix: str = "_encoded") -> DataFrame:
    """Add the encoded columns from tables of ``category_table``; categories not in them get ``prior``."""
    for c, table in tables.items():
        table = table.select(F.col(c).alias("_c"), F.col("encoded").alias(f"{c}{suffix}"))
        df = df.join(table, F.col(c).eqNullSafe(F.col("_c")), "left").drop("_c").na.fill(prior, [f"{c}{suffix}"])
    return df
