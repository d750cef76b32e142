"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet, optionally partitioned by folder.

    The rebalance hint gives few, evenly sized files per folder; a hot folder is
    split over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def write_table(df: DataFrame, name: str) -> None:
    """Replace a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """Replace a catalog table stored by hashed keys: windows, groups and joins on them need no shuffle.

    The rows are dealt as the buckets are, so each bucket is one file (of each folder of
    ``partition_by``) and sorted.  ``path`` keeps the files outside the warehouse.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_partitions(df: DataFrame, name: str, keys: Sequence[str] = (), buckets: int | None = None) -> None:
    """Overwrite the partitions of a table that ``df`` has rows of; the other ones stay.

    With the table's ``keys`` and ``buckets`` each bucket stays one file of a folder.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns)
    if keys and buckets:
        rows = rows.repartition(buckets, *keys)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")  # the writer's option of that name does not reach tables
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)
