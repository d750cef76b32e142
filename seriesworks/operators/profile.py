"""Profiles of the sales table: counts, ranges, top lists, series status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions.columns import valid_key
from seriesworks.operators.ranks import exact_quantiles, group_values, moments, null_safe_join, quantile_columns, value_counts


def keep_valid_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for k in keys:
        df = df.where(valid_key(F.col(k)))
    return df


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Sorted distinct values."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key)


def series_profile(
    df: DataFrame, by: Sequence[str], customer: str = "cust_name", date: str = "create_dt", qty: str = "qty"
) -> DataFrame:
    """Rows, first and last date, customers, total and average quantity per group.

    Rolled up to (group, customer) first, so the distinct count is a plain count
    and a hot product is spread over its customers.
    """
    per_customer = df.groupBy(*by, customer).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(qty).alias("_known"),
        F.sum(qty).alias("_sum"),
        F.min(date).alias("_first"),
        F.max(date).alias("_last"),
    )
    return per_customer.groupBy(*by).agg(
        F.sum("_rows").alias("total_count"),
        F.min("_first").alias("min_date"),
        F.max("_last").alias("max_date"),
        F.count(customer).alias("unique_customers"),
        F.sum("_sum").alias("total_qty"),
        F.try_divide(F.sum("_sum"), F.sum("_known")).alias("avg_qty"),
    )


def yearly_distribution(
    df: DataFrame, by: Sequence[str] = (), date: str = "create_dt", qty: str = "qty", limit: int = 20
) -> DataFrame:
    """Rows and quantity per year; the latest ``limit`` years (per group)."""
    years = df.groupBy(*by, F.year(date).alias("year")).agg(
        F.count(F.lit(1)).alias("record_count"), F.sum(qty).alias("total_qty")
    )
    if not by:
        return years.orderBy(F.col("year").desc()).limit(limit)
    return top_per_group(years, by, [F.col("year").desc()], limit)


def snapshot_counts(df: DataFrame, limit: int = 10) -> DataFrame:
    """Rows per snapshot, latest first."""
    return df.groupBy("dt").agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("dt").desc()).limit(limit)


def filter_variant_counts(df: DataFrame, variants: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """The same count under several predicates, in one pass."""
    return df.groupBy(*by).agg(*[F.count_if(p).alias(n) for n, p in variants.items()])


def date_range(
    df: DataFrame, product: str | None = None, customer: str | None = None, date: str = "create_dt"
) -> DataFrame:
    """First and last date; NULLs when nothing matches."""
    if product is not None:
        df = df.where(F.col("gcode") == product)
    if customer is not None:
        df = df.where(F.col("cust_name") == customer)
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def group_stats(df: DataFrame, by: Sequence[str], date: str = "create_dt", qty: str = "qty") -> DataFrame:
    """Count, sum, mean and date range per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum(qty).alias("total_qty"),
        F.avg(qty).alias("avg_qty"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def top_groups(df: DataFrame, by: Sequence[str], k: int = 10, date: str = "create_dt", qty: str = "qty") -> DataFrame:
    """The k groups with most rows; ties go to the smaller key."""
    return group_stats(df, by, date, qty).orderBy(F.col("record_count").desc(), *by).limit(k)


def largest_group(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The group with most rows; the first in key order on ties."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"))
    return sizes.orderBy(F.col("record_count").desc(), *by).limit(1)


def latest_rows(df: DataFrame, n: int = 10, date: str = "create_dt") -> DataFrame:
    """The n latest rows; the other columns break ties."""
    return df.orderBy(F.col(date).desc(), *[c for c in df.columns if c != date]).limit(n)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of each group.

    Spark keeps only k rows per group in each task before the shuffle (a limit on
    ``row_number``), so a hot group stays small.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_customers_per_product(
    df: DataFrame, k: int = config.AUTO_TOP_CUSTOMERS, product: str = "gcode", customer: str = "cust_name", qty: str = "qty"
) -> DataFrame:
    stats = df.groupBy(product, customer).agg(
        F.count(F.lit(1)).alias("record_count"), F.sum(qty).alias("total_qty")
    )
    return top_per_group(stats, [product], [F.col("record_count").desc(), F.col(customer)], k)


def auto_select(
    df: DataFrame,
    min_records: int = config.AUTO_MIN_RECORDS,
    top_products: int = config.AUTO_TOP_PRODUCTS,
    top_customers: int = config.AUTO_TOP_CUSTOMERS,
    product: str = "gcode",
    customer: str = "cust_name",
) -> DataFrame:
    """Products with enough rows, the largest of them, and their largest customers.

    One scan and one roll-up to (product, customer).  A product's total and its ranked
    customers share a window that holds one row per customer; only the kept customers,
    at most ``top_customers``, travel with their product through the top list.
    """
    counts = (
        df.where(valid_key(F.col(product)))
        .groupBy(product, customer)
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    per_product = Window.partitionBy(product)
    ranked = counts.withColumns(
        {
            "total_records": F.sum("record_count").over(per_product),
            "rank": F.row_number().over(per_product.orderBy(F.col("record_count").desc(), customer)),
        }
    )
    kept = ranked.where((F.col("rank") <= top_customers) & (F.col("total_records") >= min_records))
    chosen = (
        kept.groupBy(product, "total_records")
        .agg(F.collect_list(F.struct(customer, "record_count")).alias("_kept"))
        .orderBy(F.col("total_records").desc(), product)
        .limit(top_products)
    )
    rows = chosen.select(product, "total_records", F.explode("_kept").alias("_k"))
    return rows.select(product, f"_k.{customer}", "_k.record_count", "total_records").where(valid_key(F.col(customer)))


def series_status(
    df: DataFrame, keys: Sequence[str] = config.KEYS, min_points: int = config.MIN_POINTS
) -> DataFrame:
    """Rows per series and whether that is enough; short series stay, with a message."""
    return point_status(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("data_points")), min_points)


def point_status(counts: DataFrame, min_points: int = config.MIN_POINTS) -> DataFrame:
    """Add status and message to ``data_points`` per series."""
    short = F.col("data_points") < min_points
    return counts.withColumns(
        {
            "status": F.when(short, "skipped").otherwise("ready"),
            "message": F.when(
                short,
                F.concat(
                    F.lit("not enough data points ("), F.col("data_points").cast("string"), F.lit(f" < {min_points})")
                ),
            ).otherwise(""),
        }
    )


def requested_combinations(products: DataFrame, product: str, customers: Sequence[str], customer: str) -> DataFrame:
    """Each product of a table with each customer of a request list."""
    names = F.array(*[F.lit(c) for c in customers])
    return products.select(product).distinct().withColumn(customer, F.explode(names))


def combination_status(
    requests: DataFrame, df: DataFrame, keys: Sequence[str], min_points: int = config.MIN_POINTS
) -> DataFrame:
    """Status of every requested pair; pairs without any data are ``missing``."""
    status = series_status(df, keys, min_points)
    return requests.join(status, list(keys), "left").select(
        *keys,
        F.coalesce("data_points", F.lit(0)).alias("data_points"),
        F.coalesce("status", F.lit("missing")).alias("status"),
        F.coalesce("message", F.lit("no data")).alias("message"),
    )


def combination_coverage(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key pairs are possible, present and missing, without listing them."""
    product, customer = keys
    pairs = df.groupBy(product, customer).agg(F.count(F.lit(1)).alias("n"))
    counts = pairs.agg(
        F.countDistinct(product).alias("products"),
        F.countDistinct(customer).alias("customers"),
        F.count(F.lit(1)).alias("present"),
    )
    possible = F.col("products") * F.col("customers")
    return counts.withColumn("possible", possible).withColumn("missing", possible - F.col("present"))


def stale_dates(df: DataFrame, by: Sequence[str] = (), date: str = "create_dt", year: int = config.STALE_YEAR) -> DataFrame:
    """Earliest date, whether it is implausibly old, and how many rows are."""
    old = F.year(date) < year
    return df.groupBy(*by).agg(
        F.min(date).alias("min_date"),
        (F.year(F.min(date)) < year).alias("is_stale"),
        F.count_if(old).alias("stale_rows"),
    )


def describe_column(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles, max of one column.

    Quartiles are exact and safe for groups of any size.
    """
    groups = list(by) or ["_all"]
    rows = df.select(*([] if not by else by), *([] if by else [F.lit(0).alias("_all")]), F.col(column).alias("_x"))
    names = {0.25: "q25", 0.5: "median", 0.75: "q75"}
    counted = value_counts(group_values(rows, groups, "_x"), groups)
    quartiles = quantile_columns(exact_quantiles(counted, groups, list(names)), groups, names)
    return null_safe_join(moments(counted, groups), quartiles, groups).drop("_all")
