"""The given star-schema tables seen as sales, product and customer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = "2001-11-04"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str, customer: str = "segment") -> DataFrame:
    """One row per order line: product, customer, business date, quantity.

    ``customer`` is ``segment`` (few long series) or ``nation`` (more and sparser
    ones).  Join sides are left to the optimizer, which broadcasts a dimension
    only below its size threshold.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    joined = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customers, F.col("o_custkey") == customers.c_custkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
    )
    if customer == "nation":
        nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        joined = joined.join(nations, F.col("c_nationkey") == nations.n_nationkey)
        name = F.col("n_name")
    elif customer == "segment":
        name = F.col("c_mktsegment")
    else:
        raise ValueError(f"unknown customer level: {customer}")
    return joined.select(
        F.col("p_brand").alias("gcode"),
        F.to_date("l_shipdate").alias("create_dt"),
        F.col("l_quantity").alias("qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("invoice_price"),
        name.alias("cust_name"),
        F.col("l_partkey").cast("string").alias("code"),
        F.col("p_name").alias("gname"),
        F.col("c_nationkey").cast("string").alias("sale_area_id"),
        F.col("l_orderkey").cast("string").alias("contno"),
        F.col("l_tax").alias("invoice_tax_rate"),
        F.lit(SNAPSHOT).cast("date").alias("dt"),
    )


SALES_VIEW_COLUMNS = [
    "gcode", "create_dt", "qty", "invoice_price", "cust_name", "code", "gname",
    "sale_area_id", "contno", "invoice_tax_rate",
]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per product: the attributes of its first part."""
    parts = table(spark, sf_dir, "part")
    first = F.min_by(F.struct("p_type", "p_size", "p_name"), "p_partkey")
    return (
        parts.groupBy(F.col("p_brand").alias("gcode"))
        .agg(first.alias("part"))
        .select(
            "gcode",
            F.col("part.p_type").alias("prod_cat1"),
            F.col("part.p_size").cast("string").alias("dosage_form"),
            F.col("part.p_name").alias("prod_sale_name"),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
        F.col("n_name").alias("hospital_id"),
        F.col("n_name").alias("hospital_name"),
        F.col("r_name").alias("region"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
