"""Table scans and introspection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesworks import config


def _as_date(value: str | date) -> Column:
    return F.lit(value).cast("date")


def _business_dates(df: DataFrame, column: str, start, end) -> DataFrame:
    """Inclusive date range on the business date."""
    if start is not None:
        df = df.where(F.col(column) >= _as_date(start))
    if end is not None:
        df = df.where(F.col(column) <= _as_date(end))
    return df


def _select_known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not in table: {missing}")
    return df.select(*columns)


def scan_sales(
    sales: DataFrame,
    product: str | None = None,
    customer: str | None = None,
    start: str | date | None = None,
    end: str | date | None = None,
    snapshot: str | date | None = None,
    *,
    as_of: date | None = None,
    previous_day_snapshot: bool = False,
    last_five_years: bool = False,
    columns: Sequence[str] = tuple(config.SALES_COLUMNS),
    ordered: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Filtered, projected scan of the sales table.

    ``snapshot`` selects one partition of ``dt``; ``start``/``end`` bound the
    business date and are inclusive.  The two defaults are taken relative to
    ``as_of``.  Row order only means something together with ``limit``, so the
    global sort is left out unless asked for.
    """
    as_of = as_of or date.today()
    if previous_day_snapshot and snapshot is None:
        snapshot = as_of - timedelta(days=1)
    if last_five_years:
        start = start if start is not None else as_of - timedelta(days=365 * 5)
        end = end if end is not None else as_of

    df = sales
    if snapshot is not None:
        df = df.where(F.col("dt") == _as_date(snapshot))
    if product is not None:
        df = df.where(F.col("gcode") == product)
    if customer is not None:
        df = df.where(F.col("cust_name") == customer)
    df = _select_known(_business_dates(df, "create_dt", start, end), columns)
    if ordered or limit is not None:
        rest = [c for c in columns if c != "create_dt"]
        df = df.orderBy("create_dt", *rest)
    return df if limit is None else df.limit(limit)


def _keep_listed(df: DataFrame, column: str, wanted: Sequence[str] | DataFrame | None) -> DataFrame:
    """Lists become part of the filter; keys by the thousand belong in a table, which is semi-joined."""
    if wanted is None:
        return df
    if isinstance(wanted, DataFrame):
        return df.join(wanted.select(column).distinct(), column, "left_semi")
    return df.where(F.col(column).isin(list(wanted)))


def scan_batch(
    sales: DataFrame,
    products: Sequence[str] | DataFrame | None = None,
    customers: Sequence[str] | DataFrame | None = None,
    start: str | date | None = None,
    end: str | date | None = None,
    snapshot: str | date | None = None,
    columns: Sequence[str] = tuple(config.SALES_COLUMNS),
    ordered: bool = False,
) -> DataFrame:
    """Many series at once: lists (or key tables) on both keys plus a date range."""
    df = sales
    if snapshot is not None:
        df = df.where(F.col("dt") == _as_date(snapshot))
    df = _business_dates(df, "create_dt", start, end)
    df = _keep_listed(df, "gcode", products)
    df = _keep_listed(df, "cust_name", customers)
    df = _select_known(df, columns)
    return df.orderBy("gcode", "cust_name", "create_dt") if ordered else df


def scan_dimension(
    table: DataFrame, key: str, value: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Dimension scan with an optional key; ``columns=None`` keeps them all."""
    df = table if value is None else table.where(F.col(key) == value)
    return df if columns is None else _select_known(df, columns)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    date_columns: Sequence[str] = tuple(config.CSV_DATE_COLUMNS),
    text_columns: Sequence[str] = ("gcode", "cust_name", "drug_id", "hospital_id"),
) -> DataFrame:
    """CSV with a header; date columns become timestamps when every value parses.

    Key columns stay text, so leading zeros survive.  Give ``schema`` for large
    inputs: inferring it reads the files twice.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        inferred = reader.option("inferSchema", True).csv(path).schema
        schema = T.StructType(
            [
                T.StructField(f.name, T.StringType() if f.name in text_columns else f.dataType)
                for f in inferred.fields
            ]
        )
    df = reader.schema(schema).csv(path)
    return coerce_dates(df, date_columns)


def coerce_dates(df: DataFrame, columns: Sequence[str] = tuple(config.CSV_DATE_COLUMNS)) -> DataFrame:
    """Cast text date columns to timestamp; a column with any bad value stays as it is."""
    kinds = dict(df.dtypes)
    dates = [c for c in columns if kinds.get(c) == "date"]
    texts = [c for c in columns if kinds.get(c) == "string"]
    bad = {}
    if texts:
        bad = df.agg(
            *[
                F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS timestamp)").isNull()).alias(c)
                for c in texts
            ]
        ).first()
    good = dates + [c for c in texts if bad[c] == 0]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in good}) if good else df


def run_sql(spark: SparkSession, text: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL text with bound ``:name`` parameters over ``{name}`` DataFrames."""
    return spark.sql(text, args=params or {}, **frames)


def describe_columns(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Columns of a catalog table or view, with the current database."""
    database = spark.catalog.currentDatabase()
    rows = [
        (database, name, c.name, c.dataType, c.nullable, c.isPartition)
        for c in spark.catalog.listColumns(name)
    ]
    return spark.createDataFrame(
        rows,
        "database string, table_name string, column_name string, data_type string, "
        "nullable boolean, is_partition boolean",
    )


def check_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column: is it there, and which names look similar."""
    rows = []
    for name in expected:
        found = name in df.columns
        stem = name.lower()
        near = [] if found else [c for c in df.columns if stem in c.lower() or c.lower() in stem]
        rows.append((name, found, near))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, present boolean, suggestions array<string>"
    )


def column_report(df: DataFrame) -> DataFrame:
    """Type and non-null / null count per column, in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns]
    )
    longer = counts.unpivot("_rows", df.columns, "column_name", "non_null")
    kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return longer.select(
        "column_name",
        kinds[F.col("column_name")].alias("data_type"),
        "non_null",
        (F.col("_rows") - F.col("non_null")).alias("missing"),
    )
