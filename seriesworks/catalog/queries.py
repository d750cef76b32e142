"""The query catalogue: every operator over the given tables."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable
from datetime import date as Date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.functions import columns as cols
from seriesworks.functions import dates
from seriesworks.operators import (
    boosting,
    drift,
    encoding,
    features,
    forecast,
    increments,
    metrics,
    models,
    panel,
    prep,
    profile,
    sketches,
    series_boosting,
    splits,
    stages,
    store,
    training,
)
from seriesworks.plans import jobs
from seriesworks.session import application_folder, cut_lineage
from seriesworks.sources import jdbc, retail, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]

KEYS, DATE, TARGET = list(config.KEYS), config.DATE, config.TARGET
SALES_KEYS = ["gcode", "cust_name"]
AS_OF = Date(2001, 11, 5)
HOLIDAYS = [f"{y}-{d}" for y in range(1995, 2002) for d in ("01-01", "05-01", "07-04", "10-01", "12-25")]
REQUESTED_CUSTOMERS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "WHOLESALE"]
DRIFT_CUT = "2024-01-16 00:00:00"
SALES_MIDDLE = "1998-07-01"

_CATALOGUE: dict[str, Query] = {}


def query(run: Query) -> Query:
    _CATALOGUE[run.__name__] = run
    return run


def catalogue() -> dict[str, Query]:
    return dict(_CATALOGUE)


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating-point columns, so that results do not depend on summation order."""
    # the small shift keeps decimal ties from depending on the rounding method
    new = [
        (F.round(F.col(n).cast("double") + F.lit(1e-9), digits) + F.lit(0.0)).alias(n) if t in ("double", "float") else F.col(n)
        for n, t in df.dtypes
    ]
    return df.select(*new)


# ---------------------------------------------------------------- shared inputs


def _series(spark, sf_dir, customer="segment"):
    return jobs.series_rows(retail.sales(spark, sf_dir, customer))


def _daily(spark, sf_dir, customer="segment"):
    return panel.daily_totals(_series(spark, sf_dir, customer))


def _dense(spark, sf_dir, customer="segment"):
    return panel.densify(_daily(spark, sf_dir, customer))


def _gappy(spark, sf_dir):
    """Dense calendar with gaps left open; daily totals above 50 count as missing too."""
    daily = _daily(spark, sf_dir).withColumn(TARGET, F.when(F.col(TARGET) <= 50, F.col(TARGET)))
    return panel.densify(daily, fill=None)


def _predictions(spark, sf_dir, lag=7):
    """Naive forecast: the value a week earlier."""
    rows = features.add_lags(_dense(spark, sf_dir), lags=[lag])
    return rows.select(
        *KEYS, DATE, F.col(TARGET).alias("actual"), F.col(f"{TARGET}_lag_{lag}").alias("predicted")
    ).where(F.col("predicted").isNotNull())


def _samples(spark, sf_dir):
    """Events of the first and the second half of the month, with three numeric columns."""
    ts = F.col("ts")
    events = retail.events(spark, sf_dir).select(
        "ts",
        "value",
        F.hour(ts).cast("double").alias("hour"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    return events.where(ts < cut).drop("ts"), events.where(ts >= cut).drop("ts")


# ---------------------------------------------------------------- scans


@query
def sales_scan(spark, sf_dir):
    sales = retail.sales(spark, sf_dir)
    return tables.scan_sales(sales, start="1996-01-01", end="1998-12-31", columns=retail.SALES_VIEW_COLUMNS)


@query
def sales_first_rows(spark, sf_dir):
    """The earliest rows of one product, in order."""
    sales = retail.sales(spark, sf_dir)
    return tables.scan_sales(sales, "Brand#2", columns=retail.SALES_VIEW_COLUMNS, ordered=True, limit=200)


@query
def sales_date_parts(spark, sf_dir):
    """Rows behind each predicate of a partitioned JDBC read: together the whole range, once."""
    sales = retail.sales(spark, sf_dir)
    parts = jdbc.date_predicates("create_dt", Date(1995, 1, 1), Date(1999, 12, 31), 7)
    counts = sales.agg(*[F.count_if(F.expr(p)).alias(f"part_{i}") for i, p in enumerate(parts)])
    return counts.unpivot([], [f"part_{i}" for i in range(len(parts))], "part", "rows")


@query
def table_sink(spark, sf_dir):
    """Daily totals written to a catalog table, replaced, and read back."""
    name = f"seriesworks_{uuid.uuid4().hex}"
    daily = _daily(spark, sf_dir, "nation")
    sinks.write_table(daily.limit(0), name)
    sinks.write_table(daily, name)
    out = cut_lineage(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    return tidy(out)


@query
def expected_columns(spark, sf_dir):
    """Which expected columns the sales have, what looks like the missing ones, and how full they are."""
    sales = retail.sales(spark, sf_dir).select(*retail.SALES_VIEW_COLUMNS)
    checked = tables.check_columns(sales, ["gcode", "cust_name", "price", "CREATE_DT", "nothing"])
    known = tables.column_report(sales).select("column_name", "non_null")
    return checked.join(known, "column_name", "left").withColumn("suggestions", F.array_join("suggestions", ","))


@query
def described_table(spark, sf_dir):
    """Columns of a view as the catalog has them, with their distinct values."""
    name = f"sales_{uuid.uuid4().hex}"
    sales = retail.sales(spark, sf_dir).select("gcode", "create_dt", "qty", "cust_name")
    sales.createOrReplaceTempView(name)
    described = tables.describe_table(spark, name).select("column_name", "data_type", "is_partition")
    spark.catalog.dropTempView(name)
    counts = sales.agg(*[F.count_distinct(c).alias(c) for c in sales.columns]).unpivot([], sales.columns, "column_name", "distinct_values")
    return described.join(counts, "column_name")


@query
def run_log(spark, sf_dir):
    """Metrics of two naive forecasts, appended to a run table and read back."""
    path = f"{application_folder(spark)}/{uuid.uuid4().hex}"
    for lag in (1, 7):
        found = metrics.forecast_metrics(_predictions(spark, sf_dir, lag)).select("rmse", "mae", "r2")
        models.log_run(found.unpivot([], ["rmse", "mae", "r2"], "metric", "value"), path, f"lag_{lag}", {"lag": lag})
    return tidy(spark.read.parquet(path), 4)


@query
def sketch_drift(spark, sf_dir):
    """Events of the month's halves, compared by the merged sketches of their hours."""
    kept = [sketches.sketch_features(half, ["value", "k"], by=["hour"]) for half in _samples(spark, sf_dir)]
    return sketches.sketch_drift(*[sketches.merge_sketches(k) for k in kept])


@query
def sales_one_series(spark, sf_dir):
    sales = retail.sales(spark, sf_dir)
    return tables.scan_sales(sales, "Brand#2", "BUILDING", columns=retail.SALES_VIEW_COLUMNS)


@query
def sales_default_window(spark, sf_dir):
    return tables.scan_sales(
        retail.sales(spark, sf_dir),
        as_of=AS_OF,
        previous_day_snapshot=True,
        last_five_years=True,
        columns=retail.SALES_VIEW_COLUMNS,
    )


@query
def sales_in_list(spark, sf_dir):
    return tables.scan_batch(
        retail.sales(spark, sf_dir),
        ["Brand#1", "Brand#5", "Brand#9"],
        ["BUILDING", "MACHINERY"],
        "1997-01-01",
        "1999-12-31",
        retail.SNAPSHOT,
        columns=retail.SALES_VIEW_COLUMNS,
    )


@query
def sales_key_table(spark, sf_dir):
    """Keys given as a table: products whose first part is an ECONOMY one."""
    wanted = retail.products(spark, sf_dir).where(F.col("prod_cat1") == "ECONOMY")
    return tables.scan_batch(
        retail.sales(spark, sf_dir), products=wanted, columns=["gcode", "cust_name", "create_dt", "qty", "contno"]
    )


@query
def product_info(spark, sf_dir):
    return tables.scan_dimension(
        retail.products(spark, sf_dir), "gcode", columns=["gcode", "prod_cat1", "dosage_form", "prod_sale_name"]
    )


@query
def customer_info(spark, sf_dir):
    return tables.scan_dimension(retail.customers(spark, sf_dir), "hospital_id")


@query
def bound_sql(spark, sf_dir):
    text = """
        SELECT gcode, cust_name, count(*) AS records, sum(qty) AS total_qty
        FROM {sales} WHERE create_dt BETWEEN :first AND :last GROUP BY gcode, cust_name
    """
    params = {"first": Date(1997, 1, 1), "last": Date(1997, 12, 31)}
    return tables.run_sql(spark, text, params, sales=retail.sales(spark, sf_dir))


@query
def table_columns(spark, sf_dir):
    return tables.column_report(retail.sales(spark, sf_dir).select(*retail.SALES_VIEW_COLUMNS)).select(
        "column_name", "non_null", "missing"
    )


@query
def table_rows(spark, sf_dir):
    return retail.sales(spark, sf_dir).agg(F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------- profile


@query
def valid_keys(spark, sf_dir):
    rows = profile.keep_valid_keys(retail.sales(spark, sf_dir), SALES_KEYS)
    return rows.groupBy(*SALES_KEYS).agg(F.count(F.lit(1)).alias("records"))


@query
def valid_keys_with_blanks(spark, sf_dir):
    """Some products are blank, "None" or NULL, by quantity."""
    fifth = F.col("qty") % 5
    odd = F.when(fifth == 0, " ").when(fifth == 1, " None").when(fifth == 2, F.lit(None)).otherwise(F.col("gcode"))
    rows = profile.keep_valid_keys(retail.sales(spark, sf_dir).withColumn("gcode", odd), SALES_KEYS)
    return rows.groupBy(*SALES_KEYS).agg(F.count(F.lit(1)).alias("records"))


@query
def distinct_products(spark, sf_dir):
    return profile.distinct_keys(retail.sales(spark, sf_dir), "gcode")


@query
def distinct_customers(spark, sf_dir):
    return profile.distinct_keys(retail.sales(spark, sf_dir, "nation"), "cust_name")


@query
def series_profile(spark, sf_dir):
    return tidy(profile.series_profile(retail.sales(spark, sf_dir), ["gcode"]))


@query
def yearly_distribution(spark, sf_dir):
    return profile.yearly_distribution(retail.sales(spark, sf_dir))


@query
def snapshot_counts(spark, sf_dir):
    return profile.snapshot_counts(retail.sales(spark, sf_dir))


@query
def snapshot_counts_by_month(spark, sf_dir):
    """One snapshot a month: the last ten."""
    return profile.snapshot_counts(retail.sales(spark, sf_dir).withColumn("dt", F.last_day("create_dt")))


@query
def filter_variant_counts(spark, sf_dir):
    in_range = F.col("create_dt").between(Date(1997, 1, 1), Date(2000, 12, 31))
    snapshot = F.col("dt") == Date(2001, 11, 4)
    variants = {
        "no_filter": F.lit(True),
        "business_date": in_range,
        "snapshot": snapshot,
        "both": in_range & snapshot,
    }
    return profile.filter_variant_counts(retail.sales(spark, sf_dir), variants, by=["gcode"])


@query
def date_range(spark, sf_dir):
    return profile.date_range(retail.sales(spark, sf_dir), product="Brand#7")


@query
def customer_stats(spark, sf_dir):
    return tidy(profile.group_stats(retail.sales(spark, sf_dir, "nation"), ["cust_name"]))


@query
def top_customers(spark, sf_dir):
    return tidy(profile.top_groups(retail.sales(spark, sf_dir, "nation"), ["cust_name"], 10))


@query
def largest_customer(spark, sf_dir):
    return profile.largest_group(retail.sales(spark, sf_dir, "nation"), ["cust_name"])


@query
def top_customers_per_product(spark, sf_dir):
    return profile.top_customers_per_product(retail.sales(spark, sf_dir, "nation"), 3)


@query
def latest_sales(spark, sf_dir):
    columns = ["create_dt", "contno", "code", "gcode", "cust_name", "qty", "invoice_price"]
    return profile.latest_rows(retail.sales(spark, sf_dir).select(*columns), 10)


@query
def series_status(spark, sf_dir):
    return profile.series_status(_series(spark, sf_dir, "nation"))


@query
def combination_status(spark, sf_dir):
    sales = retail.sales(spark, sf_dir)
    requests = profile.requested_combinations(
        retail.products(spark, sf_dir), "gcode", REQUESTED_CUSTOMERS, "cust_name"
    )
    return profile.combination_status(requests, sales, SALES_KEYS, min_points=450)


@query
def combination_coverage(spark, sf_dir):
    return profile.combination_coverage(retail.sales(spark, sf_dir, "nation"), SALES_KEYS)


@query
def auto_select(spark, sf_dir):
    return profile.auto_select(retail.sales(spark, sf_dir, "nation"), 2400, 8, 5)


@query
def stale_dates(spark, sf_dir):
    return profile.stale_dates(retail.sales(spark, sf_dir), ["gcode"], year=1996)


@query
def target_profile(spark, sf_dir):
    return tidy(profile.describe_column(_dense(spark, sf_dir), TARGET, by=["drug_id"]))


@query
def pooled_samples(spark, sf_dir):
    baseline, current = _samples(spark, sf_dir)
    return drift.pool(baseline, current, ["value", "hour", "k"])


# ---------------------------------------------------------------- panel and preparation


@query
def daily_sales_from_timestamps(spark, sf_dir):
    """Order lines at different times of a day are one day; unknown quantities add nothing."""
    rows = jobs.series_rows(retail.sales(spark, sf_dir))
    quantity = F.col(TARGET)
    second = F.unix_seconds(F.col(DATE).cast("timestamp")) + (quantity * 1721).cast("long") % 86400
    odd = F.when(quantity % 7 > 0, quantity).otherwise(F.lit(float("nan")))
    return tidy(panel.daily_totals(rows.withColumn(DATE, F.timestamp_seconds(second)).withColumn(TARGET, odd)))


@query
def daily_sales(spark, sf_dir):
    return _daily(spark, sf_dir)


@query
def densified_series(spark, sf_dir):
    return _dense(spark, sf_dir)


@query
def densified_zero(spark, sf_dir):
    return panel.densify(_daily(spark, sf_dir), fill="zero")


@query
def missing_counts(spark, sf_dir):
    return prep.missing_counts(_gappy(spark, sf_dir))


def _filled(method):
    return lambda spark, sf_dir: tidy(prep.fill_missing(_gappy(spark, sf_dir), method))


_CATALOGUE["fill_forward"] = _filled("forward_fill")
_CATALOGUE["fill_backward"] = _filled("backward_fill")
_CATALOGUE["fill_interpolate"] = _filled("interpolate")
_CATALOGUE["fill_mean"] = _filled("mean")
_CATALOGUE["fill_median"] = _filled("median")
_CATALOGUE["fill_drop"] = _filled("drop")


def _treated(method, threshold=config.OUTLIER_THRESHOLD):
    return lambda spark, sf_dir: tidy(prep.treat_outliers(_dense(spark, sf_dir), method=method, threshold=threshold))


_CATALOGUE["clip_iqr"] = _treated("iqr", 0.5)
_CATALOGUE["zscore_replace"] = _treated("zscore")
_CATALOGUE["winsorize"] = _treated("clip")


@query
def outlier_counts(spark, sf_dir):
    return prep.outlier_counts(_dense(spark, sf_dir))


def _resampled(freq, how, customer="nation"):
    return lambda spark, sf_dir: tidy(panel.resample(_daily(spark, sf_dir, customer), freq=freq, how=how))


_CATALOGUE["resample_day_sum"] = _resampled("D", "sum", "segment")
_CATALOGUE["resample_week_sum"] = _resampled("W", "sum")
_CATALOGUE["resample_week_max"] = _resampled("W", "max")
_CATALOGUE["resample_month_mean"] = _resampled("M", "mean")
_CATALOGUE["resample_month_min"] = _resampled("M", "min")
_CATALOGUE["resample_quarter_median"] = _resampled("Q", "median")


@query
def scale_minmax(spark, sf_dir):
    return tidy(prep.scale(_dense(spark, sf_dir), [TARGET], "minmax"))


@query
def scale_standard(spark, sf_dir):
    return tidy(prep.scale(_dense(spark, sf_dir), [TARGET], "zscore"))


@query
def scaler_parameters(spark, sf_dir):
    return tidy(prep.fit_scaler(_dense(spark, sf_dir), [TARGET], "zscore"))


@query
def sequences(spark, sf_dir):
    """Inputs as text of whole numbers, so that every element is compared."""
    pairs = panel.make_sequences(_daily(spark, sf_dir, "nation"), n_in=14, n_out=2)
    text = {c: F.array_join(F.transform(c, lambda v: v.cast("bigint").cast("string")), ",") for c in ("x", "y")}
    return pairs.withColumns(text)


# ---------------------------------------------------------------- features


@query
def calendar_features(spark, sf_dir):
    days = _daily(spark, sf_dir).select(DATE).distinct()
    everything = [*config.DATE_FEATURES, "dayofyear", "weekofyear"]
    return tidy(dates.add_calendar_features(days, features=everything))


@query
def lag_features(spark, sf_dir):
    return features.add_lags(_dense(spark, sf_dir))


@query
def rolling_features(spark, sf_dir):
    return tidy(features.add_rolling(_dense(spark, sf_dir)), 5)


@query
def rolling_after_spike(spark, sf_dir):
    """A value of a billion must leave no trace once it has left the windows."""
    dense = _dense(spark, sf_dir)
    first = F.min(DATE).over(Window.partitionBy(*KEYS))
    spiked = dense.withColumn("_first", first).withColumn(TARGET, F.when(F.col(DATE) == F.col("_first"), 1e9).otherwise(F.col(TARGET)))
    rows = features.add_rolling(spiked).where(F.datediff(DATE, "_first") > 90).drop("_first")
    return tidy(rows, 5)


@query
def rolling_sparse(spark, sf_dir):
    """Rolling windows over a series with NULLs: complete windows only."""
    return tidy(features.add_rolling(_gappy(spark, sf_dir), windows=[3]), 5)


@query
def diff_features(spark, sf_dir):
    return features.add_diffs(_dense(spark, sf_dir))


@query
def expanding_features(spark, sf_dir):
    return tidy(features.add_expanding(_gappy(spark, sf_dir)), 5)


@query
def holiday_features(spark, sf_dir):
    days = _daily(spark, sf_dir).select(DATE).distinct()
    return dates.add_holiday_features(days, holidays=HOLIDAYS)


@query
def interaction_features(spark, sf_dir):
    rows = features.add_lags(_dense(spark, sf_dir), lags=[1, 7])
    pairs = [(f"{TARGET}_lag_1", f"{TARGET}_lag_7"), (TARGET, f"{TARGET}_lag_1"), (TARGET, "absent")]
    return tidy(cols.add_interactions(rows, pairs), 4)


@query
def compact_dates(spark, sf_dir):
    return _daily(spark, sf_dir).select(DATE).distinct().withColumn("compact", dates.compact_date(F.col(DATE)))


@query
def date_spine(spark, sf_dir):
    return dates.covered_days(retail.sales(spark, sf_dir).select(F.col("create_dt").alias(DATE)))


@query
def model_file_names(spark, sf_dir):
    """File-safe short names of every part."""
    parts = retail.table(spark, sf_dir, "part")
    name = F.concat_ws("/", "p_name", "p_brand", "p_type")
    return parts.select("p_partkey", cols.safe_name(name).alias("file_name"))


@query
def full_features(spark, sf_dir):
    return tidy(jobs.feature_matrix(retail.sales(spark, sf_dir)), 5)


@query
def increment_features(spark, sf_dir):
    """Features of the days from 2000 on, from bucketed states of the days before."""
    daily = _daily(spark, sf_dir)
    name = f"states_{uuid.uuid4().hex}"
    old = daily.where(F.col(DATE) < F.lit("2000-01-01").cast("date"))
    sinks.write_bucketed(increments.series_state(old), name, KEYS, 8, path=f"{application_folder(spark)}/{name}")
    return tidy(increments.new_features(spark.table(name), daily.where(F.col(DATE) >= F.lit("2000-01-01").cast("date"))), 5)


@query
def full_features_no_leak(spark, sf_dir):
    """Rolling, difference and expanding features that end on the row before."""
    dense = _dense(spark, sf_dir)
    built = features.build_features(dense, lags=[1, 7], windows=[7, 30], exclude_current=True)
    return tidy(built.select(*KEYS, DATE, TARGET, *[c for c in built.columns if c.startswith(f"{TARGET}_")]), 5)


@query
def feature_families(spark, sf_dir):
    return features.feature_catalogue(jobs.feature_matrix(retail.sales(spark, sf_dir)))


@query
def select_by_correlation(spark, sf_dir):
    return tidy(features.select_features(jobs.feature_matrix(retail.sales(spark, sf_dir))), 5)


@query
def select_by_variance(spark, sf_dir):
    rows = features.add_rolling(features.add_lags(_dense(spark, sf_dir)), statistics=["mean", "max"])
    return tidy(features.select_features(rows, "variance", threshold=150.0), 4)


# ---------------------------------------------------------------- splits


@query
def time_split(spark, sf_dir):
    return splits.time_split(_daily(spark, sf_dir))


@query
def three_way_split(spark, sf_dir):
    return splits.three_way_split(_daily(spark, sf_dir))


@query
def cv_folds(spark, sf_dir):
    return splits.cv_folds(_daily(spark, sf_dir))


@query
def cv_fold_sizes(spark, sf_dir):
    rows = splits.fold_rows(splits.cv_folds(_daily(spark, sf_dir, "nation")))
    return rows.groupBy(*KEYS, "fold").agg(
        F.count_if(F.col("role") == "train").alias("train_rows"),
        F.count_if(F.col("role") == "valid").alias("valid_rows"),
    )


@query
def rolling_cutoffs(spark, sf_dir):
    return splits.rolling_cutoffs(_daily(spark, sf_dir))


@query
def rolling_origin(spark, sf_dir):
    return splits.rolling_origin_rows(_dense(spark, sf_dir))


@query
def additive_cross_validation(spark, sf_dir):
    """Fits and forecasts of every series and cutoff, counted."""
    rows = forecast.cross_validate_additive(_dense(spark, sf_dir))
    return rows.groupBy(*KEYS, "cutoff").agg(
        F.count(F.lit(1)).alias("days"),
        F.count("predicted").alias("predicted_days"),
        F.min("horizon").alias("first_day"),
        F.max("horizon").alias("last_day"),
        F.round(F.sum("actual"), 3).alias("actual_total"),
    )


@query
def additive_trend(spark, sf_dir):
    """The additive fit without bends and seasons: a regression line for each series."""
    fitted = forecast.fit_additive(_dense(spark, sf_dir), seasonalities=(), changepoints=0)
    return tidy(fitted.select(*KEYS, "message", "intercept", "slope", "origin"), 3)


@query
def series_ridge(spark, sf_dir):
    """One lag and a fixed penalty: coefficients and errors that have a closed form."""
    rows = features.add_lags(_dense(spark, sf_dir), lags=[7]).na.drop()
    fixed = lambda x, y, x_valid, y_valid: training.ridge(x, y, 10.0)
    trained = training.train_series(rows, [f"{TARGET}_lag_7"], min_rows=100, fit=fixed)
    return tidy(
        trained.where("status = 'success'").select(
            *KEYS, "feature_rows", "intercept", F.get("coefficients", F.lit(0)).alias("coefficient"), "rmse", "mae"
        )
    )


@query
def recursive_forecast(spark, sf_dir):
    """Thirty days from lag features: the value seven days before, forecasts included."""
    return tidy(forecast.forecast_recursive(_dense(spark, sf_dir), forecast.seasonal_naive(7)))


@query
def csv_round_trip(spark, sf_dir):
    """Daily sales written as CSV and read with date coercion."""
    path = f"{application_folder(spark)}/csv-{uuid.uuid4().hex}"
    sinks.write_csv(_daily(spark, sf_dir), path)
    back = tables.read_csv(spark, path, date_columns=[DATE])
    return back.select(*KEYS, F.col(DATE).cast("date").alias(DATE), F.col(TARGET).cast("double").alias(TARGET))


@query
def parquet_round_trip(spark, sf_dir):
    """Daily sales written as Parquet, in a folder for each customer segment."""
    path = f"{application_folder(spark)}/parquet-{uuid.uuid4().hex}"
    sinks.write_parquet(_daily(spark, sf_dir), path, partition_by=["hospital_id"])
    back = spark.read.parquet(path)
    return back.select(*KEYS, DATE, TARGET)


# ---------------------------------------------------------------- metrics


@query
def forecast_errors(spark, sf_dir):
    return tidy(cols.add_forecast_errors(_predictions(spark, sf_dir)))


@query
def error_summary(spark, sf_dir):
    return tidy(metrics.error_summary(cols.add_forecast_errors(_predictions(spark, sf_dir)), KEYS))


@query
def forecast_metrics(spark, sf_dir):
    return tidy(metrics.forecast_metrics(_predictions(spark, sf_dir), KEYS, details=True))


@query
def split_metrics(spark, sf_dir):
    rows = splits.three_way_split(_predictions(spark, sf_dir))
    return tidy(metrics.forecast_metrics(rows, [*KEYS, "split"]))


@query
def evaluation_report(spark, sf_dir):
    return tidy(metrics.evaluation_report(_predictions(spark, sf_dir), ["drug_id"]))


@query
def cv_summary(spark, sf_dir):
    folded = splits.cv_folds(_predictions(spark, sf_dir)).where(F.col("fold") > 0)
    per_fold = metrics.forecast_metrics(folded, [*KEYS, "fold"])
    return tidy(metrics.cv_summary(per_fold, KEYS))


@query
def horizon_metrics_windowed(spark, sf_dir):
    """Windows of a tenth of the rows, over the horizons of a lag-30 forecast."""
    rows = splits.rolling_origin_rows(features.add_lags(_dense(spark, sf_dir), lags=[30]))
    rows = rows.withColumnsRenamed({TARGET: "actual", f"{TARGET}_lag_30": "predicted"})
    return tidy(metrics.rolling_horizon_metrics(rows, rolling_window=0.1))


@query
def horizon_metrics(spark, sf_dir):
    rows = features.add_lags(_dense(spark, sf_dir), lags=[30])
    rows = rows.select(*KEYS, DATE, F.col(TARGET).alias("actual"), F.col(f"{TARGET}_lag_30").alias("predicted"))
    rows = splits.rolling_origin_rows(rows).withColumns(
        {"lower": F.col("predicted") - 20, "upper": F.col("predicted") + 20}
    )
    return tidy(metrics.horizon_metrics(rows, lower="lower", upper="upper"))


@query
def residual_histogram(spark, sf_dir):
    return tidy(metrics.residual_histogram(_predictions(spark, sf_dir), ["drug_id"]), 4)


@query
def prediction_summary(spark, sf_dir):
    return tidy(metrics.prediction_summary(_predictions(spark, sf_dir)))


def _lag_models(spark, sf_dir):
    """Naive models: the value n days earlier, one model per lag, from one pass."""
    rows = features.add_lags(_dense(spark, sf_dir)).na.drop()
    lagged = {n: f"{TARGET}_lag_{n}" for n in config.LAGS}
    one_row = F.array(
        *[F.struct(F.lit(f"lag_{n}").alias("model"), F.lit(n).alias("trial"), F.col(c).alias("predicted")) for n, c in lagged.items()]
    )
    return rows.select(*KEYS, DATE, F.col(TARGET).alias("actual"), F.explode(one_row).alias("m")).select(
        *KEYS, DATE, "actual", "m.*"
    )


@query
def model_comparison(spark, sf_dir):
    per_model = metrics.forecast_metrics(_lag_models(spark, sf_dir), ["model"])
    return tidy(metrics.compare_models(metrics.metrics_long(per_model, ["model"], metrics.METRICS)))


@query
def running_best(spark, sf_dir):
    per_trial = metrics.forecast_metrics(_lag_models(spark, sf_dir), [*KEYS, "trial"])
    scores = per_trial.select(*KEYS, "trial", F.col("rmse").alias("score"))
    return tidy(metrics.running_best(scores, by=KEYS))


@query
def weighted_ensemble(spark, sf_dir):
    weights = {"lag_1": 0.5, "lag_7": 0.3, "lag_30": 0.2}
    return tidy(models.weighted_ensemble(_lag_models(spark, sf_dir), [*KEYS, DATE], weights))


def _naive_batch(spark, sf_dir):
    """Batch result rows with the naive forecast as the model of every series."""
    status = profile.series_status(_series(spark, sf_dir, "nation"))
    rows = features.add_lags(_dense(spark, sf_dir, "nation"), lags=[7]).na.drop()
    rows = rows.select(*KEYS, F.col(TARGET).alias("actual"), F.col(f"{TARGET}_lag_7").alias("predicted"))
    scored = metrics.forecast_metrics(rows, KEYS)
    ready = F.col("status") == "ready"
    joined = status.join(scored, KEYS, "left")
    return joined.select(
        *KEYS,
        F.when(ready, "success").otherwise("failed").alias("status"),
        "message",
        "data_points",
        *[F.when(ready, F.col(m)).alias(m) for m in metrics.METRICS],
    )


@query
def batch_summary(spark, sf_dir):
    return tidy(metrics.batch_summary(_naive_batch(spark, sf_dir)))


@query
def failed_series(spark, sf_dir):
    return metrics.failed_series(_naive_batch(spark, sf_dir))


@query
def rmse_alert(spark, sf_dir):
    return tidy(metrics.rmse_alert(_naive_batch(spark, sf_dir), threshold=15.0))


# ---------------------------------------------------------------- drift


@query
def baseline_stats(spark, sf_dir):
    return tidy(drift.baseline_stats(_samples(spark, sf_dir)[0]))


@query
def ks_drift(spark, sf_dir):
    return tidy(drift.ks_test(*_samples(spark, sf_dir)))


@query
def chi2_drift(spark, sf_dir):
    tested = drift.chi2_test(*_samples(spark, sf_dir))
    return tidy(tested.select("feature", "statistic", "dof", "n_baseline", "n_current"))


@query
def aligned_bins(spark, sf_dir):
    return drift.aligned_bins(*_samples(spark, sf_dir))


@query
def sales_ks_drift(spark, sf_dir):
    """Feature drift of the panel: first against second half of the years."""
    rows = features.add_rolling(features.add_lags(_dense(spark, sf_dir), lags=[7]), windows=[7, 30], statistics=["mean", "max"])
    cut = F.lit(SALES_MIDDLE).cast("date")
    tested = drift.ks_test(rows.where(F.col(DATE) < cut), rows.where(F.col(DATE) >= cut))
    return tidy(tested.select("feature", "statistic", "n_baseline", "n_current"))


@query
def detect_drift(spark, sf_dir):
    found = drift.detect_drift(*_samples(spark, sf_dir), columns=["value", "hour", "k", "absent"])
    return tidy(found)


@query
def detect_drift_chi2(spark, sf_dir):
    return tidy(drift.detect_drift(*_samples(spark, sf_dir), method="chi2"))


@query
def drift_summary(spark, sf_dir):
    return tidy(drift.drift_summary(drift.ks_test(*_samples(spark, sf_dir), level=0.5)))


@query
def drift_report_drifted(spark, sf_dir):
    """A level at which some features count as drifted and others do not."""
    return tidy(drift.drift_report(drift.detect_drift(*_samples(spark, sf_dir), level=0.7)))


@query
def drift_report(spark, sf_dir):
    return tidy(drift.drift_report(drift.detect_drift(*_samples(spark, sf_dir), level=0.5)))


def _half_metrics(spark, sf_dir):
    rows = _predictions(spark, sf_dir)
    cut = F.lit(SALES_MIDDLE).cast("date")
    early = metrics.forecast_metrics(rows.where(F.col(DATE) < cut), ["drug_id"])
    late = metrics.forecast_metrics(rows.where(F.col(DATE) >= cut), ["drug_id"])
    return [metrics.metrics_long(m, ["drug_id"], metrics.METRICS) for m in (early, late)]


@query
def performance_drift(spark, sf_dir):
    return tidy(drift.performance_drift(*_half_metrics(spark, sf_dir), tolerance=0.02, keys=["drug_id"]))


# ---------------------------------------------------------------- feature store


def _event_features(spark, sf_dir):
    return retail.events(spark, sf_dir).where(F.col("event_type") != "error")


@query
def pit_join(spark, sf_dir):
    """Each error event with the user's latest other event of the day before it."""
    entities = retail.events(spark, sf_dir).where(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    rows = _event_features(spark, sf_dir).select(
        "user_id", "ts", F.col("event_type").alias("last_type"), F.col("value").alias("last_value")
    )
    return store.pit_join(
        entities, rows, ["user_id"], ["last_type", "last_value"], ttl_days=1, entity_ts="ts", feature_ts="ts"
    )


def _product_history(spark, sf_dir):
    parts = retail.table(spark, sf_dir, "part")
    start = F.lit("1995-01-01").cast("date")
    return parts.select(
        F.col("p_brand").alias("gcode"),
        F.date_add(start, F.col("p_size") * 30).cast("timestamp").alias("event_timestamp"),
        F.col("p_type").alias("prod_cat1"),
        F.col("p_size").cast("string").alias("dosage_form"),
    )


def _sales_view(daily):
    dense = panel.densify(daily)
    rows = features.add_rolling(features.add_lags(dense, lags=[1, 7, 30]), windows=[7, 14, 30], statistics=["mean", "std"])
    rows = dates.add_calendar_features(rows)
    names = {"drug_id": "gcode", "hospital_id": "cust_name", DATE: "create_dt"}
    return rows.withColumnsRenamed(names)


@query
def historical_features(spark, sf_dir):
    """Two views with different keys, looked up 45 days after each day with sales."""
    daily = cut_lineage(_daily(spark, sf_dir))  # feeds the requests and one of the views
    entities = daily.select(
        F.col("drug_id").alias("gcode"),
        F.col("hospital_id").alias("cust_name"),
        F.date_add(DATE, 45).cast("timestamp").alias("event_timestamp"),
    )
    refs = [
        "sales_features:sales_quantity_lag_1",
        "sales_features:sales_quantity_rolling_30_mean",
        "sales_features:month",
        "drug_info_features:prod_cat1",
        "drug_info_features:dosage_form",
    ]
    views = {"sales_features": _sales_view(daily), "drug_info_features": _product_history(spark, sf_dir)}
    found = store.historical_features(entities, views, refs, daily=["sales_features"])
    return tidy(found.withColumn("event_timestamp", F.col("event_timestamp").cast("date")), 5)


@query
def materialize(spark, sf_dir):
    latest = store.materialize(_sales_view(_daily(spark, sf_dir)), "sales_features", "1996-01-01", "1999-06-30")
    return tidy(latest, 3)


@query
def latest_lookup(spark, sf_dir):
    """Latest event of each requested user; users without one get NULLs."""
    latest = store.latest_rows(_event_features(spark, sf_dir), ["user_id"], ["event_type", "value"], "ts", order_by=["event_id"])
    requests = retail.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return store.lookup(requests, latest, ["user_id"], ["event_type", "value"])


@query
def prepared_for_store(spark, sf_dir):
    ready = store.prepare_for_store(_daily(spark, sf_dir), "drug_id", "hospital_id", DATE)
    return ready.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


# ---------------------------------------------------------------- models


@query
def fourier_features(spark, sf_dir):
    days = _daily(spark, sf_dir).select(DATE).distinct()
    return tidy(forecast.add_fourier(days))


@query
def future_days(spark, sf_dir):
    return forecast.future_frame(_daily(spark, sf_dir), 30, "D")


@query
def future_weeks(spark, sf_dir):
    return forecast.future_frame(_daily(spark, sf_dir), 8, "W", include_history=True)


@query
def future_months(spark, sf_dir):
    return forecast.future_frame(_daily(spark, sf_dir), 6, "M")


@query
def batch_training(spark, sf_dir):
    results, _ = jobs.batch_train(retail.sales(spark, sf_dir))
    return tidy(results, 4)


@query
def batch_training_summary(spark, sf_dir):
    results, _ = jobs.batch_train(retail.sales(spark, sf_dir, "nation"))
    return tidy(metrics.batch_summary(results), 4)


@query
def batch_prediction(spark, sf_dir):
    sales = retail.sales(spark, sf_dir)
    _, trained = jobs.batch_train(sales)
    products = retail.products(spark, sf_dir).withColumnRenamed("gcode", "drug_id")
    requests = profile.requested_combinations(products, "drug_id", REQUESTED_CUSTOMERS, "hospital_id")
    return tidy(jobs.batch_predict(sales, trained, requests), 4)


@query
def batch_training_status(spark, sf_dir):
    """Which series were trained, and why the others were not."""
    results, _ = jobs.batch_train(retail.sales(spark, sf_dir, "nation"))
    return results.select(*KEYS, "status", "message", "data_points")


@query
def batch_prediction_coverage(spark, sf_dir):
    """Predictions and error rows per requested pair."""
    sales = retail.sales(spark, sf_dir)
    _, trained = jobs.batch_train(sales)
    products = retail.products(spark, sf_dir).withColumnRenamed("gcode", "drug_id")
    requests = profile.requested_combinations(products, "drug_id", REQUESTED_CUSTOMERS, "hospital_id")
    answers = jobs.batch_predict(sales, trained, requests)
    return answers.groupBy(*KEYS).agg(
        F.count("predicted").alias("predictions"), F.count("error").alias("errors")
    )


@query
def stacking_weights(spark, sf_dir):
    """Linear meta-model on two naive forecasts."""
    rows = features.add_lags(_dense(spark, sf_dir), lags=[1, 7]).na.drop()
    rows = cut_lineage(rows.select(f"{TARGET}_lag_1", f"{TARGET}_lag_7", TARGET))
    meta = models.fit_stacking(rows, [f"{TARGET}_lag_1", f"{TARGET}_lag_7"]).stages[-1]
    weights = [("intercept", float(meta.intercept))]
    weights += [(f"lag_{n}", float(w)) for n, w in zip((1, 7), meta.coefficients)]
    return tidy(spark.createDataFrame(weights, "feature string, weight double"), 4)


#: Larger steps than the default and less patience, so that the valid rows end the training after some twenty trees.
QUICK_STEPS = {"learning_rate": 0.3, "early_stopping_rounds": 5}


@query
def pooled_job(spark, sf_dir):
    """Train one boosted-tree model over all daily series until the valid rows stop it, then predict with it."""
    sales = retail.sales(spark, sf_dir)
    model, _, _ = jobs.train_pooled(sales, QUICK_STEPS)
    return tidy(jobs.predict_pooled(sales, model)[1], 4)


def _calendar_split(spark, sf_dir):
    """Daily totals with calendar columns; the years before 2000 are for training."""
    day = F.col(DATE)
    rows = _daily(spark, sf_dir).withColumns(
        {"month": F.month(day), "quarter": F.quarter(day), "day": F.dayofmonth(day), "dayofweek": F.weekday(day)}
    )
    return rows.withColumn("split", F.when(day < F.lit("2000-01-01").cast("date"), "train").otherwise("valid"))


CALENDAR = ["month", "quarter", "day", "dayofweek"]
#: One tree with one split, with both regularisations.
ONE_SPLIT = {
    "num_boost_round": 1, "num_leaves": 2, "learning_rate": 1.0, "lambda_l1": 5.0, "lambda_l2": 3.0,
    "feature_fraction": 1.0, "bagging_freq": 0, "early_stopping_rounds": 0,
}


@query
def boosting_first_split(spark, sf_dir):
    """One tree with one split, with both regularisations: the split must be the best of all."""
    rows = _calendar_split(spark, sf_dir)
    model = boosting.fit_trees(rows, CALENDAR, TARGET, ONE_SPLIT, max_bins=255)
    return tidy(dataclasses.replace(model, trees=model.grown).nodes(spark).drop("tree"), 4)


@query
def stage_round_trip(spark, sf_dir):
    """That tree as the stage of a pipeline, saved and loaded: its training predictions and their rows."""
    rows = cut_lineage(_calendar_split(spark, sf_dir).where("split = 'train'"))
    path = f"{application_folder(spark)}/stages-{uuid.uuid4().hex}"
    trees = stages.BoostedTreesRegressor(featureCols=CALENDAR, boosting=ONE_SPLIT, maxBins=255)
    Pipeline(stages=[trees]).fit(rows).write().save(path)
    loaded = PipelineModel.load(path).transform(rows)
    return tidy(loaded.groupBy("predicted").agg(F.count(F.lit(1)).alias("rows")), 4)


@query
def series_first_splits(spark, sf_dir):
    """One tree with one split for each series, with both regularisations: the split must be the best of all."""
    params = {
        "num_boost_round": 1, "num_leaves": 2, "max_depth": 1, "learning_rate": 1.0, "lambda_l1": 5.0, "lambda_l2": 3.0,
        "feature_fraction": 1.0, "bagging_freq": 0, "early_stopping_rounds": 0,
    }
    rows = _calendar_split(spark, sf_dir).where("split = 'train'")
    model = series_boosting.fit_series_trees(rows, ["month", "day", "dayofweek"], TARGET, params)
    return tidy(model.nodes.drop("tree"), 4)


@query
def batch_training_boosted(spark, sf_dir):
    """Boosted trees, three levels deep, for every series until its own valid rows stop it."""
    results, _ = jobs.batch_train_boosted(retail.sales(spark, sf_dir), QUICK_STEPS | {"max_depth": 3})
    return tidy(results, 4)


@query
def ordered_encoding(spark, sf_dir):
    """Products as numbers: training rows see the mean of earlier days only."""
    encoded = encoding.encode_ordered(_calendar_split(spark, sf_dir), ["drug_id", "hospital_id"])
    return tidy(encoded.select(*KEYS, DATE, "split", "drug_id_encoded", "hospital_id_encoded"))


@query
def boosted_importance(spark, sf_dir):
    """Gain and number of splits of each feature, products as encoded categories."""
    matrix = cut_lineage(_model_matrix(spark, sf_dir))
    model = boosting.fit_trees(matrix, cols.feature_columns(matrix), TARGET, QUICK_STEPS, categorical=["drug_id"])
    both = model.importance(spark, "gain").withColumnRenamed("importance", "gain")
    return tidy(both.join(model.importance(spark, "split").withColumnRenamed("importance", "splits"), "feature"), 2)


@query
def model_forecast(spark, sf_dir):
    """Thirty days ahead by the trained model of each series, each day from the ones before it."""
    sales = retail.sales(spark, sf_dir)
    _, trained = jobs.batch_train(sales)
    return tidy(jobs.batch_forecast(sales, trained, 30), 4)


@query
def forecast_intervals(spark, sf_dir):
    """The additive forecast with the range that holds 80 % of the values."""
    return tidy(forecast.forecast_with_interval(_dense(spark, sf_dir), 30).drop("is_future"), 4)


@query
def trend_intervals(spark, sf_dir):
    """Straight-line forecasts: the interval is the spread around the regression line."""
    line = {"seasonalities": (), "changepoints": 0}
    found = forecast.forecast_with_interval(_daily(spark, sf_dir), 7, width=0.95, **line)
    return tidy(found.select(*KEYS, DATE, "predicted", "lower", "upper"), 3)


@query
def ks_exact(spark, sf_dir):
    """Exact p-values for two halves of the suppliers."""
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_acctbal", F.col("s_nationkey").cast("double").alias("s_nationkey"))
    even = F.col("s_suppkey") % 2 == 0
    return tidy(drift.ks_test(rows.where(even), rows.where(~even), ["s_acctbal", "s_nationkey"], exact=True))


@query
def additive_forecast(spark, sf_dir):
    return tidy(forecast.forecast(_dense(spark, sf_dir), 30), 4)


def _model_matrix(spark, sf_dir):
    """Pooled model input on the monthly panel: small trees, whole table."""
    monthly = panel.resample(_daily(spark, sf_dir, "nation"), freq="M", how="sum")
    built = features.build_features(monthly, lags=[1, 2, 3], windows=[3, 6], exclude_current=True)
    return splits.three_way_split(built)


_SMALL_MODEL = {"num_boost_round": 8, "learning_rate": 0.3, "max_depth": 4}


@query
def boosted_trees(spark, sf_dir):
    matrix = cut_lineage(_model_matrix(spark, sf_dir))
    model = models.fit_boosting(matrix, cols.feature_columns(matrix), TARGET, _SMALL_MODEL, categorical=["drug_id"])
    return tidy(metrics.forecast_metrics(models.predict(model, matrix), ["split"]), 4)


@query
def feature_importance(spark, sf_dir):
    matrix = cut_lineage(_model_matrix(spark, sf_dir))
    model = models.fit_boosting(matrix, cols.feature_columns(matrix), TARGET, _SMALL_MODEL)
    return tidy(models.top_importance(models.feature_importance(model, spark)))


@query
def parameter_search(spark, sf_dir):
    matrix = cut_lineage(_model_matrix(spark, sf_dir))
    trials = models.sample_params(2, {"learning_rate": (0.1, 0.4), "max_depth": (3, 5)})
    tried = models.search(matrix, cols.feature_columns(matrix), trials, num_boost_round=4)
    return tidy(metrics.running_best(tried), 4)


@query
def halving_search(spark, sf_dir):
    """Twenty trials over all six dimensions; the best third of a rung trains three times as long."""
    matrix = cut_lineage(_model_matrix(spark, sf_dir))
    path = f"{application_folder(spark)}/{uuid.uuid4().hex}"
    trials = models.sample_params(20)
    tried = models.search_halving(matrix, cols.feature_columns(matrix), trials, path, rungs=(1, 3, 9))
    return tidy(tried.select("rung", "trial", "rounds", "params", "score"), 4)


@query
def daily_run(spark, sf_dir):
    found = jobs.daily_run(retail.sales(spark, sf_dir), AS_OF)
    return tidy(found["forecast"], 4)
