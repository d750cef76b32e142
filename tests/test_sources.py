import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators import profile
from seriesworks.sources import jdbc, sinks, tables


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        (g, c, dt.date(2020, 1, d), float(d), dt.date(2020, 2, s))
        for g in ("01", "02")
        for c in ("x", "y")
        for d in range(1, 6)
        for s in (1, 2)
    ]
    return spark.createDataFrame(rows, "gcode string, cust_name string, create_dt date, qty double, dt date")


COLUMNS = ["gcode", "cust_name", "create_dt", "qty"]


def test_scan_filters(sales):
    got = tables.scan_sales(sales, "01", "x", "2020-01-02", "2020-01-04", "2020-02-01", columns=COLUMNS)
    assert sorted(r.qty for r in got.collect()) == [2.0, 3.0, 4.0] and got.columns == COLUMNS
    first = tables.scan_sales(sales, snapshot="2020-02-01", columns=COLUMNS, limit=3).collect()
    assert [(r.gcode, r.cust_name, r.qty) for r in first] == [("01", "x", 1.0), ("01", "y", 1.0), ("02", "x", 1.0)]
    with pytest.raises(ValueError):
        tables.scan_sales(sales)


def test_scan_defaults(sales):
    got = tables.scan_sales(sales, as_of=dt.date(2020, 2, 2), previous_day_snapshot=True, columns=COLUMNS)
    assert got.count() == 20
    assert tables.scan_sales(sales, as_of=dt.date(2020, 2, 2), previous_day_snapshot=True, snapshot="2020-02-05", columns=COLUMNS).count() == 0
    assert tables.scan_sales(sales, as_of=dt.date(2025, 1, 3), last_five_years=True, columns=COLUMNS).count() == 8
    assert tables.scan_sales(sales, as_of=dt.date(2025, 1, 3), last_five_years=True, start="2020-01-01", columns=COLUMNS).count() == 40


def test_scan_batch(spark, sales):
    lists = tables.scan_batch(sales, ["01"], ["x", "y"], "2020-01-05", columns=COLUMNS, ordered=True)
    assert [(r.gcode, r.cust_name) for r in lists.collect()] == [("01", "x")] * 2 + [("01", "y")] * 2
    many = [f"{i:05d}" for i in range(2000)] + ["02"]
    assert tables.scan_batch(sales, many, columns=COLUMNS).count() == 20
    keys = spark.createDataFrame([("01",), ("01",)], "gcode string")
    assert tables.scan_batch(sales, keys, columns=COLUMNS).count() == 20


def test_scan_pushes_filters_and_prunes(spark, sales, tmp_path):
    sinks.write_parquet(sales, str(tmp_path / "s"), partition_by=["dt"])
    stored = spark.read.parquet(str(tmp_path / "s"))
    df = tables.scan_sales(stored, product="01", snapshot="2020-02-01", columns=["gcode", "qty"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gcode,01)" in plan and "PartitionFilters: [isnotnull(dt" in plan
    assert "ReadSchema: struct<gcode:string,qty:double>" in plan
    assert df.count() == 10


def test_dimension_scan(spark):
    df = spark.createDataFrame([("h1", "n", "r"), ("h2", "m", "r")], "hospital_id string, hospital_name string, region string")
    assert tables.scan_dimension(df, "hospital_id", "h2").first().hospital_name == "m"
    assert tables.scan_dimension(df, "hospital_id", columns=["region"]).columns == ["region"]
    assert len(config.PRODUCT_COLUMNS) == 60 and len(config.SALES_COLUMNS) == 21


def test_csv_dates_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("gcode,date,prod_dt,qty\n0012,2020-01-01,2019-05-06,1.5\n0013,2020-01-02,unknown,2\n")
    df = tables.read_csv(spark, str(path))
    kinds = dict(df.dtypes)
    assert kinds == {"gcode": "string", "date": "timestamp", "prod_dt": "string", "qty": "double"}
    assert {r.gcode for r in df.collect()} == {"0012", "0013"}
    given = tables.read_csv(spark, str(path), schema="gcode string, date string, prod_dt string, qty double")
    assert dict(given.dtypes)["date"] == "timestamp" and dict(given.dtypes)["prod_dt"] == "string"


def test_sinks_round_trip(spark, sales, tmp_path):
    sinks.write_csv(sales.select("gcode", "qty"), str(tmp_path / "c"))
    assert tables.read_csv(spark, str(tmp_path / "c")).count() == 40
    sinks.write_table(sales, "sales_copy")
    sinks.write_table(sales.limit(3), "sales_copy")
    assert spark.table("sales_copy").count() == 3
    listed = tables.describe_table(spark, "sales_copy").collect()
    assert [r.column_name for r in listed] == sales.columns and listed[0].database == "default"
    spark.sql("DROP TABLE sales_copy")


def test_introspection(sales):
    got = {r.column_name: r for r in tables.check_columns(sales, ["gcode", "cust", "price"]).collect()}
    assert got["gcode"].present and got["cust"].suggestions == ["cust_name"] and got["price"].suggestions == []
    described = tables.describe_columns(sales).collect()
    assert [(r.position, r.data_type) for r in described][:2] == [(1, "string"), (2, "string")]
    report = {r.column_name: r for r in tables.column_report(sales).collect()}
    assert report["qty"].data_type == "double" and report["qty"].missing == 0


def test_bound_sql(spark, sales):
    df = tables.run_sql(spark, "SELECT count(*) AS n FROM {s} WHERE gcode = :g", {"g": "01' OR '1'='1"}, s=sales)
    assert df.first().n == 0


@pytest.mark.parametrize(
    "backend, url",
    [
        ("sqlite", "jdbc:sqlite:d"),
        ("mysql", "jdbc:mysql://h:3306/d"),
        ("postgresql", "jdbc:postgresql://h:5432/d"),
        ("impala", "jdbc:hive2://h:21050/d;auth=noSasl"),
        ("starrocks", "jdbc:mysql://h:9030/d"),
    ],
)
def test_jdbc_options(backend, url):
    options = jdbc.jdbc_options(backend, "d", "h")
    assert options["url"] == url and "password" not in options
    assert jdbc.jdbc_options(backend, "d", "h", 1, "u", "p")["user"] == "u"


def test_jdbc_unknown_and_predicates():
    with pytest.raises(ValueError):
        jdbc.jdbc_options("oracle", "d")
    parts = jdbc.date_predicates("create_dt", dt.date(2020, 1, 1), dt.date(2020, 1, 10), 3)
    assert len(parts) == 3 and "2020-01-01" in parts[0] and "< DATE '2020-01-11'" in parts[-1]
    assert parts[0].split("< ")[1] == parts[1].split(">= ")[1].split(" AND")[0]
    assert len(jdbc.date_predicates("d", dt.date(2020, 1, 1), dt.date(2020, 1, 2), 9)) == 2
    with pytest.raises(ValueError):
        jdbc.date_predicates("d", dt.date(2020, 1, 2), dt.date(2020, 1, 1), 1)


def test_profile_small_cases(spark, sales):
    one = sales.where("dt = '2020-02-01'")
    assert profile.date_range(one, "none").first().min_date is None
    assert profile.largest_group(one, ["cust_name"]).first().cust_name == "x"
    assert [r.dt.day for r in profile.snapshot_counts(sales).collect()] == [2, 1]
    status = profile.series_status(one, ["gcode", "cust_name"], 6).collect()
    assert {r.status for r in status} == {"skipped"} and status[0].message == "not enough data points (5 < 6)"
    keys = spark.createDataFrame([("a", 1), (" ", 2), ("None", 3), (None, 4)], "k string, n int")
    assert profile.keep_valid_keys(keys, ["k"]).count() == 1
    assert profile.combination_coverage(one, ["gcode", "cust_name"]).first().missing == 0
    old = one.withColumn("create_dt", F.lit("1810-03-01").cast("date"))
    assert profile.stale_dates(old).first().is_stale
    ties = profile.top_customers_per_product(one, 1).collect()
    assert [(r.gcode, r.cust_name) for r in sorted(ties)] == [("01", "x"), ("02", "x")]


def test_auto_select_skips_invalid(spark):
    rows = [("p", "x")] * 5 + [("p", None)] * 9 + [("q", "x")] * 2 + [("None", "x")] * 50
    df = spark.createDataFrame(rows, "gcode string, cust_name string")
    got = profile.auto_select(df, min_records=3, top_products=5, top_customers=2).collect()
    assert [(r.gcode, r.cust_name, r.record_count, r.total_records) for r in got] == [("p", "x", 5, 14)]
