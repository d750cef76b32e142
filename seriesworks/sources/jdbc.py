"""JDBC sources: option building and partitioned reads."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

_BACKENDS = {
    "sqlite": ("jdbc:sqlite:{database}", "org.sqlite.JDBC", None),
    "mysql": ("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver", 3306),
    "postgresql": ("jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver", 5432),
    "impala": ("jdbc:hive2://{host}:{port}/{database}", "org.apache.hive.jdbc.HiveDriver", 21050),
    # speaks the MySQL wire protocol
    "starrocks": ("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver", 9030),
}


def jdbc_options(
    backend: str,
    database: str,
    host: str = "localhost",
    port: int | None = None,
    user: str | None = None,
    password: str | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``."""
    if backend not in _BACKENDS:
        raise ValueError(f"unsupported database type: {backend}")
    url, driver, default_port = _BACKENDS[backend]
    options = {
        "url": url.format(host=host, port=port or default_port, database=database),
        "driver": driver,
        "fetchsize": str(fetch_size),
    }
    if backend == "impala" and not user:
        options["url"] += ";auth=noSasl"
    if user:
        options["user"] = user
    if password:
        options["password"] = password
    return options


def date_predicates(column: str, start: date, end: date, parts: int) -> list[str]:
    """Disjoint inclusive date ranges that together cover [start, end]."""
    days = (end - start).days + 1
    if days <= 0 or parts <= 0:
        raise ValueError("need start <= end and parts >= 1")
    parts = min(parts, days)
    edges = [start + timedelta(days=days * i // parts) for i in range(parts + 1)]
    return [f"{column} >= DATE '{a}' AND {column} < DATE '{b}'" for a, b in zip(edges, edges[1:])]


def read_jdbc(
    spark: SparkSession, options: dict[str, str], table: str, predicates: list[str] | None = None
) -> DataFrame:
    """Read a table; each predicate becomes one partition read in parallel."""
    if predicates:
        rest = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], table, predicates=predicates, properties=rest)
    return spark.read.format("jdbc").options(**options, dbtable=table).load()


def write_jdbc(df: DataFrame, options: dict[str, str], table: str) -> None:
    """Replace the contents of a table."""
    df.write.format("jdbc").options(**options, dbtable=table).mode("overwrite").save()
