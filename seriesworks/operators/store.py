"""Feature tables: point-in-time joins, latest values, materialisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators.ranks import RANGE, with_range
from seriesworks.session import cut_lineage


def _known_at(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    ttl_days: float,
    entity_ts: str,
    feature_ts: str,
    order_by: Sequence[str],
    ranges: int | None,
) -> DataFrame:
    """(keys, _ts, _p): the feature values known at each distinct requested key and time."""
    payload = F.struct(*[F.col(c) for c in [*order_by, *[f for f in fields if f not in order_by]]])
    known = (
        features.select(*keys, F.col(feature_ts).cast("timestamp").alias("_ts"), payload.alias("_p"))
        .where(F.col("_ts").isNotNull())
        .groupBy(*keys, "_ts")
        .agg(F.max("_p").alias("_p"))
    )
    # equal requests are looked up once
    asked = entities.select(*keys, F.col(entity_ts).cast("timestamp").alias("_ts")).distinct()
    events = known.withColumn("_ask", F.lit(False)).unionByName(
        asked.withColumn("_ask", F.lit(True)), allowMissingColumns=True
    )
    events = events.withColumn("_hit", F.when(F.col("_p").isNotNull(), F.struct("_ts", "_p"))).drop("_p")
    on = list(keys)
    if ranges != 1:
        # written once: the cut points and both branches below read it
        events = cut_lineage(events.withColumn("_t", F.unix_micros("_ts").cast("double")))
        events = with_range(events, "_t", ranges)
        on = [*keys, RANGE]
    w = Window.partitionBy(*on).orderBy("_ts", "_ask").rowsBetween(Window.unboundedPreceding, 0)
    found = events.withColumn("_hit", F.last("_hit", ignorenulls=True).over(w)).where("_ask")
    if ranges != 1:
        hit_ts = F.when(F.col("_hit").isNotNull(), F.col("_ts"))
        per_range = events.groupBy(*on).agg(F.max_by("_hit", hit_ts).alias("_hit"))
        before = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        carried = per_range.select(*on, F.last("_hit", ignorenulls=True).over(before).alias("_carried"))
        # rows with a NULL key find nothing, here and below
        found = found.join(carried, on, "left").withColumn("_hit", F.coalesce("_hit", "_carried"))
    oldest = F.col("_ts") - F.make_dt_interval(secs=F.lit(float(ttl_days) * 86400.0))
    fresh = F.when(F.col("_hit._ts") >= oldest, F.col("_hit._p"))
    return found.select(*keys, "_ts", fresh.alias("_p"))


def pit_join(
    entities: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    ttl_days: float,
    entity_ts: str = "event_timestamp",
    feature_ts: str = "event_timestamp",
    order_by: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """For each entity row the latest feature row at or before it, not older than the ttl.

    Of several feature rows with one timestamp the greatest by ``order_by`` (then by
    the fields) counts.  Unmatched rows get NULLs.

    The time axis is cut into ranges, so that one key with very many rows is worked
    on by many tasks: inside a (key, range) a running ``last`` finds the match, and a
    small table with the last feature row of each (key, range) carries values over
    range borders.  ``ranges=1`` skips this for daily panels, whose keys are bounded
    by the number of days.
    """
    found = _known_at(entities, features, list(keys), fields, ttl_days, entity_ts, feature_ts, order_by, ranges)
    return _attach(entities, found, keys, fields, entity_ts)


def _attach(entities: DataFrame, found: DataFrame, keys: Sequence[str], fields: Sequence[str], entity_ts: str) -> DataFrame:
    renamed = found.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_ts").alias("_k_ts"), F.col("_p").alias("_found")
    )
    condition = F.col(entity_ts).cast("timestamp") == F.col("_k_ts")
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_k_{k}"))
    joined = entities.join(renamed, condition, "left")
    return joined.select(*entities.columns, *[F.col(f"_found.{f}").alias(f) for f in fields])


def latest_rows(
    features: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    timestamp: str = "event_timestamp",
    start: str | None = None,
    end: str | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Latest row per key inside [start, end]; the table behind online lookups."""
    at = F.col(timestamp)
    if start is not None:
        features = features.where(at >= F.lit(start).cast("timestamp"))
    if end is not None:
        features = features.where(at <= F.lit(end).cast("timestamp"))
    row = F.struct(F.col(timestamp), *[F.col(f) for f in fields])
    order = F.struct(at, *[F.col(c) for c in order_by])
    return (
        features.groupBy(*keys)
        .agg(F.max_by(row, order).alias("_row"))
        .select(*keys, f"_row.{timestamp}", *[f"_row.{f}" for f in fields])
    )


def lookup(requests: DataFrame, latest: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Latest features for each request row; unknown keys get NULLs."""
    return requests.join(latest.select(*keys, *fields), list(keys), "left")


def parse_refs(refs: Sequence[str]) -> dict[str, list[str]]:
    """``["view:feature", ...]`` to features per view."""
    views: dict[str, list[str]] = {}
    for ref in refs:
        view, colon, feature = ref.partition(":")
        if not (view and colon and feature):
            raise ValueError(f"not a view:feature reference: {ref!r}")
        views.setdefault(view, []).append(feature)
    return views


def _view(name: str, views: dict) -> dict:
    if name not in views:
        raise ValueError(f"unknown feature view: {name}")
    return views[name]


def historical_features(
    entities: DataFrame,
    tables: dict[str, DataFrame],
    refs: Sequence[str],
    entity_ts: str = "event_timestamp",
    views: dict = config.FEATURE_VIEWS,
    ranges: int | None = None,
    daily: Sequence[str] = (),
) -> DataFrame:
    """Point-in-time values of features from several views, each with its keys and ttl.

    The views named ``daily`` have one row per key and day and are not cut into ranges.
    """
    result = entities
    for name, fields in parse_refs(refs).items():
        view = _view(name, views)
        # every view is looked up from the plain entity rows, not from earlier results
        found = _known_at(
            entities, tables[name], view["keys"], fields, view["ttl_days"], entity_ts, view["timestamp"], (), 1 if name in daily else ranges
        )
        result = _attach(result, found, view["keys"], fields, entity_ts)
    return result


def materialize(
    table: DataFrame, name: str, start: str, end: str, views: dict = config.FEATURE_VIEWS
) -> DataFrame:
    """Latest row per key of a view inside [start, end], with the view's column types."""
    view = _view(name, views)
    latest = latest_rows(table, view["keys"], list(view["fields"]), view["timestamp"], start, end)
    return latest.select(
        *view["keys"], view["timestamp"], *[F.col(f).cast(t).alias(f) for f, t in view["fields"].items()]
    )


def online_features(
    requests: DataFrame, materialized: dict[str, DataFrame], refs: Sequence[str], views: dict = config.FEATURE_VIEWS
) -> DataFrame:
    for name, fields in parse_refs(refs).items():
        requests = lookup(requests, materialized[name], _view(name, views)["keys"], fields)
    return requests


def list_views(spark: SparkSession, views: dict = config.FEATURE_VIEWS) -> DataFrame:
    rows = [(n, v["keys"], v["timestamp"], v["ttl_days"], list(v["fields"])) for n, v in views.items()]
    return spark.createDataFrame(
        rows, "view string, keys array<string>, timestamp_column string, ttl_days int, features array<string>"
    )


def prepare_for_store(
    df: DataFrame, product: str = "gcode", customer: str = "cust_name", timestamp: str = "create_dt"
) -> DataFrame:
    """Standard key and timestamp names and types; a missing column is an error."""
    missing = [c for c in (product, customer, timestamp) if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    renamed = df.withColumnsRenamed({product: "gcode", customer: "cust_name", timestamp: "event_timestamp"})
    return renamed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
