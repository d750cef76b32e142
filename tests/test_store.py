import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesworks.operators import store

T0 = pd.Timestamp("2024-01-01")


def stamp(hours):
    return (T0 + pd.Timedelta(hours=float(hours))).to_pydatetime()


def tables(spark, entities, features):
    e = spark.createDataFrame([(i, k, stamp(h)) for i, (k, h) in enumerate(entities)], "id int, k string, event_timestamp timestamp")
    f = spark.createDataFrame([(k, stamp(h), v) for k, h, v in features], "k string, event_timestamp timestamp, v double")
    return e, f


def brute(entities, features, ttl_hours):
    out = {}
    for i, (k, h) in enumerate(entities):
        seen = [(fh, v) for fk, fh, v in features if k is not None and fk == k and fh <= h]
        best = max(seen) if seen else None
        out[i] = best[1] if best and best[0] >= h - ttl_hours else None
    return out


@pytest.mark.parametrize("ranges", [1, 3, None])
def test_pit_join_matches_brute_force(spark, ranges):
    rng = np.random.default_rng(7)
    keys = ["hot"] * 12 + ["b", "c", None]
    entities = [(keys[rng.integers(len(keys))], int(rng.integers(0, 300))) for _ in range(400)]
    features = [(keys[rng.integers(len(keys))], int(rng.integers(0, 300)), float(rng.integers(0, 1000))) for _ in range(300)]
    e, f = tables(spark, entities, features)
    got = store.pit_join(e, f, ["k"], ["v"], ttl_days=0.5, ranges=ranges)
    assert {r.id: r.v for r in got.collect()} == brute(entities, features, 12)
    assert got.columns == ["id", "k", "event_timestamp", "v"]


def test_pit_join_ttl_edge_and_tie(spark):
    e, f = tables(spark, [("a", 24), ("a", 25), ("z", 5)], [("a", 0, 1.0), ("a", 0, 2.0)])
    got = {r.id: r.v for r in store.pit_join(e, f, ["k"], ["v"], ttl_days=1).collect()}
    assert got == {0: 2.0, 1: None, 2: None}


def test_pit_join_never_looks_ahead(spark):
    e, f = tables(spark, [("a", h) for h in range(10)], [("a", h + 0.5, float(h)) for h in range(10)])
    got = {r.id: r.v for r in store.pit_join(e, f, ["k"], ["v"], ttl_days=9).collect()}
    assert got == {0: None} | {h: float(h - 1) for h in range(1, 10)}


VIEWS = {
    "pair": {"keys": ["g", "c"], "timestamp": "ts", "ttl_days": 2, "fields": {"p": "double"}},
    "single": {"keys": ["g"], "timestamp": "at", "ttl_days": 100, "fields": {"q": "string"}},
}


def test_historical_features_from_two_views(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    e = spark.createDataFrame([("a", "x", day(5)), ("a", "y", day(5))], "g string, c string, event_timestamp timestamp")
    pair = spark.createDataFrame([("a", "x", day(4), 1.5), ("a", "y", day(1), 9.0)], "g string, c string, ts timestamp, p double")
    single = spark.createDataFrame([("a", day(1), "old"), ("a", day(3), "new"), ("a", day(9), "late")], "g string, at timestamp, q string")
    got = store.historical_features(e, {"pair": pair, "single": single}, ["pair:p", "single:q"], views=VIEWS)
    assert {(r.c, r.p, r.q) for r in got.collect()} == {("x", 1.5, "new"), ("y", None, "new")}
    latest = {n: store.materialize(t, n, "2024-01-01", "2024-01-08", VIEWS) for n, t in (("pair", pair), ("single", single))}
    asked = spark.createDataFrame([("a", "x"), ("b", "x")], "g string, c string")
    online = store.online_features(asked, latest, ["pair:p", "single:q"], VIEWS)
    assert {(r.g, r.p, r.q) for r in online.collect()} == {("a", 1.5, "new"), ("b", None, None)}
    with pytest.raises(ValueError):
        store.historical_features(e, {}, ["nope:q"], views=VIEWS)


def test_refs_views_and_preparation(spark):
    assert store.parse_refs(["v:a", "w:b", "v:c"]) == {"v": ["a", "c"], "w": ["b"]}
    with pytest.raises(ValueError):
        store.parse_refs(["v"])
    listed = {r.view: r for r in store.list_views(spark).collect()}
    assert len(listed["sales_features"].features) == 12 and listed["drug_info_features"].ttl_days == 3650
    df = spark.createDataFrame([("a", "x", "2024-01-02")], "drug string, hospital string, day string")
    out = store.prepare_for_store(df, "drug", "hospital", "day")
    assert out.columns == ["gcode", "cust_name", "event_timestamp"] and dict(out.dtypes)["event_timestamp"] == "timestamp"
    with pytest.raises(ValueError):
        store.prepare_for_store(df)


def test_latest_rows_tie_and_range(spark):
    rows = [("a", stamp(1), 1, 10.0), ("a", stamp(2), 1, 20.0), ("a", stamp(2), 2, 30.0), ("b", stamp(9), 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, event_timestamp timestamp, id int, v double")
    got = store.latest_rows(df, ["k"], ["v"], order_by=["id"], end="2024-01-01 05:00:00")
    assert [(r.k, r.v) for r in got.collect()] == [("a", 30.0)]
    assert got.select(F.col("event_timestamp")).first()[0] == stamp(2)
