import datetime as dt
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesworks.operators import features, increments, panel
from seriesworks.sources import sinks

FIRST, KEYS = dt.date(2020, 1, 1), ["drug_id", "hospital_id"]
SCHEMA = "drug_id string, hospital_id string, date date, sales_quantity double"


@pytest.fixture(scope="module")
def daily(spark):
    rng = np.random.default_rng(1)
    rows = [("a", "x", i) for i in range(300) if rng.random() < 0.6] + [("b", "x", i) for i in range(0, 300, 3)]
    rows += [("new", "x", i) for i in range(200, 300)] + [("short", "x", 180), ("gone", "x", 10), (None, "x", 299), ("pause", "y", 150), ("pause", "y", 290)]
    return spark.createDataFrame([(k, c, FIRST + dt.timedelta(days=i), 1000.0 + float(rng.integers(0, 90))) for k, c, i in rows], SCHEMA)


def before(df, n):
    return df.where(F.col("date") < F.lit(FIRST + dt.timedelta(days=n)))


def since(df, n):
    return df.where(F.col("date") >= F.lit(FIRST + dt.timedelta(days=n)))


def same(left, right, order):
    left, right = left.toPandas().sort_values(order, ignore_index=True), right.toPandas().sort_values(order, ignore_index=True)
    assert len(left) == len(right) > 0 and set(left.columns) == set(right.columns)
    for c in left.columns:
        if left[c].dtype.kind == "f":
            np.testing.assert_allclose(left[c], right[c], rtol=1e-9, atol=1e-6, err_msg=c)
        elif c == "tail":
            assert all(map(np.array_equal, left[c], right[c]))
        else:
            assert left[c].tolist() == right[c].tolist(), c


@pytest.mark.parametrize("cuts", [[220], [95, 151, 299]])
def test_days_in_steps_equal_a_full_rebuild(daily, cuts):
    full = features.build_features(panel.densify(daily.na.drop(subset=KEYS)))
    state, parts = increments.series_state(before(daily, cuts[0])), []
    for i, cut in enumerate(cuts):
        new = since(daily, cut) if i + 1 == len(cuts) else before(since(daily, cut), cuts[i + 1])
        parts.append(increments.new_features(state, new))
        state = increments.advance(state, new)
    same(state, increments.series_state(daily), KEYS)
    known = before(daily, cuts[0]).groupBy(*KEYS).agg(F.max("date").alias("_until"))
    wanted = full.join(known, KEYS, "left").where("_until IS NULL OR date > _until").drop("_until")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    same(found, wanted, [*KEYS, "date"])


def test_late_rows_and_odd_inputs(spark, daily):
    late = spark.createDataFrame([("gone", "x", FIRST + dt.timedelta(days=5), 7.0), ("gone", "x", FIRST + dt.timedelta(days=150), 9.0)], SCHEMA)
    old, new = before(daily, 250), since(daily, 250).unionByName(late)
    found, states = increments.increment(increments.series_state(old), new, daily.unionByName(late))
    same(states, increments.series_state(daily.unionByName(late)), KEYS)
    rebuilt = features.build_features(panel.densify(daily.unionByName(late).where("drug_id = 'gone'")))
    same(found.where("drug_id = 'gone'"), since(rebuilt, 5), [*KEYS, "date"])
    assert found.where("drug_id <> 'gone'").count() == increments.new_features(increments.series_state(old), since(daily, 250)).count()
    state = increments.series_state(old)
    assert increments.new_features(state, daily.limit(0)).count() == 0
    same(increments.advance(state, daily.limit(0)), state, KEYS)
    assert increments.series_state(daily.limit(0)).count() == 0


def test_bucketed_states_are_not_shuffled(spark, daily, tmp_path):
    name = f"t{uuid.uuid4().hex}"
    sinks.write_bucketed(increments.series_state(before(daily, 250)), name, KEYS, 8, path=str(tmp_path / "states"))
    plan = increments.new_features(spark.table(name), since(daily, 250))._jdf.queryExecution().executedPlan().toString()
    # one exchange: the new rows to the buckets of the states
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, plan
    lone = spark.table(name).groupBy(*KEYS).count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in lone
    spark.sql(f"DROP TABLE {name}")


def test_one_snapshot_is_replaced(spark, daily, tmp_path):
    name = f"t{uuid.uuid4().hex}"
    rows = daily.na.drop(subset=KEYS).withColumn("snapshot", F.date_format("date", "yyyy-MM"))
    sinks.write_bucketed(rows, name, KEYS, 4, ["snapshot"], path=str(tmp_path / "daily"))
    sinks.replace_partitions(rows.where("snapshot = '2020-03'").limit(1).withColumn("sales_quantity", F.lit(-1.0)), name, KEYS, 4)
    got = {r.snapshot: r.n for r in spark.table(name).groupBy("snapshot").agg(F.count("*").alias("n")).collect()}
    want = {r.snapshot: r.n for r in rows.groupBy("snapshot").agg(F.count("*").alias("n")).collect()}
    assert got == want | {"2020-03": 1}
    spark.sql(f"DROP TABLE {name}")
