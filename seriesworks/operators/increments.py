"""Features of new days from a small state of each series, without its history.

Lags, windows and differences look back a bounded number of days; running sums, means
and deviations go on from stored moments.  A state row has both, so a day's features cost
a join of the day's rows with one row a series.  Kept in a table bucketed by the series
(see ``sinks.write_bucketed``) the states are joined and their windows computed without
another shuffle of them.

Rows at or before a series' last day are late: its windows have to be computed anew from
the history (:func:`increment` does so).  Inputs are daily totals (``panel.daily_totals``):
one row a series and day, no NULL quantity.  Rows with a NULL key belong to no series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators import features, panel
from seriesworks.operators.panel import so_far, whole_series

#: Days that the longest lag, window or difference needs, the current one included.
LOOK_BACK = max(*config.LAGS, *config.DIFF_PERIODS, *config.WINDOWS) + 1
NO_DAY = "0001-01-01"
POINTS = "array<struct<d: date, y: double>>"


def series_state(
    daily: DataFrame, keys: Sequence[str] = config.KEYS, date: str = config.DATE, target: str = config.TARGET, keep: int = LOOK_BACK
) -> DataFrame:
    """(keys, last_date, n, total, mean, m2, tail): moments of the dense series and its last ``keep`` values."""
    y = F.col(target).cast("double")
    dense = panel.densify(daily.na.drop(subset=list(keys)), keys, date, target)
    last = F.max(date).over(whole_series(keys, date))
    recent = F.when(F.col(date) > F.date_sub(last, keep), F.struct(F.col(date).alias("d"), y.alias("y")))
    return dense.withColumn("_recent", recent).groupBy(*keys).agg(
        F.max(date).alias("last_date"), F.count(F.lit(1)).alias("n"), F.sum(y).alias("total"), F.avg(y).alias("mean"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("m2"),
        F.transform(F.sort_array(F.collect_list("_recent")), lambda p: p["y"]).alias("tail"),
    )


def _with_new_days(state: DataFrame, new: DataFrame, keys: Sequence[str], date: str, target: str, how: str) -> DataFrame:
    """State rows with ``days``: the days after the last one up to the last new row, gaps filled with the last value."""
    point = F.struct(F.col(date).cast("date").alias("d"), F.col(target).cast("double").alias("y"))
    grouped = new.na.drop(subset=list(keys)).groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("_new"))
    joined = grouped.join(state, list(keys), how)
    none = F.expr("array()").cast(POINTS)
    fresh = F.filter(F.coalesce("_new", none), lambda p: F.col("last_date").isNull() | (p["d"] > F.col("last_date")))
    before = F.when(F.col("last_date").isNull(), none).otherwise(F.array(F.struct(F.col("last_date").alias("d"), F.try_element_at("tail", F.lit(-1)).alias("y"))))
    joined = joined.withColumn("_points", F.concat(before, fresh))

    def stretch(p: Column, i: Column) -> Column:
        following = F.get("_points", i + 1)["d"]
        until = F.coalesce(F.greatest(F.date_sub(following, 1), p["d"]), p["d"])
        return F.transform(F.sequence(p["d"], until), lambda d: F.struct(d.alias("d"), p["y"].alias("y")))

    days = F.filter(F.flatten(F.transform("_points", stretch)), lambda p: F.col("last_date").isNull() | (p["d"] > F.col("last_date")))
    return joined.withColumn("days", days).drop("_new", "_points")


def advance(
    state: DataFrame, new: DataFrame, keys: Sequence[str] = config.KEYS, date: str = config.DATE, target: str = config.TARGET, keep: int = LOOK_BACK
) -> DataFrame:
    """The states after the new days; series without new rows keep theirs, late rows change nothing."""
    rows = _with_new_days(state, new, keys, date, target, "full")
    values = F.transform("days", lambda p: p["y"])

    def total(f) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, y: a + f(y))

    # own columns first: inside a lambda a name would mean the new column of that name
    rows = rows.withColumns({"_shift": F.coalesce("mean", F.get(values, 0)), "_n": F.coalesce("n", F.lit(0)) + F.size("days")})
    rows = rows.withColumns({
        "_sum": total(lambda y: y), "_d": total(lambda y: y - F.col("_shift")),
        "_dd": total(lambda y: (y - F.col("_shift")) * (y - F.col("_shift"))),
    })
    tail = F.concat(F.coalesce("tail", F.expr("array()").cast("array<double>")), values)
    return rows.select(
        *keys, F.coalesce(F.try_element_at("days", F.lit(-1))["d"], "last_date").alias("last_date"), F.col("_n").cast("long").alias("n"),
        (F.coalesce("total", F.lit(0.0)) + F.col("_sum")).alias("total"), (F.col("_shift") + F.col("_d") / F.col("_n")).alias("mean"),
        (F.coalesce("m2", F.lit(0.0)) + F.col("_dd") - F.col("_d") * F.col("_d") / F.col("_n")).alias("m2"),
        F.slice(tail, F.greatest(F.size(tail) - keep + 1, F.lit(1)), keep).alias("tail"),
    )


def new_features(
    state: DataFrame, new: DataFrame, keys: Sequence[str] = config.KEYS, date: str = config.DATE, target: str = config.TARGET
) -> DataFrame:
    """The rows of ``build_features`` for the days after each series' last one; late rows are passed over."""
    keys = list(keys)
    rows = _with_new_days(state, new, keys, date, target, "left")
    size = F.size(F.coalesce("tail", F.expr("array()").cast("array<double>")))
    old = F.transform("tail", lambda y, i: F.struct(F.date_add("last_date", (i - size + 1).cast("int")).alias("d"), y.alias("y")))
    points = F.explode(F.concat(F.coalesce(old, F.expr("array()").cast(POINTS)), F.col("days"))).alias("_p")
    frame = rows.select(
        *keys, F.coalesce("last_date", F.lit(NO_DAY).cast("date")).alias("_last"), F.coalesce("n", F.lit(0)).alias("_n"),
        F.coalesce("total", F.lit(0.0)).alias("_total"), F.coalesce("mean", F.get("days", 0)["y"]).alias("_mean"), F.coalesce("m2", F.lit(0.0)).alias("_m2"), points,
    ).select(*keys, F.col("_p.d").alias(date), F.col("_p.y").alias(target), "_last", "_n", "_total", "_mean", "_m2")
    own = F.when(F.col(date) > F.col("_last"), F.col(target))
    off, past = own - F.col("_mean"), so_far(keys, date)
    sums = {"_k": F.count(own), "_s": F.sum(own), "_d": F.sum(off), "_dd": F.sum(off * off)}
    frame = frame.select("*", *[F.coalesce(e.over(past), F.lit(0)).alias(c) for c, e in sums.items()])
    built = features.build_features(frame, keys, date, target).where(F.col(date) > F.col("_last"))
    n = F.col("_n") + F.col("_k")
    m2 = F.col("_m2") + F.col("_dd") - F.col("_d") * F.col("_d") / n
    running = {
        f"{target}_cumsum": F.col("_total") + F.col("_s"),
        f"{target}_cummean": F.col("_mean") + F.col("_d") / n,
        f"{target}_cumstd": F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1)),
    }
    return built.withColumns(running).drop("_last", "_n", "_total", "_mean", "_m2", *sums)


def increment(
    state: DataFrame, new: DataFrame, history: DataFrame, keys: Sequence[str] = config.KEYS, date: str = config.DATE, target: str = config.TARGET
) -> tuple[DataFrame, DataFrame]:
    """(features, states) after new daily totals, as a full rebuild would have them.

    ``history`` holds all daily totals, the new ones included, each day once.  Series with
    late rows are computed from it; of their features the rows from the first late day on
    come, which replace the earlier ones.
    """
    keys = list(keys)
    late = new.join(state.select(*keys, "last_date"), keys).where(F.col(date) <= F.col("last_date")).groupBy(*keys).agg(F.min(date).alias("_from"))
    again = history.join(late.select(*keys), keys, "left_semi")
    rebuilt = features.build_features(panel.densify(again, keys, date, target), keys, date, target)
    rebuilt = rebuilt.join(late, keys).where(F.col(date) >= F.col("_from")).drop("_from")
    rebuilt = rebuilt.withColumn(target, F.col(target).cast("double"))
    in_time = new.join(late, keys, "left_anti")
    found = new_features(state, in_time, keys, date, target).unionByName(rebuilt)
    states = advance(state.join(late, keys, "left_anti"), in_time, keys, date, target)
    return found, states.unionByName(series_state(again, keys, date, target))
