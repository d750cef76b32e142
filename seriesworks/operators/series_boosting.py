"""Boosted trees for every series of a panel, all of them grown in the same passes.

A pass sums residuals and rows by series, node, feature and bin: partial sums in the
tasks, added up as vectors by Spark.  The best split of each node is chosen where its
sums are, so nothing of a series reaches the driver, and the number of passes is that of
the longest training, whatever the number of series.  Trees are rows.  Rows find their
leaf by a join on the series and an expression.

A tree is measured level by level down to ``max_depth``.  Of its splits the
``num_leaves - 1`` are kept that best-first growth would make: those with the largest
smallest gain on their way from the root.  A series leaves the job when its valid rows
have not improved for ``early_stopping_rounds`` rounds; its best round counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators.boosting import _arguments, _in_bag, best_split, bin_rows
from seriesworks.session import application_folder, cut_lineage, release

#: Bins of a feature within a series, bin 0 for missing values; a series has some thousand days.
MAX_BINS = 32
#: Depth of the trees where ``max_depth`` sets none.
DEPTH = 5
#: Rows that a task sums at a time: each may be in a node of its own.
SLICE = 1024
FOUND = "sid long, node int, feature int, bin int, gain double, g double, n long, left_g double, left_n long"
NODES = "sid long, node int, feature int, bin int, gain double, value double, rows long"


@dataclass
class SeriesTrees:
    """Fitted models as two tables.

    ``nodes``: keys, tree, node (the root is 1, children of n are 2n and 2n + 1), feature,
    threshold, gain, value, rows.  ``series``: keys, base, rounds (trees that count).
    """

    keys: list[str]
    features: list[str]
    nodes: DataFrame
    series: DataFrame
    depth: int

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``predicted``; rows of a series without a model, or with a NULL key, get NULL."""
        place = F.create_map(*[F.lit(v) for i, f in enumerate(self.features) for v in (f, i)])
        entry = F.struct(F.element_at(place, F.col("feature")).alias("feature"), "threshold", "value")
        heaps = self.nodes.groupBy(*self.keys, "tree").agg(_heap(entry, self.depth).alias("_heap"))
        trees = heaps.groupBy(*self.keys).agg(F.sort_array(F.collect_list(F.struct("tree", "_heap"))).alias("_trees"))
        models = self.series.select(*self.keys, "base").join(trees, self.keys, "left")
        x = F.array(*[F.col(f).cast("double") for f in self.features])

        def right(s: Column) -> Column:
            v = F.get("_x", s["feature"])
            return v.isNotNull() & ~F.isnan(v) & (v > s["threshold"])

        def add(total: Column, tree: Column) -> Column:
            return total + F.get(tree["_heap"], _leaf(tree["_heap"], self.depth, right))["value"]

        none = F.expr("array()").cast(trees.schema["_trees"].dataType)
        predicted = F.aggregate(F.coalesce("_trees", none), F.col("base"), add)
        joined = df.withColumn("_x", x).join(models, self.keys, "left")
        return joined.withColumn("predicted", predicted).select(*df.columns, "predicted")


def _heap(entry: Column, depth: int) -> Column:
    """Aggregate: the entries of a tree by node number, NULL where it has no node."""
    found = F.map_from_entries(F.collect_list(F.struct("node", entry.alias("entry"))))
    return F.transform(F.sequence(F.lit(0), F.lit(2 ** (depth + 1) - 1)), lambda i: F.try_element_at(found, i))


def _leaf(heap: Column, depth: int, right) -> Column:
    """Number of the node that a row ends in, at most ``depth`` steps from the root."""

    def step(n: Column, _: Column) -> Column:
        s = F.get(heap, n)
        return F.when(s["feature"].isNull(), n).otherwise(2 * n + F.when(right(s), 1).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), step)


def _bin_right(s: Column) -> Column:
    return F.get("x", s["feature"]) > s["bin"]


def series_edges(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Upper ends of a feature's bins: all distinct values but the last, or quantiles where there are more."""
    known = values[~np.isnan(values)]
    distinct = np.unique(known)
    if len(distinct) < max_bins:
        return distinct[:-1]
    return np.unique(np.quantile(known, np.arange(1, max_bins) / (max_bins - 1), method="inverted_cdf"))[:-1]


def _binned(width: int, max_bins: int):
    """A series' rows -> bins, target, first prediction; the bins' ends on its first row."""

    def run(table: pa.Table) -> pa.Table:
        x = np.column_stack([table[f"x{i}"].to_numpy() for i in range(width)]).astype(float)
        y, valid = table["y"].to_numpy(), table["valid"].to_numpy().astype(bool)
        if valid.all():
            table, x, y, valid = table.slice(0, 0), x[:0], y[:0], valid[:0]
        edges = [series_edges(x[~valid, i], max_bins) for i in range(width)]
        rows = len(y)
        cells = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), pa.array(bin_rows(x, edges).astype(np.int8).ravel(), pa.int8()))
        ends = pa.array([[e.tolist() for e in edges]] + [None] * (rows - 1) if rows else [], pa.list_(pa.list_(pa.float64())))
        base = np.full(rows, y[~valid].mean() if rows else 0.0)
        names = ["sid", "x", "y", "pred", "valid", "h", "edges"]
        return pa.Table.from_arrays([table["sid"], cells, pa.array(y), pa.array(base), pa.array(valid), table["h"], ends], names=names)

    return run


def _partial(width: int, max_bins: int, bag: tuple[int, float]):
    """Rows -> for each series and node in a slice the sums of residuals and rows by feature and bin."""
    size = width * max_bins
    offset = (np.arange(width) * max_bins)[None, :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                b = whole.slice(lo, SLICE)
                b = b.filter(pa.array(_in_bag(b["h"].to_numpy(), *bag)))
                if not b.num_rows:
                    continue
                bins = b["x"].flatten().to_numpy().astype(np.int64).reshape(-1, width)
                pairs = np.column_stack([b["sid"].to_numpy(), b["node"].to_numpy().astype(np.int64)])
                own, group = np.unique(pairs, axis=0, return_inverse=True)
                slot = (group.reshape(-1, 1) * size + offset + bins).ravel()
                cells = len(own) * size
                sums = np.bincount(slot, weights=np.repeat(b["r"].to_numpy(), width), minlength=cells).reshape(-1, size)
                rows = np.bincount(slot, minlength=cells).reshape(-1, size)
                values = pa.array(np.hstack([sums, rows]).ravel(), pa.float64())
                cut = pa.array(np.arange(len(own) + 1) * 2 * size, pa.int32())
                columns = [pa.array(own[:, 0]), pa.array(own[:, 1], pa.int32()), pa.ListArray.from_arrays(cut, values)]
                yield pa.RecordBatch.from_arrays(columns, names=["sid", "node", "v"])

    return run


def _choose(width: int, max_bins: int, used: np.ndarray, p: dict):
    """Sums of nodes -> the best split of each; nodes without one are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, (sid, node) in enumerate(zip(b["sid"].to_pylist(), b["node"].to_pylist())):
                sums, rows = b["v"][i].values.to_numpy().reshape(2, width, max_bins)
                split = best_split(sums, rows, used, p)
                if split is not None:
                    gain, f, at = split
                    out.append((sid, node, f, at, gain, sums[0].sum(), int(rows[0].sum()), sums[f, : at + 1].sum(), int(rows[f, : at + 1].sum())))
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.int64()]
            columns = list(zip(*out)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in FOUND.split(", ")])

    return run


def _grow(state: DataFrame, width: int, max_bins: int, depth: int, used: np.ndarray, bag: tuple[int, float], p: dict, path: str) -> DataFrame:
    """The nodes of one more tree of each series, written to ``path``."""
    train = state.where("NOT valid").withColumn("r", F.col("y") - F.col("pred"))
    least, levels = 2 * max(1, int(p["min_data_in_leaf"])), []
    for level in range(depth):
        if not levels:
            rows = train.withColumn("node", F.lit(1))
        else:
            enough = (F.col("left_n") >= least).alias("left_open"), (F.col("n") - F.col("left_n") >= least).alias("right_open")
            made = reduce(DataFrame.unionByName, levels).groupBy("sid").agg(_heap(F.struct("feature", "bin", *enough), depth).alias("heap"))
            rows = train.join(made, "sid").withColumn("node", _leaf(F.col("heap"), level, _bin_right))
            above = F.get("heap", F.floor(F.col("node") / 2).cast("int"))
            is_open = F.when(F.col("node") % 2 == 0, above["left_open"]).otherwise(above["right_open"])
            rows = rows.where((F.col("node") >= 2**level) & is_open)
        parts = rows.select("sid", "node", "x", "r", "h").mapInArrow(_partial(width, max_bins, bag), "sid long, node int, v array<double>")
        summed = parts.select("sid", "node", array_to_vector("v").alias("v")).groupBy("sid", "node").agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("v"))
        found = summed.mapInArrow(_choose(width, max_bins, used, p), FOUND)
        if not levels:
            found = found.withColumn("path", F.col("gain"))
        else:
            parent = levels[-1].select("sid", F.col("node").alias("_parent"), F.col("path").alias("_path"))
            found = found.withColumn("_parent", F.floor(F.col("node") / 2).cast("int")).join(parent, ["sid", "_parent"])
            found = found.withColumn("path", F.least("gain", "_path")).drop("_parent", "_path")
        levels.append(cut_lineage(found))
    # a series has fewer than 2 ** depth splits
    rank = F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("path"), "node"))
    kept = reduce(DataFrame.unionByName, levels).withColumn("_rank", rank).where(F.col("_rank") < int(p["num_leaves"])).drop("_rank")

    left = F.struct((2 * F.col("node")).alias("node"), F.col("left_g").alias("g"), F.col("left_n").alias("rows"))
    right = F.struct((2 * F.col("node") + 1).alias("node"), (F.col("g") - F.col("left_g")).alias("g"), (F.col("n") - F.col("left_n")).alias("rows"))
    ends = kept.select("sid", F.explode(F.array(left, right)).alias("c")).select("sid", "c.*").join(kept.select("sid", "node"), ["sid", "node"], "left_anti")
    shrunk = F.signum("g") * F.greatest(F.abs("g") - float(p["lambda_l1"]), F.lit(0.0))
    value = float(p["learning_rate"]) * shrunk / (F.col("rows") + float(p["lambda_l2"]))
    inner = kept.select("sid", "node", "feature", "bin", "gain", F.lit(None).cast("double").alias("value"), F.col("n").alias("rows"))
    leaves = ends.select("sid", "node", *[F.lit(None).cast(t).alias(c) for c, t in (("feature", "int"), ("bin", "int"), ("gain", "double"))], value.alias("value"), "rows")
    inner.unionByName(leaves).write.parquet(path)
    for table in levels:
        release(table)
    return state.sparkSession.read.schema(NODES).parquet(path)


def _errors(state: DataFrame, metric: str) -> DataFrame:
    """Each series' error on its valid rows; NULL without any."""
    miss = F.when(F.col("valid"), F.col("y") - F.col("pred"))
    error = F.avg(F.abs(miss)) if metric in ("l1", "mae") else F.sqrt(F.avg(miss * miss))
    return state.groupBy("sid").agg(error.alias("error"))


def fit_series_trees(
    df: DataFrame,
    features: Sequence[str],
    target: str = config.TARGET,
    params: dict | None = None,
    keys: Sequence[str] = config.KEYS,
    split: str = "split",
    max_bins: int = MAX_BINS,
) -> SeriesTrees:
    """Boosted trees of each series on its train rows, stopped by its valid rows.

    ``params`` are those of ``config.BOOSTING_PARAMS``; without a positive ``max_depth``
    trees are ``DEPTH`` deep.  Rows with a NULL key, without a target or with another
    ``split`` are left out, and so are series without train rows.  NULL and NaN features
    go left at every split.  A series whose rows no split improves has its mean as model.
    Without valid rows all rounds are run.
    """
    if max_bins > 127:
        raise ValueError("a bin is one signed byte: max_bins is 127 at most")
    p, keys, names, width = _arguments(params), list(keys), list(features), len(features)
    depth = int(p["max_depth"]) if int(p["max_depth"]) > 0 else DEPTH
    if depth > 10:
        raise ValueError("series trees are 10 deep at most")
    spark = df.sparkSession
    y = F.col(target).cast("double")
    rows = df.where(F.col(split).isin("train", "valid") & y.isNotNull() & ~F.isnan(y)).na.drop(subset=keys)
    plain = rows.select(
        *keys, *[F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, f in enumerate(names)],
        y.alias("y"), (F.col(split) == "valid").alias("valid"), F.xxhash64(*df.columns).alias("h"),
    )
    plain = cut_lineage(plain)
    ids = cut_lineage(plain.select(*keys).distinct().withColumn("sid", F.monotonically_increasing_id()))
    schema = "sid long, x array<tinyint>, y double, pred double, valid boolean, h long, edges array<array<double>>"
    written = cut_lineage(plain.join(ids, keys).drop(*keys).groupBy("sid").applyInArrow(_binned(width, max_bins), schema))
    release(plain)
    ends = cut_lineage(written.where("edges IS NOT NULL").select("sid", "edges", F.col("pred").alias("base")))
    state = cut_lineage(written.drop("edges"))
    release(written)

    patience, random, bag = int(p["early_stopping_rounds"]), np.random.default_rng(int(p["random_state"])), (0, 1.0)
    start = _errors(state, p["metric"]).select("sid", F.col("error").alias("best"), F.lit(0).alias("rounds"), F.lit(True).alias("active"))
    status = cut_lineage(start)
    folder = f"{application_folder(spark)}/{uuid.uuid4().hex}"
    spark.createDataFrame([], NODES).write.parquet(f"{folder}/tree=-1")  # so that there is a table without any tree
    for number in range(int(p["num_boost_round"])):
        going = status.where("active").select("sid")
        if going.isEmpty():
            break
        if int(p["bagging_freq"]) > 0 and number % int(p["bagging_freq"]) == 0:
            bag = (int(random.integers(1 << 62)), float(p["bagging_fraction"]))
        used = np.zeros(width, bool)
        used[random.permutation(width)[: max(1, round(width * float(p["feature_fraction"])))]] = True
        nodes = _grow(state.join(going, "sid", "left_semi"), width, max_bins, depth, used, bag, p, f"{folder}/tree={number}")
        made = nodes.groupBy("sid").agg(_heap(F.struct("feature", "bin", "value"), depth).alias("heap"))
        moved = state.join(made, "sid").withColumn("pred", F.col("pred") + F.get("heap", _leaf(F.col("heap"), depth, _bin_right))["value"])
        after = cut_lineage(moved.drop("heap").select(state.columns))
        release(state)
        state = after
        # series that got no tree are not among the rows any more
        seen = _errors(state, p["metric"]).withColumn("_seen", F.lit(True))
        better = F.col("_seen") & (F.col("error").isNull() | (F.col("error") < F.col("best")))
        rounds = F.when(better, number + 1).otherwise(F.col("rounds"))
        waits = F.lit(True) if patience <= 0 else (number + 1 - rounds) < patience
        following = status.join(seen, "sid", "left").select(
            "sid", F.when(better, F.col("error")).otherwise(F.col("best")).alias("best"), rounds.alias("rounds"),
            (F.coalesce("_seen", F.lit(False)) & waits).alias("active"),
        )
        after = cut_lineage(following)
        release(status)
        status = after
    release(state)
    series = cut_lineage(ids.join(ends, "sid").join(status, "sid").select(*keys, "sid", "base", "rounds", F.col("best").alias("valid_error")))
    names_of = F.array(*[F.lit(n) for n in names])
    threshold = F.when(F.col("bin") == 0, float("-inf")).otherwise(F.get(F.get("edges", F.col("feature")), F.col("bin") - 1))
    trees = spark.read.schema(f"{NODES}, tree int").parquet(folder).join(series.drop("base", "valid_error"), "sid").join(ends.drop("base"), "sid")
    table = trees.where(F.col("tree").between(0, F.col("rounds") - 1)).select(
        *keys, "tree", "node", F.get(names_of, F.col("feature")).alias("feature"), threshold.alias("threshold"), "gain", "value", "rows"
    )
    return SeriesTrees(keys, names, cut_lineage(table), series.drop("sid"), depth)
