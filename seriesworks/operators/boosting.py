"""Histogram-based gradient boosting over a whole panel.

The matrix is binned once and written as one byte a feature.  Each pass over it sums the
residuals and rows of the open leaves by feature and bin: partial sums in the tasks, added
up as vectors by Spark.  Only these sums (leaves x features x bins, whatever the number of
rows) reach the driver, which chooses the splits.

A tree grows best-first up to ``num_leaves``.  The leaves that best-first order would
split next are all measured in one pass, of two children only the smaller one (the
other's sums are its parent's less those), so a tree takes about as many passes as it
is deep.  Every ``CARRIED`` trees the predictions so far are written with the rows; in
between the tasks add the latest trees themselves.  Training ends when the error on the
valid rows has not improved for ``early_stopping_rounds`` rounds; the best round counts.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesworks import config
from seriesworks.operators.encoding import category_table, encode_ordered, encode_with
from seriesworks.session import cut_lineage, release

#: Bins of a feature; bin 0 holds the missing values.
MAX_BINS = 64
#: Trees between two writes of the predictions.
CARRIED = 8
NODE_SCHEMA = (
    "tree int, node int, feature string, threshold double, left_node int, right_node int, gain double, value double, rows bigint"
)
OBJECTIVES = {"regression", "regression_l2", "l2", "rmse", "mse"}
METRICS = {"rmse", "l2", "mse", "l1", "mae"}


@dataclass
class Tree:
    """Nodes by position: feature (-1: leaf), bin, children, gain, value, rows."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    gain: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """Node that each row of bins ends in."""
        node = np.zeros(len(bins), np.int32)
        while True:
            feature = self.feature[node]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return node
            at = node[inner]
            go_left = bins[inner, feature[inner]] <= self.bin[at]
            node[inner] = np.where(go_left, self.left[at], self.right[at])


@dataclass
class BoostedTrees:
    """A fitted model: the trees up to the best round, all that were ``grown``, and how training went."""

    features: list[str]
    base: float
    edges: list[np.ndarray]
    trees: list[Tree]
    params: dict
    rounds: int = 0
    history: list[float] = field(default_factory=list)
    categories: dict[str, DataFrame] = field(default_factory=dict)
    prior: float = 0.0
    grown: list[Tree] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``predicted``; the columns of encoded categories are added too."""
        if self.categories:
            df = encode_with(df, self.categories, self.prior)
        edges, trees, base = self.edges, self.trees, self.base  # bounded by the parameters

        @F.pandas_udf("double")
        def predict(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in parts:
                bins = bin_rows(np.array(rows.to_list(), dtype=float).reshape(len(rows), len(edges)), edges)
                out = np.full(len(rows), base)
                for tree in trees:
                    out += tree.value[tree.leaf_of(bins)]
                yield pd.Series(out)

        missing = F.lit(float("nan"))
        return df.withColumn("predicted", predict(F.array(*[F.coalesce(F.col(f).cast("double"), missing) for f in self.features])))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The trees as a table: one row a node; leaves have a value and no feature."""
        rows = []
        for t, tree in enumerate(self.trees):
            for i, f in enumerate(tree.feature.tolist()):
                inner = f >= 0
                threshold = None
                if inner:
                    b, own = int(tree.bin[i]), self.edges[f]
                    threshold = float("-inf") if b == 0 else float(own[b - 1])
                rows.append(
                    (t, i, self.features[f] if inner else None, threshold, int(tree.left[i]) if inner else None, int(tree.right[i]) if inner else None,
                     float(tree.gain[i]) if inner else None, None if inner else float(tree.value[i]), int(tree.rows[i]))
                )
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def importance(self, spark: SparkSession, kind: str = "gain") -> DataFrame:
        """Importance per feature, largest first: summed gain, or number of splits; unused features have 0."""
        value = {"gain": F.sum("gain"), "split": F.count("gain").cast("double")}[kind]
        found = self.nodes(spark).where("feature IS NOT NULL").groupBy("feature").agg(value.alias("importance"))
        names = spark.createDataFrame([(f,) for f in self.features], "feature string")
        return names.join(found, "feature", "left").na.fill(0.0).orderBy(F.col("importance").desc(), "feature")


def bin_rows(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins of a matrix: 0 for NaN, otherwise 1 + the number of edges below the value."""
    out = np.empty(values.shape, np.uint8)
    for j, own in enumerate(edges):
        column = values[:, j]
        out[:, j] = np.where(np.isnan(column), 0, 1 + np.searchsorted(own, column, side="left"))
    return out


def bin_edges(train: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper ends of the bins: distinct quantiles of each feature, in one aggregation."""
    inner = max_bins - 1  # bin 0 is for missing values
    shares = [i / inner for i in range(1, inner + 1)]
    known = [F.when(~F.isnan(F.col(f)), F.col(f)) for f in features]
    row = train.agg(*[F.percentile_approx(k, shares, 10_000).alias(f"q{i}") for i, k in enumerate(known)]).first()
    return [np.unique(np.array(q or [], float))[:-1] for q in row]


def _arguments(params: dict | None) -> dict:
    p = config.BOOSTING_PARAMS | (params or {})
    if p["objective"] not in OBJECTIVES or p["metric"] not in METRICS or p["boosting_type"] != "gbdt":
        raise ValueError(f"objective {p['objective']}, metric {p['metric']}, boosting type {p['boosting_type']}: one is not supported")
    return p


def _shrunk(total: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(total) * np.maximum(np.abs(total) - l1, 0)


def best_split(sums: np.ndarray, rows: np.ndarray, used: np.ndarray, p: dict) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best split of a leaf: its rows up to the bin go left.

    ``sums`` and ``rows`` are features x bins.  Of equal gains the first feature and bin win.
    """
    l1, l2, least = p["lambda_l1"], p["lambda_l2"], max(1, int(p["min_data_in_leaf"]))
    g, n = sums[0].sum(), rows[0].sum()
    if n < 2 * least:
        return None
    left_g, left_n = np.cumsum(sums, axis=1)[:, :-1], np.cumsum(rows, axis=1)[:, :-1]
    right_g, right_n = g - left_g, n - left_n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _shrunk(left_g, l1) ** 2 / (left_n + l2) + _shrunk(right_g, l1) ** 2 / (right_n + l2) - _shrunk(g, l1) ** 2 / (n + l2)
    gain[(left_n < least) | (right_n < least) | ~used[:, None]] = -np.inf
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    # a gain within rounding of nothing is no gain
    if not gain[f, b] > max(float(p["min_gain_to_split"]), 1e-12 * max(1.0, float(g) ** 2 / max(float(n), 1.0))):
        return None
    return float(gain[f, b]), f, b


class _Growing:
    """A tree while it grows: what is known of each node."""

    def __init__(self, sums: np.ndarray, rows: np.ndarray, used: np.ndarray, p: dict):
        self.p, self.used = p, used
        self.feature, self.bin, self.left, self.right, self.depth = [-1], [0], [-1], [-1], [0]
        self.total, self.rows = [float(sums[0].sum())], [int(rows[0].sum())]
        self.sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.split: dict[int, tuple[float, int, int] | None] = {}
        self.learn(0, sums, rows)

    def learn(self, node: int, sums: np.ndarray, rows: np.ndarray) -> None:
        self.sums[node] = (sums, rows)
        deepest = int(self.p["max_depth"])
        deep = 0 < deepest <= self.depth[node]
        self.split[node] = None if deep else best_split(sums, rows, self.used, self.p)

    def children(self, node: int) -> tuple[int, int]:
        """The children by the node's best split; made when first asked for."""
        if self.left[node] < 0:
            _, f, b = self.split[node]
            sums, rows = self.sums[node]
            parts = (float(sums[f, : b + 1].sum()), int(rows[f, : b + 1].sum())), (float(sums[f, b + 1 :].sum()), int(rows[f, b + 1 :].sum()))
            self.feature[node], self.bin[node] = f, b
            self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
            for g, n in parts:
                self.feature.append(-1)
                self.bin.append(0)
                self.left.append(-1)
                self.right.append(-1)
                self.depth.append(self.depth[node] + 1)
                self.total.append(g)
                self.rows.append(n)
        return self.left[node], self.right[node]

    def best_first(self) -> tuple[list[int], list[int]]:
        """(nodes split, in order; those of them whose children must be measured to be sure of that order)."""
        open_leaves, picked, unsure = [], [], []

        def offer(node: int) -> None:
            if node not in self.split:
                return
            if self.split[node] is not None:
                heapq.heappush(open_leaves, (-self.split[node][0], node))

        offer(0)
        while open_leaves and len(picked) < int(self.p["num_leaves"]) - 1:
            node = heapq.heappop(open_leaves)[1]
            picked.append(node)
            left, right = self.children(node)
            if left in self.split:
                offer(left)
                offer(right)
            elif len(picked) < int(self.p["num_leaves"]) - 1:
                unsure.append(node)
        return picked, unsure

    def as_tree(self, picked: list[int]) -> Tree:
        """The tree of the picked splits, its nodes numbered anew; leaf values are shrunk by the learning rate."""
        chosen, number, order = set(picked), {0: 0}, [0]
        for node in order:
            if node in chosen:
                for child in (self.left[node], self.right[node]):
                    number[child] = len(order)
                    order.append(child)
        l1, l2, rate = self.p["lambda_l1"], self.p["lambda_l2"], self.p["learning_rate"]
        inner = np.array([n in chosen for n in order])
        value = [0.0 if n in chosen else rate * float(_shrunk(np.float64(self.total[n]), l1)) / max(self.rows[n] + l2, 1e-12) for n in order]
        return Tree(
            np.array([self.feature[n] if n in chosen else -1 for n in order], np.int32),
            np.array([self.bin[n] if n in chosen else 0 for n in order], np.int32),
            np.array([number[self.left[n]] if n in chosen else -1 for n in order], np.int32),
            np.array([number[self.right[n]] if n in chosen else -1 for n in order], np.int32),
            np.where(inner, [self.split[n][0] if n in chosen else 0.0 for n in order], 0.0),
            np.array(value),
            np.array([self.rows[n] for n in order], np.int64),
        )

    def as_grown(self) -> Tree:
        """All splits made so far, with the nodes' own numbers."""
        n = len(self.feature)
        return Tree(*(np.array(x, np.int32) for x in (self.feature, self.bin, self.left, self.right)), np.zeros(n), np.zeros(n), np.zeros(n, np.int64))


def _in_bag(h: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Whether rows are in a bag, by their hash: the same rows whenever it is asked."""
    if share >= 1:
        return np.ones(len(h), bool)
    mixed = (h.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(11)).astype(float) / (1 << 53) < share


def _matrix(b: pa.RecordBatch, features: int) -> np.ndarray:
    column = b["bins"]
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), features)


def _sums(state: DataFrame, features: int, recent: list[Tree], grown: Tree | None, nodes: list[int], bag: tuple[int, float], max_bins: int):
    """{node: vector} of the nodes' residual sums and rows by feature and bin; -1: errors of the valid and train rows."""
    width = features * max_bins
    # bounded by the parameters: CARRIED trees of num_leaves leaves
    shared = state.sparkSession.sparkContext.broadcast((recent, grown))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent, grown = shared.value
        total = {n: np.zeros(2 * width) for n in [-1, *nodes]}
        offset = (np.arange(features) * max_bins)[None, :]
        for b in batches:
            if not b.num_rows:
                continue
            bins = _matrix(b, features)
            residual = b["y"].to_numpy() - b["pred"].to_numpy()
            for tree in recent:
                residual = residual - tree.value[tree.leaf_of(bins)]
            valid = b["valid"].to_numpy(zero_copy_only=False)
            for at, rows in ((0, valid), (3, ~valid)):
                total[-1][at : at + 3] += ((residual[rows] ** 2).sum(), np.abs(residual[rows]).sum(), rows.sum())
            used = ~valid & _in_bag(b["h"].to_numpy(), *bag)
            leaf = np.zeros(len(bins), np.int32) if grown is None else grown.leaf_of(bins)
            for n in nodes:
                own = np.flatnonzero(used & (leaf == n))
                slot = (bins[own] + offset).ravel()
                total[n][:width] += np.bincount(slot, weights=np.repeat(residual[own], features), minlength=width)
                total[n][width:] += np.bincount(slot, minlength=width)
        values = pa.array(np.concatenate(list(total.values())), pa.float64())
        cut = pa.array(np.arange(len(total) + 1) * 2 * width, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.ListArray.from_arrays(cut, values)], names=["node", "v"])

    parts = state.mapInArrow(measure, "node int, v array<double>").select("node", array_to_vector("v").alias("v"))
    summed = parts.groupBy("node").agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("v")).toArrow()
    shared.unpersist()
    values = summed["v"].combine_chunks().values.to_numpy().reshape(summed.num_rows, 2 * width)
    return dict(zip(summed["node"].to_pylist(), values))


def fit_trees(
    df: DataFrame,
    features: Sequence[str],
    target: str = config.TARGET,
    params: dict | None = None,
    categorical: Sequence[str] = (),
    split: str = "split",
    date: str = config.DATE,
    max_bins: int = MAX_BINS,
) -> BoostedTrees:
    """Boosted trees on the train rows, stopped by the valid rows.

    All of ``config.BOOSTING_PARAMS`` are honoured.  Rows without a target are left out;
    NULL and NaN features go left at every split, and a split may separate just them.
    Columns named ``categorical`` enter as ordered target statistics, whatever the number
    of their values.  Without valid rows all rounds are run.
    """
    if max_bins > 255:
        raise ValueError("a bin is one byte: max_bins is 255 at most")
    p = _arguments(params)
    rows = df.where(F.col(split).isin("train", "valid") & F.col(target).isNotNull())
    names = [f for f in features if f not in categorical]
    categories, prior = {}, 0.0
    if categorical:
        train = rows.where(F.col(split) == "train")
        rows = encode_ordered(rows, categorical, target, date, split)
        names += [f"{c}_encoded" for c in categorical]
        prior = float(train.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0)
        categories = {c: cut_lineage(category_table(train, c, target)) for c in categorical}
    plain = rows.select(
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(names)],
        F.col(target).cast("double").alias("y"),
        (F.col(split) == "valid").alias("valid"),
        F.xxhash64(*df.columns).alias("h"),
    )
    plain = cut_lineage(plain.where(~F.isnan("y")))
    width, edges = len(names), bin_edges(plain.where("NOT valid"), [f"x{i}" for i in range(len(names))], max_bins)
    base = float(plain.where("NOT valid").agg(F.avg("y")).first()[0] or 0.0)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b[f"x{i}"].to_numpy(zero_copy_only=False).astype(float) for i in range(width)]) if b.num_rows else np.zeros((0, width))
            packed = bin_rows(x, edges)
            cells = pa.Array.from_buffers(
                pa.binary(), b.num_rows, [None, pa.py_buffer((np.arange(b.num_rows + 1) * width).astype(np.int32)), pa.py_buffer(packed.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                [cells, b["y"], b["valid"], pa.array(np.full(b.num_rows, base)), b["h"]], names=["bins", "y", "valid", "pred", "h"]
            )

    schema = "bins binary, y double, valid boolean, pred double, h long"
    state = cut_lineage(plain.mapInArrow(binned, schema))
    release(plain)

    random = np.random.default_rng(int(p["random_state"]))
    trees: list[Tree] = []
    recent: list[Tree] = []
    history: list[float] = []
    best, best_round, bag = np.inf, 0, (0, 1.0)
    patience, metric_at = int(p["early_stopping_rounds"]), 1 if p["metric"] in ("l1", "mae") else 0
    for round_number in range(int(p["num_boost_round"]) + 1):
        if int(p["bagging_freq"]) > 0 and round_number % int(p["bagging_freq"]) == 0:
            bag = (int(random.integers(1 << 62)), float(p["bagging_fraction"]))
        used = np.zeros(width, bool)
        used[random.permutation(width)[: max(1, round(width * float(p["feature_fraction"])))]] = True
        found = _sums(state, width, recent, None, [0], bag, max_bins)
        # the errors after the trees so far come with the next tree's first pass
        valid = found[-1][:3]
        if valid[2]:
            error = float(np.sqrt(valid[0] / valid[2]) if metric_at == 0 else valid[1] / valid[2])
            history.append(error)
            if error < best:
                best, best_round = error, round_number
            elif patience > 0 and round_number - best_round >= patience:
                break
        else:
            best_round = round_number
        if round_number == int(p["num_boost_round"]):
            break

        def parts(vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            both = vector.reshape(2, width, max_bins)
            return both[0], both[1]

        growing = _Growing(*parts(found[0]), used, p)
        while True:
            picked, unsure = growing.best_first()
            if not unsure:
                break
            pairs = [growing.children(node) for node in unsure]
            smaller = [min(pair, key=lambda n: growing.rows[n]) for pair in pairs]
            found = _sums(state, width, recent, growing.as_grown(), smaller, bag, max_bins)
            for node, pair, own in zip(unsure, pairs, smaller):
                other = pair[1] if own == pair[0] else pair[0]
                sums, counts = parts(found[own])
                growing.learn(own, sums, counts)
                growing.learn(other, growing.sums[node][0] - sums, growing.sums[node][1] - counts)
        if not picked:
            break  # nothing left to gain
        tree = growing.as_tree(picked)
        trees.append(tree)
        recent.append(tree)
        if len(recent) == CARRIED:
            state, recent = _carry(state, recent, width, schema), []
    release(state)
    return BoostedTrees(names, base, edges, trees[:best_round], p, len(trees), history, categories, prior, trees)


def _carry(state: DataFrame, recent: list[Tree], width: int, schema: str) -> DataFrame:
    """The rows with the recent trees added to their predictions; the table before is dropped."""
    shared = state.sparkSession.sparkContext.broadcast(recent)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred = b["pred"].to_numpy().copy()
            if b.num_rows:
                bins = _matrix(b, width)
                for tree in shared.value:
                    pred += tree.value[tree.leaf_of(bins)]
            yield pa.RecordBatch.from_arrays([b["bins"], b["y"], b["valid"], pa.array(pred), b["h"]], names=["bins", "y", "valid", "pred", "h"])

    out = cut_lineage(state.mapInArrow(added, schema))
    release(state)
    shared.unpersist()
    return out


def save_trees(model: BoostedTrees, path: str, spark: SparkSession) -> None:
    """The node table, the bins' ends, the category tables and the settings, as Parquet."""
    model.nodes(spark).write.mode("overwrite").parquet(f"{path}/nodes")
    ends = [(i, f, own.tolist()) for i, (f, own) in enumerate(zip(model.features, model.edges))]
    spark.createDataFrame(ends, "position int, feature string, edges array<double>").write.mode("overwrite").parquet(f"{path}/features")
    meta = {"base": model.base, "prior": model.prior, "rounds": model.rounds, "history": model.history, "params": model.params, "categories": list(model.categories), "trees": len(model.trees)}
    spark.createDataFrame([(json.dumps(meta),)], "settings string").write.mode("overwrite").parquet(f"{path}/settings")
    for c, table in model.categories.items():
        table.write.mode("overwrite").parquet(f"{path}/categories/{c}")


def load_trees(path: str, spark: SparkSession) -> BoostedTrees:
    meta = json.loads(spark.read.parquet(f"{path}/settings").first().settings)
    ends = spark.read.parquet(f"{path}/features").orderBy("position").collect()  # one row a feature
    names, edges = [r.feature for r in ends], [np.array(r.edges, float) for r in ends]
    place = {f: i for i, f in enumerate(names)}
    trees: list[list] = [[] for _ in range(meta["trees"])]
    for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # num_leaves x rounds rows
        trees[r.tree].append(r)

    def cut(r) -> int:
        return 0 if r.threshold == float("-inf") else 1 + int(np.searchsorted(edges[place[r.feature]], r.threshold))

    built = [
        Tree(
            np.array([place[r.feature] if r.feature else -1 for r in own], np.int32),
            np.array([cut(r) if r.feature else 0 for r in own], np.int32),
            np.array([r.left_node if r.feature else -1 for r in own], np.int32),
            np.array([r.right_node if r.feature else -1 for r in own], np.int32),
            np.array([r.gain or 0.0 for r in own]),
            np.array([r.value or 0.0 for r in own]),
            np.array([r.rows for r in own], np.int64),
        )
        for own in trees
    ]
    categories = {c: spark.read.parquet(f"{path}/categories/{c}") for c in meta["categories"]}
    return BoostedTrees(names, meta["base"], edges, built, meta["params"], meta["rounds"], meta["history"], categories, meta["prior"])
