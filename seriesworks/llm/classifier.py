"""Quality classifier: a factorisation machine.

Inputs are hashed words (lengths scaled to one per document), structure statistics in
bins and the size column of the table; every pair of inputs has a weight, the product
of two short vectors.  The pair sum takes linear time: half of the square of the sum
minus the sum of squares.  The machine is fitted on a bounded sample of labelled rows;
scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow_text import LOWER, chunks, lean, mixed, row_counts, span_hashes, word_spans

#: Word buckets, bins a statistic, vector length.
WORD_BITS, BINS, RANK = 16, 16, 8
#: Labelled rows that the fit looks at, at most: those with the smallest hash of their id.
MAX_TRAINING_ROWS = 8000
THRESHOLD = 0.3
#: Upper bounds of the bins of a ratio, and of a size (powers of two).
RATIO_EDGES = np.array([0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.55, 0.7, 0.9])
SIZE_EDGES = 2.0 ** np.arange(0, 15)
MEAN_EDGES = np.array([1, 2, 3, 3.5, 4, 4.25, 4.5, 5, 5.5, 6, 6.5, 7, 8, 10, 15.0])
MARKS = {
    "capitals": range(65, 91), "digits": range(48, 58), "symbols": b"#*$%&|<>", "stops": b".,;:", "calls": b"!?",
    "wide": range(0xC0, 0x100),
}
STATISTICS = ("n_words", "n_lines", "word_length", "distinct_words", "distinct_lines", "n_chars", *MARKS)


def features(raw: np.ndarray, at: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, input, value) of the non-zero inputs of each row, ordered by row.

    ``n_chars`` is the size column, NaN where it is null.  Inputs below
    ``2 ** WORD_BITS`` are words, the others bins of statistics.
    """
    rows = len(at) - 1
    low = LOWER[raw]
    start, end, row = word_spans(low, at)
    n_words = np.bincount(row, minlength=rows)
    slot = span_hashes(low, start, end) >> np.uint64(64 - WORD_BITS)
    pair, count = np.unique((row.astype(np.uint64) << np.uint64(WORD_BITS)) | slot, return_counts=True)
    word_row = (pair >> np.uint64(WORD_BITS)).astype(np.int64)
    distinct = np.bincount(word_row, minlength=rows)
    norm = np.sqrt(np.bincount(word_row, weights=count.astype(float) ** 2, minlength=rows))

    breaks = np.flatnonzero(raw == 10)
    line_start = np.unique(np.concatenate([at[:-1], breaks + 1]))
    line_start = line_start[line_start < len(raw)]
    line_end = np.append(line_start[1:], len(raw))
    line_row = np.searchsorted(at, line_start, side="right") - 1
    line = mixed(span_hashes(raw, line_start, line_end - np.isin(line_end - 1, breaks)) + line_row.astype(np.uint64))
    n_lines = np.bincount(line_row, minlength=rows)
    first_of_line = np.unique(line, return_index=True)[1]
    distinct_lines = np.bincount(line_row[first_of_line], minlength=rows)

    size = np.maximum(at[1:] - at[:-1], 1)
    words, lines = np.maximum(n_words, 1), np.maximum(n_lines, 1)
    letters = np.bincount(row, weights=end - start, minlength=rows)
    wide = np.zeros(256, bool)
    bins = [
        np.searchsorted(SIZE_EDGES, n_words), np.searchsorted(SIZE_EDGES, n_lines),
        np.searchsorted(MEAN_EDGES, letters / words), np.searchsorted(RATIO_EDGES, distinct / words),
        np.searchsorted(RATIO_EDGES, distinct_lines / lines),
        np.where(np.isnan(n_chars), 0, np.searchsorted(SIZE_EDGES, np.nan_to_num(n_chars) / 4)),
    ]
    for mark in MARKS.values():
        wide[:] = False
        wide[list(mark)] = True
        bins.append(np.searchsorted(RATIO_EDGES, row_counts(wide[raw], at) / size))
    bins = np.stack(bins, axis=1) + (1 << WORD_BITS) + BINS * np.arange(len(bins))
    inputs = np.concatenate([(pair & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64), bins.ravel()])
    values = np.concatenate([count / norm[word_row], np.ones(bins.size)])
    where = np.concatenate([word_row, np.repeat(np.arange(rows), len(STATISTICS))])
    order = np.argsort(where, kind="stable")
    return where[order], inputs[order], values[order].astype(np.float32)


@dataclass
class Machine:
    """Weights of a factorisation machine."""

    bias: float
    linear: np.ndarray
    vectors: np.ndarray

    def logits(self, row: np.ndarray, inputs: np.ndarray, values: np.ndarray) -> np.ndarray:
        """One value per row; ``row`` is sorted and each row has inputs."""
        cut = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        scaled = self.vectors[inputs] * values[:, None]
        total = np.add.reduceat(scaled, cut, axis=0)
        squares = np.add.reduceat(np.einsum("ij,ij->i", scaled, scaled), cut)
        straight = np.add.reduceat(self.linear[inputs] * values, cut)
        return self.bias + straight + 0.5 * (np.einsum("ij,ij->i", total, total) - squares)


def fit(
    row: np.ndarray, inputs: np.ndarray, values: np.ndarray, label: np.ndarray, epochs: int = 12, batch: int = 256,
    steps: int = 400, rate: float = 0.02, decay: float = 1e-4, seed: int = 7,
) -> Machine:
    """Logistic loss by Adam over shuffled batches of rows.

    A sample of a few hundred rows is gone through in smaller batches and more often,
    so that there are at least ``steps`` steps.
    """
    n = (1 << WORD_BITS) + BINS * len(STATISTICS)
    random = np.random.default_rng(seed)
    rows = len(label)
    share = min(max(label.mean() if rows else 0.5, 0.01), 0.99)
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(n, np.float32), random.normal(0, 0.02, (n, RANK)).astype(np.float32))
    if not rows or label.min() == label.max():
        machine.vectors[:] = 0
        return machine
    first = np.searchsorted(row, np.arange(rows + 1))
    table = np.concatenate([machine.linear[:, None], machine.vectors], axis=1)
    mean, square, step = np.zeros_like(table), np.zeros_like(table), 0
    lots = max(1, rows // min(batch, max(16, rows // 16)))
    for _ in range(max(epochs, -(-steps // lots))):
        order = random.permutation(rows)
        for lot in np.array_split(order, lots):
            sizes = first[lot + 1] - first[lot]
            cut = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            pick = np.repeat(first[lot] - cut, sizes) + np.arange(sizes.sum())
            own, x = inputs[pick], values[pick]
            scaled = table[own, 1:] * x[:, None]
            total = np.add.reduceat(scaled, cut, axis=0)
            logit = machine.bias + np.add.reduceat(table[own, 0] * x, cut)
            logit += 0.5 * ((total**2).sum(1) - np.add.reduceat((scaled**2).sum(1), cut))
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[lot]) / len(lot)
            each = np.repeat(error, sizes) * x
            active, slot = np.unique(own, return_inverse=True)
            slope = np.empty((len(active), RANK + 1), np.float32)
            slope[:, 0] = np.bincount(slot, each, len(active))
            pairs = np.repeat(total, sizes, axis=0) - scaled
            for k in range(RANK):
                slope[:, k + 1] = np.bincount(slot, each * pairs[:, k], len(active))
            slope += decay * table[active]
            step += 1
            mean[active] = 0.9 * mean[active] + 0.1 * slope
            square[active] = 0.99 * square[active] + 0.01 * slope**2
            fixed = mean[active] / (1 - 0.9**step) / (np.sqrt(square[active] / (1 - 0.99**step)) + 1e-6)
            table[active] -= rate * fixed
            machine.bias -= rate * float(error.sum())
    machine.linear, machine.vectors = np.ascontiguousarray(table[:, 0]), np.ascontiguousarray(table[:, 1:])
    return machine


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", text: str = "text",
    max_rows: int = MAX_TRAINING_ROWS,
) -> Machine:
    """Fit on labelled documents for which ``usable`` (an expression on ``doc_id``) holds.

    An id with several labels counts as good if at least half of them are.  At most
    ``max_rows`` rows enter, those with the smallest hash of their id; only their
    inputs reach the driver.  Without two kinds of labels the machine scores all
    documents with the smoothed share of label 1.
    """
    own_hash = F.xxhash64("doc_id")
    chosen = (
        labels.select("doc_id", F.col(label).cast("double").alias("__sw_label"))
        .dropna()
        .filter(usable)
        .groupBy("doc_id")
        .agg((F.avg("__sw_label") >= 0.5).cast("int").alias("__sw_label"))
        .orderBy(own_hash, "doc_id")
        .limit(max_rows)
    )
    size = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    sample = (
        docs.select("doc_id", F.col(text).alias("text"), size.alias("n_chars"))
        .join(F.broadcast(chosen), "doc_id")  # at most max_rows rows
        .withColumn("__sw_hash", own_hash)
    )

    def inputs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b["n_chars"].to_numpy(zero_copy_only=False).astype(float)
            for lo, hi, raw, at in chunks(b["text"]):
                row, own, x = features(raw, at, sizes[lo:hi])
                cut = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b["__sw_hash"][lo:hi], b["doc_id"][lo:hi], b["__sw_label"][lo:hi], pa.ListArray.from_arrays(cut, pa.array(own, pa.int32())),
                     pa.ListArray.from_arrays(cut, pa.array(x, pa.float32()))],
                    names=["h", "doc_id", "label", "inputs", "values"],
                )

    schema = f"h long, doc_id {dict(docs.dtypes)['doc_id']}, label int, inputs array<int>, values array<float>"
    rows = sample.mapInArrow(lean(inputs_of), schema).orderBy("h", "doc_id", "inputs").limit(max_rows).toArrow()
    own, at = rows["inputs"].combine_chunks(), rows["inputs"].combine_chunks().offsets.to_numpy()
    where = np.repeat(np.arange(rows.num_rows), np.diff(at))
    values = rows["values"].combine_chunks().values.to_numpy()
    return fit(where, own.values.to_numpy().astype(np.int64), values, rows["label"].to_numpy().astype(np.float32))


def score(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (probability of label 1) and ``predicted`` (1 from the threshold on).

    Null and empty texts are scored by their statistics alone.  One pass, row by row:
    no shuffle, and a repeated row gets an equal score.  Result columns replace
    columns of the same names.
    """
    parts = (machine.bias, machine.linear, machine.vectors)
    model = docs.sparkSession.sparkContext.broadcast(parts)  # fixed size: inputs x (RANK + 1) floats
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    size = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    plain = docs.select(*kept, F.col(text).alias("__sw_text"), size.alias("__sw_size"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*model.value)
        for b in batches:
            sizes = b["__sw_size"].to_numpy(zero_copy_only=False).astype(float)
            out = np.empty(b.num_rows)
            for lo, hi, raw, at in chunks(b["__sw_text"]):
                out[lo:hi] = machine.logits(*features(raw, at, sizes[lo:hi]))
            out = 1 / (1 + np.exp(-np.clip(out, -500, 500)))
            columns = [b[c] for c in kept] + [pa.array(out), pa.array((out >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "score", "predicted"])

    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")
    return plain.mapInArrow(lean(scored), schema)


def classify(docs: DataFrame, labels: DataFrame, usable: Column, **options) -> DataFrame:
    """Fit on the usable labelled rows and score all documents."""
    return score(docs, train(docs, labels, usable, **options))
