"""Toxicity: multiple-instance learning with sentences as instances.

Labels are known for documents only.  A sentence has the probability
``sigmoid(bias + sum of weights of its words and word beginnings)``; a document is toxic
if one of its sentences is, or by a small probability without any (the leak, which also
takes up wrong labels): the *noisy-or* ``1 - (1 - leak) * product(1 - p)``.  The gradient
of the documents' log-likelihood shares a toxic document's blame among its sentences by
their probabilities, so the weights end up on what toxic documents have in common.  The
same sentence probabilities then locate the offending sentences.

A sentence ends at ``.``, ``!``, ``?`` and a line's end; words are runs of ASCII letters,
digits and all code points above 127, with A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow_text import LOWER, chunks, kept_powers, lean, mask_spans, span_hashes

#: Buckets of words and word beginnings, and the lengths in bytes of those beginnings.
BITS, BEGINNINGS = 20, (4, 6, 8)
#: Labelled rows that the fit looks at, at most: those with the smallest hash of their id.
MAX_TRAINING_ROWS = 5000
THRESHOLD = 0.5
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 33, 46, 63]] = True
_START = (-4.0, -3.0)  # bias of a sentence, logit of the leak


def sentences(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the sentences with a word, then (sentence, input) pairs, each once, in order.

    A sentence reaches from its first word to its last one.
    """
    low = LOWER[raw]
    start, end, row = mask_spans(_WORD[low], at)
    stops = np.concatenate([[0], np.cumsum(_STOP[low])])
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    new = np.r_[True, (row[1:] != row[:-1]) | (stops[start[1:]] != stops[start[:-1]])]
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    slots, owner = [span_hashes(low, start, end, kept_powers)], [sentence]
    for size in BEGINNINGS:
        longer = end - start > size
        # a beginning is another input than the whole word with the same letters
        slots.append(span_hashes(low, start[longer], start[longer] + size, kept_powers) * np.uint64(3) + np.uint64(size))
        owner.append(sentence[longer])
    slot = (np.concatenate(slots) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    pair = np.unique((np.concatenate(owner).astype(np.uint64) << np.uint64(BITS)) | slot)
    inputs = (pair & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return row[first], start[first], end[last], (pair >> np.uint64(BITS)).astype(np.int64), inputs


def softplus(z: np.ndarray) -> np.ndarray:
    """log(1 + exp(z)), which is -log(1 - sigmoid(z))."""
    return np.logaddexp(0, z)


@dataclass
class SentenceModel:
    """Bias and weights of a sentence's logit; ``leak`` is a logit too."""

    bias: float
    leak: float
    weights: np.ndarray

    def logits(self, sentence: np.ndarray, inputs: np.ndarray, n: int) -> np.ndarray:
        return self.bias + np.bincount(sentence, weights=self.weights[inputs], minlength=n)

    def noisy_or(self, row: np.ndarray, logits: np.ndarray, rows: int) -> np.ndarray:
        """Probability of each row, from its sentences'."""
        clean = softplus(np.float64(self.leak)) + np.bincount(row, weights=softplus(logits), minlength=rows)
        return -np.expm1(-clean)


def fit(
    sizes: list[np.ndarray], lengths: list[np.ndarray], inputs: list[np.ndarray], label: np.ndarray,
    epochs: int = 10, batch: int = 64, steps: int = 500, rate: float = 0.05, decay: float = 2e-4, sparsity: float = 1e-3,
    toxic_weight: float = 3.0, least_documents: int = 5, seed: int = 11,
) -> SentenceModel:
    """Maximum likelihood of the documents' labels by Adam; ``lengths`` are the inputs of each sentence.

    Inputs of fewer than ``least_documents`` sample documents get no weight: they would
    only remember the rows they are from.  ``sparsity`` (the price of a weight's size)
    leaves few inputs with a weight, which makes long clean documents safe; toxic
    documents, the rarer ones, count ``toxic_weight`` times.  A small sample is gone
    through more often, so that there are at least ``steps`` steps.
    """
    documents = np.zeros(1 << BITS, np.int32)
    for own in inputs:
        documents[np.unique(own)] += 1
    usual = documents >= least_documents
    lengths = [np.bincount(np.repeat(np.arange(len(n)), n)[usual[own]], minlength=len(n)) for n, own in zip(lengths, inputs)]
    inputs = [own[usual[own]] for own in inputs]
    random = np.random.default_rng(seed)
    table = np.zeros((1 << BITS) + 2, np.float32)  # the weights, bias and leak
    table[-2:] = _START
    rows = len(label)
    if not rows or label.min() == label.max():  # nothing to tell apart: the leak is the smoothed share
        share = (float(label.sum()) + 1) / (rows + 2)
        return SentenceModel(-50.0, float(np.log(share / (1 - share))), table[:-2])
    mean, square, step = np.zeros_like(table), np.zeros_like(table), 0
    lots = max(1, rows // min(batch, max(16, rows // 16)))
    for _ in range(max(epochs, -(-steps // lots))):
        for lot in np.array_split(random.permutation(rows), lots):
            doc = np.repeat(np.arange(len(lot)), [sizes[i] for i in lot])
            per = np.concatenate([lengths[i] for i in lot])
            own = np.concatenate([inputs[i] for i in lot])
            sentence = np.repeat(np.arange(len(per)), per)
            model = SentenceModel(float(table[-2]), float(table[-1]), table)
            z = model.logits(sentence, own, len(per))
            p_clean = np.clip(1 - model.noisy_or(doc, z, len(lot)), 1e-12, 1 - 1e-9)
            # slope of the loss by a logit: p in a clean document, -p * clean / (1 - clean) in a toxic one
            factor = np.where(label[lot] > 0, -toxic_weight * p_clean / (1 - p_clean), 1.0) / len(lot)
            each = factor[doc] / (1 + np.exp(-np.clip(z, -30, 30)))
            active, slot = np.unique(own, return_inverse=True)
            active = np.concatenate([active, [len(table) - 2, len(table) - 1]])
            slope = np.append(
                np.bincount(slot, weights=each[sentence], minlength=len(active) - 2),
                [each.sum(), factor.sum() / (1 + np.exp(-table[-1]))],
            ).astype(np.float32)
            slope[:-2] += decay * table[active[:-2]] + sparsity * np.sign(table[active[:-2]])
            step += 1
            mean[active] = 0.9 * mean[active] + 0.1 * slope
            square[active] = 0.99 * square[active] + 0.01 * slope**2
            table[active] -= rate * (mean[active] / (1 - 0.9**step)) / (np.sqrt(square[active] / (1 - 0.99**step)) + 1e-5)
    return SentenceModel(float(table[-2]), float(table[-1]), np.ascontiguousarray(table[:-2]))


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", text: str = "text",
    max_rows: int = MAX_TRAINING_ROWS,
) -> SentenceModel:
    """Fit on labelled documents for which ``usable`` (an expression on ``doc_id``) holds.

    An id with several labels counts as toxic if at least half of them are.  At most
    ``max_rows`` rows enter, those with the smallest hash of their id; their inputs are
    all that reaches the driver.  Without two kinds of labels every document gets the
    smoothed share of label 1.
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
    # at most max_rows rows
    sample = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").withColumn("__sw_hash", own_hash)

    def inputs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, at in chunks(b["text"]):
                row, _, _, sentence, own = sentences(raw, at)
                per = np.bincount(sentence, minlength=len(row))
                cut = np.searchsorted(row, np.arange(hi - lo + 1))
                total = np.concatenate([[0], np.cumsum(per)])
                yield pa.RecordBatch.from_arrays(
                    [b["__sw_hash"][lo:hi], b["doc_id"][lo:hi], b["__sw_label"][lo:hi],
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(per, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(total[cut], pa.int32()), pa.array(own, pa.int32()))],
                    names=["h", "doc_id", "label", "lengths", "inputs"],
                )

    schema = f"h long, doc_id {dict(docs.dtypes)['doc_id']}, label int, lengths array<int>, inputs array<int>"
    rows = sample.mapInArrow(lean(inputs_of), schema).orderBy("h", "doc_id", "lengths", "inputs").limit(max_rows).toArrow()

    def lists(column: str) -> list[np.ndarray]:
        own = rows[column].combine_chunks()
        offsets = own.offsets.to_numpy()
        return np.split(own.values.to_numpy()[offsets[0] : offsets[-1]], (offsets - offsets[0])[1:-1]) if rows.num_rows else []

    lengths = lists("lengths")
    sizes = np.array([len(x) for x in lengths], np.int64)
    return fit(sizes, lengths, lists("inputs"), rows["label"].to_numpy().astype(np.float32))


def score(docs: DataFrame, model: SentenceModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score``, ``predicted``, ``n_sentences`` and ``offending``.

    ``offending`` has the sentences whose own probability is ``threshold`` or more, in
    order: their probability and text, from the first word to the last.  Null, empty and
    wordless texts have no sentence and get the leak.  One pass, row by row: no shuffle,
    and a repeated row gets an equal score.  Result columns replace columns of the same names.
    """
    parts = (model.bias, model.leak, model.weights)
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # fixed size: 2 ** BITS floats
    names = ["score", "predicted", "n_sentences", "offending"]
    kept = [c for c in docs.columns if c not in names]
    plain = docs.select(*kept, F.col(text).alias("__sw_text"))
    span = pa.struct([("score", pa.float64()), ("sentence", pa.string())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SentenceModel(*shared.value)
        for b in batches:
            out, n_sentences = np.empty(b.num_rows), np.empty(b.num_rows, np.int32)
            found: list[list] = [[] for _ in range(b.num_rows)]
            for lo, hi, raw, at in chunks(b["__sw_text"]):
                row, start, end, sentence, own = sentences(raw, at)
                z = model.logits(sentence, own, len(row))
                out[lo:hi] = model.noisy_or(row, z, hi - lo)
                n_sentences[lo:hi] = np.bincount(row, minlength=hi - lo)
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                for i in np.flatnonzero(p >= threshold).tolist():
                    found[lo + row[i]].append({"score": p[i], "sentence": raw[start[i] : end[i]].tobytes().decode()})
            columns = [pa.array(out), pa.array((out >= threshold).astype(np.int32)), pa.array(n_sentences), pa.array(found, pa.list_(span))]
            yield pa.RecordBatch.from_arrays([b[c] for c in kept] + columns, names=[*kept, *names])

    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer").add("n_sentences", "integer")
    located = T.ArrayType(T.StructType().add("score", "double").add("sentence", "string"))
    return plain.mapInArrow(lean(scored), schema.add("offending", located))


def classify(docs: DataFrame, labels: DataFrame, usable: Column, **options) -> DataFrame:
    """Fit on the usable labelled rows and score all documents."""
    return score(docs, train(docs, labels, usable, **options))
