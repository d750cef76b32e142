"""Language-model scoring: prediction by partial matching, with a word model beside it.

The byte model has all grams of all training rows (module ``ppm``) and grows with the
input.  Documents are read in blocks; a block sends its distinct grams, with their
training counts, to the buckets of their contexts, gets their log probabilities back
and adds them up for each of its texts.  Rows sent are blocks times buckets, both in
proportion to the input: 16 MB of text a bucket, some MB of it a block.
The word model counts all training words.  Words that hold at least ``FREQUENT`` of
the training tokens, of which there are at most ``1 / FREQUENT``, are looked up while
the texts are read; the rarer words of a document go through an equi-join with the
counts, so the vocabulary may have any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ..session import cut_lineage
from . import ppm
from .arrow_text import LOWER, chunks, lean, span_hashes, word_spans
from .packing import pack, unpack

#: Longest context in bytes; distinct grams and bytes of text that end a block, which changes no result.
DEPTH, HELD, BLOCK = 6, 1 << 21, 1 << 24
#: Bytes of text for each bucket of grams, and the least number of buckets.
BUCKET, BUCKETS = 1 << 24, 32
#: The bucket number of a block's own texts.
TEXTS = -1
FREQUENT = 2.0**-20


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word, letters A to Z lower-cased.

    Words are told apart by 64-bit hashes: among a billion distinct words, two share
    one with a probability of about 3 %.
    """
    low = LOWER[raw]
    start, end, row = word_spans(low, at)
    return span_hashes(low, start, end), row


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): occurrences of each word, by its hash."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for b in batches:
            for _, _, raw, at in chunks(b["__sw_text"]):
                parts.append(np.unique(word_hashes(raw, at)[0], return_counts=True))
                if len(parts) >= 8 and sum(len(k) for k, _ in parts[1:]) > max(1 << 19, len(parts[0][0])):
                    parts = [ppm.merged(parts)]
        if parts:
            words, n = ppm.merged(parts)
            for lo in range(0, len(words), 1 << 18):
                part = slice(lo, lo + (1 << 18))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[part].view(np.int64)), pa.array(n[part].astype(np.int64))], names=["word", "n"]
                )

    plain = docs.select(F.col(text).alias("__sw_text"))
    return plain.mapInArrow(lean(counted), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def per_row(keys: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys of each row, their times, number of them in each row)."""
    order = np.lexsort((keys, row))
    keys, row = keys[order], row[order]
    cut = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])]) if len(keys) else np.zeros(0, np.int64)
    return keys[cut], np.diff(np.append(cut, len(keys))), np.bincount(row[cut], minlength=rows)


class Block:
    """Documents of a task whose grams are sent together."""

    def __init__(self, depth: int):
        self.depth, self.rows, self.sizes, self.raw, self.grams = depth, [], [], [], []

    def add(self, rows: np.ndarray, learns: np.ndarray, raw: np.ndarray, at: np.ndarray) -> None:
        """``raw`` is lower-cased."""
        keys, offsets = ppm.gram_keys(raw, at, self.depth)
        keys, trained = ppm.reversed_contexts(keys), np.repeat(learns, np.diff(offsets))
        found, n = np.unique(keys[trained], return_counts=True)
        self.grams.append((found, n))
        found = ppm.distinct(keys[~trained])
        self.grams.append((found, np.zeros(len(found), np.int64)))
        if len(self.grams) >= 16 and sum(len(k) for k, _ in self.grams[1:]) > max(1 << 19, len(self.grams[0][0])):
            self.grams = [ppm.merged(self.grams)]
        self.rows.append(rows)
        self.sizes.append(np.diff(at))
        self.raw.append(raw)

    def full(self, held: int) -> bool:
        return len(self.grams[0][0]) > held or sum(len(r) for r in self.raw) > BLOCK

    def packets(self, buckets: int) -> Iterator[tuple[int, bytes, bytes]]:
        """(bucket, keys, counts), and the texts as bucket ``TEXTS``: their bytes, their rows and sizes."""
        yield from ppm.block_packets(*ppm.merged(self.grams), buckets)
        shape = np.concatenate([*self.rows, *self.sizes]).astype(np.int64)
        yield TEXTS, pack(np.concatenate(self.raw), 3), pack(shape)


def block_scores(packets: DataFrame, logs: DataFrame, buckets: int, depth: int) -> DataFrame:
    """(__sw_row, __sw_logs): natural log probability of each text, from its block's grams."""

    def added(group: pa.Table) -> pa.Table:
        numbers = group["bucket"].to_numpy()
        texts = int(np.flatnonzero(numbers == TEXTS)[0])
        raw = unpack(group["data"][texts].as_py(), np.uint8)
        rows, sizes = unpack(group["shape"][texts].as_py(), np.int64).reshape(2, -1)
        ends = pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]))
        body = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, ends, pa.py_buffer(raw)])
        held = np.zeros(0, np.uint64)
        parts: list = []
        for _, _, part, at in chunks(body):  # keys take eight times the room of the text: made twice, never all at once
            parts.append(ppm.distinct(ppm.gram_keys(part, at, depth)[0]))
            if sum(map(len, parts)) > max(1 << 20, len(held)):
                held, parts = ppm.distinct(np.concatenate([held, *parts])), []
        held = ppm.distinct(ppm.reversed_contexts(np.concatenate([held, *parts])))
        held = held[np.argsort(ppm.bucket_of(held, buckets), kind="stable")]
        order = [i for i in np.argsort(numbers, kind="stable") if i != texts]
        log = np.concatenate([unpack(group["data"][int(i)].as_py(), np.uint8).view(np.float32) for i in order])
        table, out = ppm.Lookup(held), np.zeros(len(rows))
        for lo, hi, part, at in chunks(body):
            keys, offsets = ppm.gram_keys(part, at, depth)
            out[lo:hi] = np.add.reduceat(log[table.find(ppm.reversed_contexts(keys))], offsets[:-1], dtype=np.float64)
        return pa.table({"__sw_row": rows, "__sw_logs": out})

    texts = packets.filter(F.col("bucket") == TEXTS).select("block", "bucket", F.col("keys").alias("data"), F.col("counts").alias("shape"))
    back = logs.select("block", "bucket", F.col("logs").alias("data"), F.lit(None).cast("binary").alias("shape"))
    return texts.unionByName(back).groupBy("block").applyInArrow(added, "__sw_row long, __sw_logs double")


def score(
    docs: DataFrame, training: Column, text: str = "text", depth: int = DEPTH, held: int = HELD,
    frequent: float = FREQUENT,
) -> DataFrame:
    """Score all documents with models of the rows for which ``training`` holds.

    Returns the columns of ``docs`` but the text, and n_tokens (words and one end),
    n_known, train_tokens, base_score (add-one word model) and score (byte model), the
    last two as log10 probabilities.  Null counts as empty: one token, the end.  Both
    models see the text with A to Z lower-cased; the byte model includes white space.
    A null condition excludes the row from training.  Without training rows all words
    are unknown and all bytes equally likely.  Repeated rows are scored each; result
    columns replace columns of the same names.
    """
    results = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    spark, body = docs.sparkSession, F.coalesce(F.col(text), F.lit(""))
    learned = docs.filter(training).select(F.col(text).alias("__sw_text"))
    volume = docs.agg(F.sum(F.octet_length(body).cast("long")).alias("n"), F.count(F.when(training, 1)).alias("ends")).first()
    ends, buckets = volume["ends"], max(BUCKETS, (volume["n"] or 0) // BUCKET)
    counts = cut_lineage(word_counts(learned, "__sw_text"))
    words, kinds = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens = (words or 0) + ends
    kinds += ends > 0
    often = counts.filter(F.col("n") >= frequent * tokens).toArrow()  # at most 1 / frequent rows
    model = spark.sparkContext.broadcast((often["word"].to_numpy().view(np.uint64), often["n"].to_numpy(), float(tokens + kinds + 1)))
    end_score = float(np.log10((ends + 1) / (tokens + kinds + 1)))
    kept = [c for c in docs.columns if c not in (text, *results)]

    plain = docs.select(
        *kept, body.alias("__sw_text"), F.coalesce(training, F.lit(False)).alias("__sw_learns"), F.monotonically_increasing_id().alias("__sw_row")
    )
    schema = StructType([StructField(f.name, f.dataType) for f in docs.select(*kept).schema.fields])
    for name, kind in (("__sw_row", "long"), ("n_tokens", "long"), ("__sw_known", "long"), ("__sw_base", "double")):
        schema = schema.add(name, kind)
    schema = schema.add("__sw_words", ArrayType(LongType())).add("__sw_times", ArrayType(IntegerType()))
    for name, kind in (("__sw_block", "long"), ("__sw_bucket", "integer"), ("__sw_keys", "binary"), ("__sw_counts", "binary")):
        schema = schema.add(name, kind)
    names = schema.names

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, and rows with the packets of each block."""
        keys, n, whole = model.value
        table = ppm.Lookup(keys)
        cost = np.log10((n + 1) / whole)
        block, types = Block(depth), []

        def sent() -> Iterator[pa.RecordBatch]:
            number = int(block.rows[0][0])
            packets = [(number, *p) for p in block.packets(buckets)]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*packets, strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(packets), t) for t in types[:-4]), *columns], names=names)

        for b in batches:
            size = b.num_rows
            own, known, base = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size)
            rare_words, sizes = [], np.zeros(size, np.int64)
            numbers, learns = b["__sw_row"].to_numpy(), b["__sw_learns"].to_numpy(zero_copy_only=False)
            for lo, hi, raw, at in chunks(b["__sw_text"]):
                hashes, row = word_hashes(raw, at)
                place = table.find(hashes)
                found = place >= 0
                own[lo:hi] = np.bincount(row, minlength=hi - lo)
                known[lo:hi] = np.bincount(row[found], minlength=hi - lo)
                base[lo:hi] = np.bincount(row[found], cost[place[found]], minlength=hi - lo)
                *rare, sizes[lo:hi] = per_row(hashes[~found], row[~found], hi - lo)
                rare_words.append(rare)
                block.add(numbers[lo:hi], learns[lo:hi], LOWER[raw], at)
                if block.full(held):
                    types = types or _types(b, kept)
                    yield from sent()
                    block = Block(depth)
            edges = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(edges, pa.array(np.concatenate(part) if part else np.zeros(0), kind))
                for part, kind in (([k.view(np.int64) for k, _ in rare_words], pa.int64()), ([t for _, t in rare_words], pa.int32()))
            ]
            types = types or _types(b, kept)
            columns = [*(b[c] for c in kept), b["__sw_row"], pa.array(own + 1), pa.array(known), pa.array(base), *lists]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(size, t) for t in types[-4:])], names=names)
        if block.rows:
            yield from sent()

    both = cut_lineage(plain.mapInArrow(lean(read), schema))
    scored = both.filter("__sw_block IS NULL")
    packets = both.filter("__sw_block IS NOT NULL").select(
        F.col("__sw_block").alias("block"), F.col("__sw_bucket").alias("bucket"), F.col("__sw_keys").alias("keys"), F.col("__sw_counts").alias("counts")
    )
    logs = block_scores(packets, ppm.packet_logs(packets, depth), buckets, depth)
    rare = scored.select("__sw_row", F.explode(F.arrays_zip("__sw_words", "__sw_times")).alias("w")).select(
        "__sw_row", F.col("w.__sw_words").alias("word"), F.col("w.__sw_times").alias("times")
    )
    costs = rare.join(counts, "word", "left").groupBy("__sw_row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(tokens + kinds + 1)))).alias("__sw_rare"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("__sw_rare_known"),
    )
    return scored.join(costs, "__sw_row", "left").join(logs, "__sw_row", "left").select(
        *kept,
        "n_tokens",
        (F.col("__sw_known") + F.coalesce("__sw_rare_known", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("__sw_base") + F.coalesce("__sw_rare", F.lit(0.0)) + end_score).alias("base_score"),
        (F.col("__sw_logs") / float(np.log(10))).alias("score"),
    )


def _types(batch: pa.RecordBatch, kept: list[str]) -> list[pa.DataType]:
    """Arrow types of a document's columns and of a packet's."""
    own = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    return [*(batch.schema.field(c).type for c in kept), *own, pa.int64(), pa.int32(), pa.binary(), pa.binary()]
