"""SimHash near-duplicates by multi-index hashing.

A fingerprint has one bit for each bit position of its shingles' hashes: the majority.
Distinct fingerprints are cut into segments; if two differ in at most ``distance``
bits, some segment differs in at most ``distance // segments`` of them.  Each
fingerprint is stored under its segments and looked up under every value of the small
Hamming ball around each of them; the matches' complete distances are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .arrow_text import lean
from .components import components
from .words import ASCII_LOWER

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Segments of a fingerprint: three suit up to some hundred million distinct
#: fingerprints; two make the buckets finer and the balls larger.
SEGMENTS = 3
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of XXH64 over the word shingles of a text, repeats included.

    A text with fewer words than a shingle is one shingle; one without words gives zero.
    """
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    spans = zip([0, *ends], ends[shingle - 1 :], strict=False) if len(words) >= shingle else [(0, len(joined) + 1)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The columns of ``docs`` but the text, and ``fp``, the fingerprint as a signed long."""
    kept = [c for c in docs.columns if c not in (text, "fp")]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle) for x in b["__sw_text"].cast(pa.binary())]
            column = pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), column], names=[*kept, "fp"])

    plain = docs.select(*kept, F.col(text).alias("__sw_text"))
    return plain.mapInArrow(lean(marked), docs.select(*kept).schema.add("fp", "long"))


def _address(segment: int, value: Column) -> Column:
    return F.struct(F.lit(segment).alias("segment"), value.cast("long").alias("value"))


def links(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """(u, v) of distinct fingerprints ``fp`` that differ in at most ``distance`` bits, u < v."""
    edges = [64 * i // segments for i in range(segments + 1)]
    radius = distance // segments
    stored, probes = [], []
    for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        value = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        ball = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(hi - lo), r)]
        stored.append(_address(i, value))
        probes += [_address(i, value.bitwiseXOR(F.lit(mask))) for mask in ball]
    table = prints.select(F.col("fp").alias("v"), F.explode(F.array(*stored)).alias("at")).select("v", "at.*")
    lookups = prints.select(F.col("fp").alias("u"), F.explode(F.array(*probes)).alias("at")).select("u", "at.*")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    return lookups.join(table, ["segment", "value"]).filter((F.col("u") < F.col("v")) & close).select("u", "v").distinct()


def near_duplicates(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, segments: int = SEGMENTS
) -> DataFrame:
    """The columns of ``docs`` but the text, with ``fp``, ``component_id`` and ``root``.

    Documents whose fingerprints differ in at most ``distance`` bits are linked; a
    component's id is its smallest ``doc_id`` (null if all are null), its root the
    smallest fingerprint.  Equal texts share
    a fingerprint, so links are sought between distinct fingerprints only and copies
    are never paired.  Null and empty texts have fingerprint zero and link like others.
    Every link is found: no bucket is capped.  Columns named like results are replaced.
    """
    marked = cut_lineage(with_fingerprints(docs.drop("component_id", "root"), text, shingle))
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes, distance, segments))
    joined = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = joined.join(smallest, "root").select("fp", "component_id", "root")
    return marked.join(labels, "fp")
