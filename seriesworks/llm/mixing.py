"""Mixing sources to target weights.

The words of a source are packed, document after document, into blocks of fixed
length.  Output shards draw how many slots each source gets; a slot's block comes from
the source's pseudorandom permutation of its block numbers, so a block is used twice
only after all have been used once; slots meet the blocks in an equi-join on
(source, block).  Nothing is sorted or gathered by source: positions within a source
are prefix sums over bounded groups of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .arrow_text import mixed
from .words import word_array

BLOCK_WORDS = 512
WEIGHTS, SHARE, MOST_REPEATS = (3, 1, 2), 1.5, 2
SHARDS, SEED = 64, 11
#: Documents whose positions one task adds up, about; slots that one row expands to.
GROUP_ROWS, RANGE = 1000, 1 << 16


@dataclass
class Source:
    """One source: its number, name, words, target, and slots with their last length."""

    sid: int
    name: str | None
    size: int
    target: float
    slots: int = 0
    last: int = 0


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST_REPEATS) -> list[float]:
    """Share ``total`` by weight; no target exceeds ``most`` sizes, the excess is shared again."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if unit * weights[i] > most * sizes[i]}
        for i in above or open_:
            out[i] = float(most * sizes[i]) if above else unit * weights[i]
        if not above:
            break
        left -= sum(out[i] for i in above)
        open_ -= above
    return out


def _half_bits(n: np.ndarray) -> np.ndarray:
    """Half the bits that the Feistel network for 0..n-1 works on."""
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    while np.any(small := (np.uint64(1) << (2 * bits)) < n.astype(np.uint64)):
        bits = bits + small
    return bits


def permuted(k: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key, applied to ``k``.

    Four Feistel rounds on the next even number of bits; values beyond n go round again.
    """
    bits = _half_bits(n)
    low = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = k.astype(np.uint64), np.arange(len(k))
    while len(todo):
        left, right = out[todo] >> bits[todo], out[todo] & low[todo]
        for r in range(1, 5):
            spin = mixed(right + mixed(key[todo].astype(np.uint64) * np.uint64(8) + np.uint64(r)))
            left, right = right, left ^ (spin & low[todo])
        out[todo] = (left << bits[todo]) | right
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def place_of(block: int, blocks: int, key: int) -> int:
    """The k that ``permuted`` takes to ``block``: the rounds backwards, whatever the number of blocks."""
    one = np.array([blocks])
    bits = _half_bits(one)
    low = (np.uint64(1) << bits) - np.uint64(1)
    out = np.array([block], np.uint64)
    while True:
        left, right = out >> bits, out & low
        for r in range(4, 0, -1):
            spin = mixed(left + mixed(np.array([key]).astype(np.uint64) * np.uint64(8) + np.uint64(r)))
            left, right = right ^ (spin & low), left
        out = (left << bits) | right
        if out[0] < blocks:
            return int(out[0])


def plan_slots(source: Source, length: int, seed: int) -> None:
    """How many slots reach the target, and how many words the last of them takes.

    All blocks are full but the last one, whose place in the permutation is where the
    running total of words falls behind.
    """
    want = round(source.target)
    if want <= 0 or source.size <= 0:
        source.slots = source.last = 0
        return
    blocks = -(-source.size // length)
    rounds, rest = divmod(want, source.size)
    if rest == 0:
        source.slots, source.last = rounds * blocks, length
        return
    tail = source.size - (blocks - 1) * length
    at = place_of(blocks - 1, blocks, seed)
    full = -(-rest // length)
    if at >= full:  # the short block comes later
        source.slots, source.last = rounds * blocks + full, rest - (full - 1) * length
    else:
        more = -(-max(0, rest - tail) // length)
        used = max(more + 1, at + 1)
        taken = rest - (used - 1) * length if used - 1 == at else rest - tail - (used - 2) * length
        source.slots, source.last = rounds * blocks + used, taken


def draw(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each shard.

    A shard's counts are multinomial, with the sources' slots left as weights; what
    exceeds a source's slots is drawn again, so that all slots are dealt in the end.
    """
    random, left = np.random.default_rng(seed), np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for shard in range(shards):
        need = -(-int(left.sum()) // (shards - shard))
        while need:
            got = np.minimum(random.multinomial(need, left / left.sum()), left)
            out[shard] += got
            left -= got
            need -= int(got.sum())
    return out


def read_sources(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS) -> list[Source]:
    """Sources by code point, null last; weights repeat in that order.  One row per source."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"] or 0) for r in rows]
    shares = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))], share * sum(sizes), most)
    return [Source(i, r["source"], z, t) for i, (r, z, t) in enumerate(zip(rows, sizes, shares, strict=True))]


def positioned(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, source, text_hash, size, start): where each document starts among its source's words.

    Documents are dealt into groups by a hash of the id, as many as their source has
    ``GROUP_ROWS`` rows; a group's start is the sum of its source's groups before it, added
    up first over ranges of ``GROUP_ROWS`` groups, then inside each range.  Null texts have no words.
    """
    kept = docs.select("doc_id", "source", F.xxhash64(text).alias("text_hash"), F.size(word_array(F.col(text))).cast("long").alias("size"))
    sized = cut_lineage(kept)
    groups = sized.groupBy(F.col("source").alias("__sw_source")).agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("__sw_groups"))
    counted = sized.join(F.broadcast(groups), sized["source"].eqNullSafe(F.col("__sw_source"))).drop("__sw_source")  # a row per source
    sized = counted.withColumn("__sw_group", F.pmod(F.xxhash64("doc_id", "text_hash"), "__sw_groups")).drop("__sw_groups")
    inside = Window.partitionBy("source", "__sw_group").orderBy("doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    span = F.expr(f"__sw_group div {GROUP_ROWS}").alias("__sw_range")
    words = sized.groupBy("source", span, "__sw_group").agg(F.sum("size").alias("__sw_words"))
    earlier = Window.partitionBy("source").orderBy("__sw_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (  # a row for a million documents of a source
        words.groupBy("source", "__sw_range").agg(F.sum("__sw_words").alias("__sw_all"))
        .withColumn("__sw_base", F.coalesce(F.sum("__sw_all").over(earlier), F.lit(0)))
        .select(F.col("source").alias("__sw_src"), F.col("__sw_range").alias("__sw_r"), "__sw_base")
    )
    before = Window.partitionBy("source", "__sw_range").orderBy("__sw_group").rowsBetween(Window.unboundedPreceding, -1)
    within = words.withColumn("__sw_first", F.coalesce(F.sum("__sw_words").over(before), F.lit(0)))
    firsts = within.join(ranges, within["source"].eqNullSafe(ranges["__sw_src"]) & (within["__sw_range"] == ranges["__sw_r"])).select(
        F.col("source").alias("__sw_source"), F.col("__sw_group").alias("__sw_g"), (F.col("__sw_base") + F.col("__sw_first")).alias("__sw_first")
    )
    placed = sized.withColumn("__sw_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = placed["source"].eqNullSafe(firsts["__sw_source"]) & (placed["__sw_group"] == firsts["__sw_g"])
    return placed.join(firsts, same).select("doc_id", "source", "text_hash", "size", (F.col("__sw_first") + F.col("__sw_inside")).alias("start"))


def slot_table(spark: SparkSession, sources: list[Source], length: int, shards: int, seed: int) -> DataFrame:
    """(shard, sid, slot, block, take): the block of every slot and the words it takes of it."""
    counts = draw([s.slots for s in sources], shards, seed)
    starts = np.cumsum(counts, axis=0) - counts
    rows = [
        (shard, s.sid, int(starts[shard, i]), int(counts[shard, i]), -(-s.size // length), s.slots - 1, s.last)
        for shard in range(shards) for i, s in enumerate(sources) if counts[shard, i]
    ]
    schema = "shard int, sid int, first long, n long, blocks long, final long, last long"
    ranges = spark.createDataFrame(rows, schema).withColumn("part", F.explode(F.sequence(F.lit(0), F.expr(f"cast((n - 1) div {RANGE} as int)"))))
    slots = (
        ranges.repartition("shard", "sid", "part")
        .withColumn("slot", F.explode(F.expr(f"sequence(first + part * {RANGE}L, first + least(n, (part + 1) * {RANGE}L) - 1)")))
        .select("shard", "sid", "slot", "blocks", F.when(F.col("slot") == F.col("final"), F.col("last")).otherwise(F.lit(length)).alias("take"))
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slot, blocks, sid = (b[c].to_numpy(zero_copy_only=False) for c in ("slot", "blocks", "sid"))
            block = permuted(slot % blocks, blocks, sid.astype(np.int64) + seed * 1_000_003)
            yield pa.RecordBatch.from_arrays([b["shard"], b["sid"], b["slot"], pa.array(block), b["take"]], names=["shard", "sid", "slot", "block", "take"])

    return slots.mapInArrow(placed, "shard int, sid int, slot long, block long, take long")


def mix(
    docs: DataFrame, text: str = "text", weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS,
    block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(documents, mixture) of a mix of ``docs`` (doc_id, source, text).

    ``documents``: doc_id, source, text_hash, size, start, sid, source_size, target.
    ``mixture``: one row for each piece of a document in a slot: shard, position (sorts
    the slots of a shard), sid, slot, block, start (the document's), from_word and
    n_words.  A source's words add up to its rounded target; its blocks are used evenly,
    so no document is taken more than ``most`` times.  The same input and seed give the
    same mix.  Sources without words get nothing; an empty table gives empty results;
    repeated rows count as further documents.
    """
    spark = docs.sparkSession
    sized = cut_lineage(positioned(docs, text))
    sources = read_sources(sized, weights, share, most)
    for s in sources:
        plan_slots(s, block_words, s.sid + seed * 1_000_003)
    names = spark.createDataFrame(
        [(s.sid, s.name, s.size, s.target) for s in sources], "sid int, __sw_source string, source_size long, target double"
    )
    documents = sized.join(F.broadcast(names), sized["source"].eqNullSafe(names["__sw_source"])).drop("__sw_source")  # a row per source
    pieces = (
        documents.filter("size > 0")
        .withColumn("block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
        .select(
            "sid", "block", "start",
            F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)).alias("lo"),
            F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words)).alias("hi"),
        )
    )
    slots = slot_table(spark, sources, block_words, shards, seed)
    mixture = (
        # the planner takes slots, made of a few ranges, for a small table: both sides grow with the words
        slots.hint("merge").join(pieces, ["sid", "block"])
        .withColumn("n_words", F.least("hi", "take") - F.col("lo"))
        .filter("n_words > 0")
        .select(
            "shard", F.xxhash64(F.lit(seed), "shard", "sid", "slot").alias("position"), "sid", "slot", "block", "start",
            (F.col("block") * block_words + F.col("lo") - F.col("start")).alias("from_word"), "n_words",
        )
    )
    return documents, mixture


def taken_words(documents: DataFrame, mixture: DataFrame) -> DataFrame:
    """``documents`` with ``taken``, the words that the mixture takes of each, repeats counted."""
    sums = mixture.groupBy("sid", "start").agg(F.sum("n_words").alias("__sw_taken"))
    worded = documents.filter("size > 0").join(sums, ["sid", "start"], "left")
    return worded.withColumn("taken", F.coalesce("__sw_taken", F.lit(0))).drop("__sw_taken").unionByName(
        documents.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    )


def mixed_text(docs: DataFrame, documents: DataFrame, mixture: DataFrame, text: str = "text") -> DataFrame:
    """The mixture's pieces with their words (shard, position, slot, start, piece)."""
    key = docs.select(F.col("doc_id").alias("__sw_id"), F.col("source").alias("__sw_src"), F.xxhash64(text).alias("__sw_hash"), F.col(text).alias("__sw_text"))
    key = key.dropDuplicates(["__sw_id", "__sw_src", "__sw_hash"])
    same = documents["doc_id"].eqNullSafe(key["__sw_id"]) & documents["source"].eqNullSafe(key["__sw_src"]) & (documents["text_hash"] == key["__sw_hash"])
    words = documents.filter("size > 0").join(key, same).select("sid", "start", word_array(F.col("__sw_text")).alias("__sw_words"))
    piece = F.array_join(F.slice("__sw_words", F.col("from_word").cast("int") + 1, F.col("n_words").cast("int")), " ")
    return mixture.join(words, ["sid", "start"]).select("shard", "position", "sid", "slot", "start", "from_word", piece.alias("piece"))
