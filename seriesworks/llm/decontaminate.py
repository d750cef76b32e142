"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item of q word shingles that is contained in a document to a share ``t`` has
at least ``ceil(t * q)`` of its shingles there.  So one of its ``q - ceil(t * q) + 1``
smallest shingle hashes must be among the document's.  Items are partitioned by size,
in powers of two; a partition's MinHash sketches are as long as its largest item needs,
hence no containment is missed.  Documents look their shingle hashes up in the sketches
by an equi-join, and candidates are verified on the shingles themselves.

Long documents get no sketch of their own: a symmetric sketch of a document with a
hundred times the item's shingles agrees with the item's in less than one value in a
hundred, whatever the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .words import lower_ascii, word_array

SHINGLE, CONTAINMENT = 5, 0.8
#: A side of a join is broadcast up to so many rows (under 100 bytes each); beyond, both are shuffled.
BROADCAST_ROWS = 1_000_000


def shingle_hashes(words: Column, n: int = SHINGLE) -> Column:
    """64-bit hashes of the word shingles, repeats included; none with fewer than ``n`` words."""
    at = F.sequence(F.lit(0), F.size(words) - n)
    hashes = F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(n))))
    return F.when(F.size(words) >= n, hashes).otherwise(F.array().cast("array<bigint>"))


def shingles(words: Column, n: int = SHINGLE) -> Column:
    """Distinct word shingles, as texts with single blanks."""
    at = F.sequence(F.lit(1), F.size(words) - n + 1)
    texts = F.transform(at, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= n, F.array_distinct(texts)).otherwise(F.array().cast("array<string>"))


def sketches(items: DataFrame, item: str = "item_id", text: str = "text", n: int = SHINGLE, share: float = CONTAINMENT) -> DataFrame:
    """(item, h): the smallest shingle hashes of each item, as many as its size partition needs."""
    upper = F.pow(F.lit(2), F.length(F.bin(F.size("hashes")))) - 1  # the partition's largest size
    enough = (upper - F.ceil(upper * F.lit(share) - 1e-9) + 1).cast("int")
    return (
        items.select(F.col(item).alias("item"), word_array(lower_ascii(F.col(text))).alias("words"))
        .withColumn("hashes", F.array_distinct(shingle_hashes(F.col("words"), n)))
        .filter(F.size("hashes") > 0)
        .select("item", F.explode(F.slice(F.sort_array("hashes"), F.lit(1), enough)).alias("h"))
        .distinct()
    )


def _small(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if it is known to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def contained(
    docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    n: int = SHINGLE, share: float = CONTAINMENT,
) -> DataFrame:
    """(doc_id, text_hash, item_id, shared, shingles, containment) of all items found in documents.

    An item is found if at least ``share`` of its distinct shingles of ``n`` words are in
    the document; A to Z are lower-cased.  Items and documents with fewer than ``n``
    words, null ones included, have no shingles and are not found.  Repeated rows count
    once; rows that share a ``doc_id`` but not the text are told apart by ``text_hash``.
    """
    texts = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.col(text).alias("__sw_text")).filter("__sw_text IS NOT NULL")
    worded = texts.withColumn("words", word_array(lower_ascii(F.col("__sw_text"))))
    probes = cut_lineage(sketches(items, item, item_text, n, share))
    hashed = worded.select("doc_id", "text_hash", F.explode(shingle_hashes(F.col("words"), n)).alias("h"))
    candidates = cut_lineage(hashed.join(_small(probes), "h").select("doc_id", "text_hash", "item").distinct())

    found = candidates.select(F.col("doc_id").alias("__sw_id"), F.col("text_hash").alias("__sw_hash")).distinct()
    same = worded["doc_id"].eqNullSafe(F.col("__sw_id")) & (worded["text_hash"] == F.col("__sw_hash"))
    suspects = worded.join(_small(found), same, "left_semi")
    parts = suspects.select("doc_id", "text_hash", F.explode(shingles(F.col("words"), n)).alias("shingle"))
    whole = items.select(F.col(item).alias("item"), shingles(word_array(lower_ascii(F.col(item_text))), n).alias("own"))
    whole = whole.withColumn("shingles", F.size("own").cast("long")).select("item", "shingles", F.explode("own").alias("shingle")).distinct()
    shared = (
        parts.join(_small(whole), "shingle")
        .groupBy("doc_id", "text_hash", "item", "shingles")
        .agg(F.countDistinct("shingle").alias("shared"))
    )
    pairs = candidates.select(F.col("doc_id").alias("__sw_id"), F.col("text_hash").alias("__sw_hash"), F.col("item").alias("__sw_item"))
    of_pair = shared["doc_id"].eqNullSafe(F.col("__sw_id")) & (shared["text_hash"] == F.col("__sw_hash")) & (shared["item"].eqNullSafe(F.col("__sw_item")))
    return (
        shared.join(pairs, of_pair, "left_semi")
        .withColumn("containment", F.col("shared") / F.col("shingles"))
        .filter(F.col("containment") >= share)
        .select("doc_id", "text_hash", F.col("item").alias("item_id"), "shared", "shingles", "containment")
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    found = contained(docs, items, text, **options).select(F.col("doc_id").alias("__sw_id"), F.col("text_hash").alias("__sw_hash")).distinct()
    found = cut_lineage(found)
    return docs.join(_small(found), docs["doc_id"].eqNullSafe(F.col("__sw_id")) & (F.xxhash64(docs[text]) == F.col("__sw_hash")), "left_anti")
