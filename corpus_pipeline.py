"""Training corpus from raw documents: classify, drop near-duplicates, cut repeats, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.  :func:`run` writes each stage's result to the shared
folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesworks.llm import classifier, decontaminate, mixing, simhash, suffix
from seriesworks.llm.arrow_text import small_batches
from seriesworks.llm.words import bucket
from seriesworks.session import cut_lineage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine predicts to be good."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = classifier.classify(docs, labels, bucket(F.col("doc_id"), 5) != 0)
    return scored.filter("predicted = 1").select(docs.columns)


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the smallest id, of equal ids the smallest text hash."""
    small_batches(spark)
    keys = {"_k1": F.xxhash64("doc_id", "text"), "_k2": F.xxhash64("text", "doc_id")}
    found = simhash.near_duplicates(docs.select("doc_id", "text").withColumns(keys))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_k1", "_k2")).alias("first")
    stay = found.groupBy("root").agg(first).select("first._k1", "first._k2")
    return docs.withColumns(keys).join(stay, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"]).select(docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 50 bytes that a smaller id has; what is cut in a character goes whole."""
    small_batches(spark)
    cut = suffix.cut_repeats(docs, as_text=True).withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept")))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document."""
    documents, mixture = mixing.mix(docs.select("doc_id", "source", "text"))
    return mixing.taken_words(documents, mixture).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_duplicates),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_to_weights),
]

#: No SQL for the classifier, the fingerprints and the draws.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
