"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, decontaminate, langid, lm, mixing, phrases, rules, simhash, spelling, suffix, toxicity, urls, wrappers
from .arrow_text import small_batches
from .words import bucket


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = classifier.classify(docs.select("doc_id", "text", "n_chars"), labels, bucket(F.col("doc_id"), 5) != 0)
    return scored.select("doc_id", (bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, mixture = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixing.taken_words(documents, mixture).select("doc_id", "size", "source_size", "target", "taken")


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = bucket(F.col("doc_id"), 7)
    scored = lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), fold != 2)
    return scored.select(
        "doc_id", (fold == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return decontaminate.contained(docs, items).drop("text_hash")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest(suffix.cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The rules of the query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), filters)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = bucket(F.col("doc_id"), 5)
    named = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), fold != 0)
    return named.select("doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = bucket(F.col("doc_id"), 5)
    scored = toxicity.classify(docs.select("doc_id", "text"), labels, fold != 0)
    return scored.select(
        "doc_id", (fold == 0).alias("held_out"), "score", "predicted", "n_sentences", F.size("offending").alias("n_offending")
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_mixing": op3_mixing,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_decontamination": op5_decontamination,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_simhash": op7_simhash,
        "op8_url_filters": op8_url_filters,
        "op9_html_extraction": op9_html_extraction,
        "op10_language_id": op10_language_id,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_toxicity": op12_toxicity,
        "op13_phrases": op13_phrases,
        "pipeline": pipeline,
    }


def oracles() -> dict[str, str]:
    from . import oracles as sql

    return sql.oracles()
