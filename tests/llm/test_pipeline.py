import corpus_pipeline
import pytest
from llm_helpers import edge_docs, empty_docs

from seriesworks.llm import decontaminate, simhash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == COLUMNS and out.dtypes == docs.dtypes
        docs = spark.createDataFrame(out.collect(), out.schema)
    left = docs.collect()
    assert 0 < len(left) < before
    assert decontaminate.contained(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    prints = [simhash.fingerprint((r["text"] or "").encode()) for r in corpus_pipeline.simhash_near_duplicates(spark, docs, SF).collect()]
    assert all(bin(a ^ b).count("1") > 4 for i, a in enumerate(prints) for b in prints[:i])
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    assert len(mixed) == len(left) and (mixed["taken"] <= 2 * mixed["size"]).all()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert out["doc_id"].is_unique
    for _, g in out.merge(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").toPandas()).groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 0.5


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_and_empty_tables(spark, name, stage):
    docs = edge_docs(spark)
    out = stage(spark, docs, SF)
    assert out.count() <= docs.count()
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == docs.columns
    if name.startswith("SimHash"):
        assert out.filter("doc_id IN (1, 2, 3)").count() == 1 and out.filter("doc_id IN (6, 7)").count() == 1
    if name.startswith("suffix"):
        assert out.filter("doc_id = 1").first()["text"] is None
    assert stage(spark, empty_docs(spark), SF).count() == 0
