import numpy as np
import pyarrow as pa
from llm_helpers import edge_docs, empty_docs
from pyspark.sql import functions as F

from seriesworks.llm import toxicity
from seriesworks.llm.arrow_text import chunks
from seriesworks.llm.words import bucket


def test_noisy_or_and_its_slope_equal_the_definition():
    random = np.random.default_rng(0)
    z, row = random.normal(size=7), np.array([0, 0, 1, 1, 1, 3, 3])
    model = toxicity.SentenceModel(0.0, -2.0, np.zeros(1))
    p, leak = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(2.0))
    want = [1 - (1 - leak) * np.prod(1 - p[row == r]) for r in range(4)]
    np.testing.assert_allclose(model.noisy_or(row, z, 4), want, rtol=1e-12)
    # -log P grows by -p (1 - P) / P with a sentence's logit
    up = model.noisy_or(row, z + 1e-6 * (np.arange(7) == 2), 4)[1]
    assert abs((np.log(up) - np.log(want[1])) / 1e-6 - p[2] * (1 - want[1]) / want[1]) < 1e-4


def test_sentences_and_their_inputs():
    texts = ["One two. Three!\nfour\n\n five", "", None, "é.é", "no stop", " . ! ", "One"]
    for _, _, raw, at in chunks(pa.array(texts)):
        row, start, end, sentence, inputs = toxicity.sentences(raw, at)
    got = [(int(r), raw[s:e].tobytes().decode()) for r, s, e in zip(row, start, end)]
    assert got == [(0, "One two"), (0, "Three"), (0, "four"), (0, "five"), (3, "é"), (3, "é"), (4, "no stop"), (6, "One")]
    own = [set(inputs[sentence == i].tolist()) for i in range(len(row))]
    assert own[4] == own[5] and own[7] < own[0] and len(own[1]) == 2  # "three" and its beginning of four bytes


def test_held_out_accuracy_and_offending_sentences(spark):
    from seriesworks.llm.queries import op12_toxicity, table

    sf_dir = "/root/testdata/sf0.1"
    labels = table(spark, sf_dir, "labels")
    held = op12_toxicity(spark, sf_dir).join(labels, "doc_id").filter("held_out AND quality = 1")
    hits, toxic, false, clean = held.agg(
        F.sum(F.col("predicted") * F.col("toxic")), F.sum("toxic"), F.sum(F.col("predicted") * (1 - F.col("toxic"))), F.sum(1 - F.col("toxic"))
    ).first()
    assert hits / toxic > 0.9 and false / clean < 0.02


def test_blame_goes_to_the_bad_sentence(spark):
    random = np.random.default_rng(5)
    words = [f"wort{i}" for i in range(50)]

    def sentence(extra=""):
        return " ".join(random.choice(words, 6)) + f" {extra}."

    docs = [(i, " ".join([sentence(), sentence("vile" if i % 3 == 0 else ""), sentence()])) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    out = toxicity.classify(df, labels, F.col("doc_id") < 150).filter("doc_id >= 150").collect()
    for r in out:
        assert r["predicted"] == int(r["doc_id"] % 3 == 0) and r["n_sentences"] == 3
        assert [("vile" in o["sentence"]) for o in r["offending"]] == [True] * r["predicted"]


def test_odd_rows_clashes_and_bounds(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (6, 0), (8, 0), (99, 1), (7, None)], "doc_id long, toxic int")
    out = toxicity.classify(docs, labels, bucket(F.col("doc_id"), 5) >= 0)
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    assert out.filter("score IS NULL OR score < 0 OR score > 1 OR predicted <> cast(score >= 0.5 AS int)").count() == 0
    assert len({r["score"] for r in out.filter("doc_id IN (1, 2, 3)").collect()}) == 1  # the leak
    assert len({r["score"] for r in out.filter("doc_id = 6").collect()}) == 1


def test_no_usable_labels_and_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = edge_docs(spark, extra=False)
    assert {r["s"] for r in toxicity.classify(docs, labels, F.lit(True)).select(F.round("score", 6).alias("s")).collect()} == {0.5}
    assert toxicity.classify(empty_docs(spark), labels, F.lit(True)).count() == 0
