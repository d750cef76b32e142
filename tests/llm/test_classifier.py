import numpy as np
import pyarrow as pa
from llm_helpers import edge_docs, empty_docs
from pyspark.sql import functions as F

from seriesworks.llm import classifier
from seriesworks.llm.arrow_text import chunks, word_spans
from seriesworks.llm.words import bucket


def test_word_spans_equal_split():
    texts = ["a bc\td", "", "  ", "x", "é ü\n", " end", "start "]
    for _, _, raw, at in chunks(pa.array(texts)):
        start, end, row = word_spans(raw, at)
        got = [(int(r), bytes(raw[s:e]).decode()) for s, e, r in zip(start, end, row)]
    assert got == [(i, w.decode()) for i, t in enumerate(texts) for w in t.encode().split()]


def test_sum_of_squares_identity_equals_all_pairs():
    random = np.random.default_rng(0)
    n = 40
    machine = classifier.Machine(0.3, random.normal(size=n).astype(np.float32), random.normal(size=(n, 4)).astype(np.float32))
    row, inputs, values = np.array([0, 0, 0, 1, 1]), np.array([3, 7, 20, 7, 39]), np.array([1, 0.5, 2, 1, -1], np.float32)
    want = []
    for r in (0, 1):
        own = np.flatnonzero(row == r)
        z = 0.3 + sum(machine.linear[inputs[i]] * values[i] for i in own)
        z += sum(machine.vectors[inputs[i]] @ machine.vectors[inputs[j]] * values[i] * values[j] for i in own for j in own if i < j)
        want.append(z)
    np.testing.assert_allclose(machine.logits(row, inputs, values), want, rtol=1e-5)


def test_held_out_accuracy(spark):
    from seriesworks.llm.queries import op2_quality_classifier, table

    sf_dir = "/root/testdata/sf0.01"
    scored = op2_quality_classifier(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").filter("held_out")
    good, total = scored.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert good / total > 0.95


def test_odd_rows_clashes_and_bounds(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (6, 0), (8, 0), (99, 1), (7, None)], "doc_id long, quality int")
    out = classifier.classify(docs, labels, bucket(F.col("doc_id"), 5) >= 0)
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == docs.count()
    assert out.filter("score IS NULL OR score < 0 OR score > 1 OR predicted <> cast(score >= 0.3 AS int)").count() == 0
    twice = [r["score"] for r in out.filter("doc_id = 6").collect()]
    assert twice[0] == twice[1]


def test_no_usable_labels_and_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = edge_docs(spark, extra=False)
    assert {r["score"] for r in classifier.classify(docs, labels, F.lit(True)).select(F.round("score", 6).alias("score")).collect()} == {0.5}
    assert classifier.classify(empty_docs(spark), labels, F.lit(True)).count() == 0
