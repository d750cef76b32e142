import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import edge_docs, empty_docs
from pyspark.sql import functions as F

from seriesworks.llm import langid, lm, ppm
from seriesworks.llm.arrow_text import chunks
from seriesworks.llm.queries import op10_language_id
from seriesworks.llm.words import ASCII_LOWER, bucket

TEXTS = ["the cat sat on the mat", "The dog sat", "", "aaaaaaab", "été à la mer", "the the the", "xyz \x00 \n"]


def counts_of(texts, depth):
    found, n = [defaultdict(Counter) for _ in range(depth + 1)], 0
    for t in texts:
        s = b"\xff" * depth + t.encode().translate(ASCII_LOWER) + b"\xff"
        for i in range(depth, len(s)):
            n += 1
            for k in range(depth + 1):
                found[k][s[i - k : i]][s[i]] += 1
    return found, n


def brute(found, n, depth, least, text):
    s, out = b"\xff" * depth + text.encode().translate(ASCII_LOWER) + b"\xff", 0.0
    for i in range(depth, len(s)):
        excluded, done = set(), False
        for k in range(depth, -1, -1):
            c = found[k].get(s[i - k : i], {})
            kept = {x: m - ppm.DISCOUNT for x, m in c.items() if m >= least * n}
            if not kept:
                continue
            escape = sum(c.values()) - sum(kept.values())
            if excluded:
                escape = max(escape - ppm.DISCOUNT * len(excluded), ppm.DISCOUNT / 2)
            whole = escape + sum(m for x, m in kept.items() if x not in excluded)
            if s[i] in kept and s[i] not in excluded:
                out += math.log(kept[s[i]] / whole)
                done = True
                break
            out += math.log(escape / whole)
            excluded |= set(kept)
        if not done:
            out -= math.log(256 - len(excluded))
    return out


@pytest.mark.parametrize("depth,least", [(1, 0), (3, 0), (4, 0.02), (6, 0)])
def test_probabilities_equal_brute_force(spark, depth, least):
    df = spark.createDataFrame([(i % 2, t) for i, t in enumerate(TEXTS)], "m int, text string")
    trie = ppm.Trie.from_arrays(ppm.Trie(ppm.learn(df, depth, least, "m"), 2, depth).arrays())
    tests = [*TEXTS, "the unseen zebra", "ÿ?"]
    for _, _, raw, at in chunks(pa.array(tests)):
        got = trie.log_probability(raw, at)
    for m in (0, 1):
        found, n = counts_of(TEXTS[m::2], depth)
        np.testing.assert_allclose(got[:, m], [brute(found, n, depth, least, t) for t in tests], rtol=1e-5)


def test_first_byte_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(0, t) for t in TEXTS], "m int, text string")
    trie = ppm.Trie(ppm.learn(df, 2, 0, "m"), 1, 2)
    logs = []
    for b in range(256):
        key = np.array([(0xFFFF << 8) | b], np.uint64)
        row = trie.grams[2].find(key)
        if row[0] >= 0:
            logs.append(trie.logs[2][row[0], 0])
            continue
        up = trie.contexts[2].find(key >> np.uint64(8))[0]
        row = trie.grams[1].find(key & ppm.mask(1))
        if row[0] >= 0:
            logs.append(trie.logs[1][row[0], 0] + (trie.escape_seen if trie.seen[1][row[0], 0] else trie.escape_past)[2][up, 0])
            continue
        up1 = trie.contexts[1].find((key & ppm.mask(1)) >> np.uint64(8))[0]
        logs.append(trie.escape_past[2][up, 0] + (trie.escape_seen if trie.seen[0][b, 0] else trie.escape_past)[1][up1, 0] + trie.logs[0][b, 0])
    assert np.exp(np.array(logs, float)).sum() == pytest.approx(1, abs=1e-4)


def test_word_model_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    out = {r["doc_id"]: r for r in lm.score(docs, bucket(F.col("doc_id"), 7) != 2, frequent=0.001).collect()}
    tokens = {r["doc_id"]: [*(r["text"] or "").encode().translate(ASCII_LOWER).split(), None] for r in docs.collect()}
    c = Counter()
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(t)
    n, v = sum(c.values()), len(c)
    for i, t in tokens.items():
        r = out[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[x] > 0 for x in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), abs=1e-6)
        assert r["score"] < 0


@pytest.mark.parametrize("depth,held", [(6, 0), (6, 40)])
def test_scores_keep_every_gram_at_any_size(spark, depth, held):
    # 4 MB of other text, so that one occurrence is below a share of 2**-21 of the bytes
    few, filler, times = [*TEXTS, "the unseen zebra", "ÿ?", "a"], "filler words " * 20_000, 16
    df = spark.createDataFrame(list(enumerate(few)) + [(100 + 2 * i, filler) for i in range(times)], "doc_id long, text string")
    found, n = counts_of(few[::2], depth)
    more, size = counts_of([filler], depth)
    for mine, other in zip(found, more, strict=True):
        for context, symbols in other.items():
            for symbol, count in symbols.items():
                mine[context][symbol] += times * count
    assert n + times * size > 2**21
    got = {r["doc_id"]: r["score"] for r in lm.score(df, F.col("doc_id") % 2 == 0, depth=depth, held=held).collect()}
    assert len(got) == len(few) + times
    for i, text in enumerate(few):
        assert got[i] == pytest.approx(brute(found, n, depth, 0, text) / math.log(10), rel=1e-6)


def test_scores_of_odd_rows(spark):
    docs = edge_docs(spark)
    out = lm.score(docs, F.col("doc_id").isNotNull())
    assert out.count() == docs.count() and len(set(out.columns)) == len(out.columns)
    assert {r["n_tokens"] for r in out.filter("doc_id IN (1, 2, 3)").collect()} == {1}
    assert out.filter("score IS NULL OR base_score IS NULL").count() == 0
    untrained = lm.score(docs, F.lit(False))
    r = untrained.filter("doc_id = 2").first()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] == pytest.approx(-math.log10(256), rel=1e-5)
    assert lm.score(empty_docs(spark), F.lit(True)).count() == 0


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = op10_language_id(spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out")
    good, total = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert good / total > 0.98


def test_languages_of_odd_rows(spark):
    docs = edge_docs(spark)
    out = langid.identify(docs, F.lit(True))
    assert out.count() == docs.count() and len(set(out.columns)) == len(out.columns)
    assert {r["lang_pred"] for r in out.filter("doc_id IN (1, 2, 3)").collect()} == {"und"}
    assert {r["lang_pred"] for r in out.collect()} <= {"und", "en", "de", "fr"}
    assert out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, F.lit(False)).collect()} == {"und"}
    assert langid.identify(empty_docs(spark), F.lit(True)).count() == 0
