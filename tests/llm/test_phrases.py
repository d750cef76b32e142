import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import edge_docs, empty_docs, rows
from pyspark.sql import functions as F

from seriesworks.llm import phrases
from seriesworks.llm.arrow_text import LOWER, chunks


def pieces_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def brute(docs, least, top):
    """The result rows by plain Python."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        own = {p: a for p, a in count.items() if a >= least and len(p) > 1}
        found = []
        for p, a in own.items():
            longer = (q for q in own if len(q) > len(p) and own[q] >= a)
            if any(p == q[i : i + len(p)] for q in longer for i in range(len(q) - len(p) + 1)):
                continue
            cuts = [(1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (score, a, p, le, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, le, r, n[lang], -score))
    return sorted(out, key=str)


def some_docs(seed=0, rows=60):
    random = np.random.default_rng(seed)
    words = ["a", "B", "é", "the", "zz", "a b", "en", "es"]
    gaps = [" ", " ", " ", "  ", "\t", ", ", ".\n", " \x0b "]
    docs = []
    for i in range(rows):
        text = "".join(str(w) + str(g) for w, g in zip(random.choice(words, 80), random.choice(gaps, 80)))
        docs.append(([None, "en", "es", "und"][i % 4], text))
    return docs + docs[:7] * 3


@pytest.mark.parametrize("period", [1, 3, 32, 10**9])
def test_any_parse_counts_each_phrase_once(spark, period):
    docs = some_docs()
    df = spark.createDataFrame(docs, "lang string, text string")
    assert rows(phrases.collocations(df, least=4, top=15, period=period)) == brute(docs, 4, 15)


def test_chunks_cover_the_text_and_depend_on_content_only():
    passage = " ".join(f"w{i % 37} v{i}" for i in range(400))
    texts = [passage, "other words first. " + passage + " and after", "", None, "one", " , . "]
    for _, _, raw, at in chunks(pa.array(texts)):
        row, start, end, own = phrases.parse(raw, at, 8)
        text = LOWER[raw].tobytes()
    cut = [[text[s:e] for s, e, r in zip(start, end, row) if r == i] for i in range(len(texts))]
    assert len(set(cut[0]) & set(cut[1])) >= len(cut[0]) - 2 > 50
    counts = [int(own[row == i].sum()) for i in range(len(texts))]
    assert counts == [sum(map(len, pieces_of(t))) for t in texts]


def test_a_full_bitmap_changes_no_count(spark):
    docs = some_docs(2)
    table = phrases.dictionary(spark.createDataFrame(docs, "lang string, text string")).cache()
    full = np.full(8, 255, np.uint8)  # every look-up is a hit
    pairs = {(r["lang"], r["phrase"]): r["n"] for r in phrases.count_phrases(table, 2, full, 5).collect()}
    want = collections.Counter()
    for lang, text in docs:
        for words in pieces_of(text):
            want.update((lang or "und", " ".join(p)) for p in zip(words, words[1:]))
    assert pairs == {p: a for p, a in want.items() if a >= 5}
    runs = phrases.count_phrases(phrases.frequent_runs(table, full), 3, None, 5).collect()
    assert {(r["lang"], r["phrase"]): r["n"] for r in runs} == {
        (r["lang"], r["phrase"]): r["n"] for r in phrases.count_phrases(table, 3, None, 5).collect()
    }


def test_scores_are_exact_beyond_64_bits(spark):
    big = 4 * 10**12
    counts = spark.createDataFrame([("en", "a b", big + 7, 2), ("en", "a", big + 9, 1), ("en", "b", big + 8, 1)], "lang string, phrase string, n long, size int")
    totals = spark.createDataFrame([("en", 9 * 10**14 + 1)], "lang string, n long")
    row = phrases.cohesion(counts, totals).first()
    assert row["score"] == 1000 * (big + 7) * (9 * 10**14 + 1) // ((big + 9) * (big + 8))


def test_odd_rows_clashes_and_empty_tables(spark):
    docs = edge_docs(spark).withColumns({c: F.lit("clash") for c in ("phrase", "chunk", "size", "rank")})
    want = brute([(r["lang"], r["text"]) for r in docs.collect()], 2, 50)
    assert rows(phrases.collocations(docs, least=2, top=50)) == want and want
    assert rows(phrases.collocations(empty_docs(spark))) == []
