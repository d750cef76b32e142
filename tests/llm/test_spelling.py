import collections
import itertools
import re
import zlib

import numpy as np
import pytest
from llm_helpers import edge_docs, empty_docs, rows
from pyspark.sql import functions as F

from seriesworks.llm import spelling
from seriesworks.llm.queries import op11_spelling_variants

SF = "/root/testdata/sf0.001"


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(texts):
    """{word: (form, root, n, n_near, form_n)} by plain Python."""
    count = collections.Counter()
    for i, text in texts:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            count[word] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    by_size = collections.defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    partners = {w: [v for size in (len(w) - 1, len(w), len(w) + 1) for v in by_size[size] if near(w, v)] for w in n}
    best = {w: min(p, key=lambda v: (-n[v], v)) for w, p in partners.items() if p}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(partners[w]), n[form[w]] if w in form else None)
    return out


def as_dict(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute(docs)
    assert as_dict(op11_spelling_variants(spark, SF)) == want and any(v[0] for v in want.values())


def chains(seed=3):
    """Words of few letters, with long chains of forms, letters above 127 and equal counts."""
    random = np.random.default_rng(seed)
    stems = ["".join(random.choice(list("abé"), 6)) for _ in range(40)]
    text = []
    for k, stem in enumerate(stems):
        text += [stem] * int(5 ** (1 + k % 4)) + [stem + "c"] * 5 + [stem[:3] + "ÿ" + stem[4:]] * 30
    return [(int(i), " ".join(t)) for i, t in enumerate(np.array_split(np.array(text), 9))]


@pytest.mark.parametrize("tile", [spelling.TILE, 7, 2])
def test_split_blocks_lose_and_repeat_nothing(spark, tile):
    docs = chains()
    want = brute(docs)
    words = spark.createDataFrame([(w, v[2]) for w, v in want.items()], "word string, n long")
    got = {r["word"]: r["n_near"] for r in spelling.neighbours(words, tile).collect()}
    assert got == {w: v[3] for w, v in want.items() if v[3]}
    assert as_dict(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"))) == want


def test_one_edit_equals_definition():
    random = np.random.default_rng(1)
    words = ["".join(random.choice(list("ab"), random.integers(1, 6))) for _ in range(60)]
    pairs = [(a, b) for a, b in itertools.product(words, words) if 0 <= len(b) - len(a) <= 1]
    got = spelling.one_edit([a.encode() for a, _ in pairs], [b.encode() for _, b in pairs])
    assert got.tolist() == [near(a, b) for a, b in pairs]


def test_very_long_words_and_checksums(spark):
    long = "ab" * 3000
    docs = [(1, f"{long} " * 5), (2, f"{long}c " * 6), (None, "ÀÉÿabc " * 7), (3, "x" * 300 + " " + "x" * 299)]
    assert as_dict(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_odd_rows_clashes_and_empty_tables(spark):
    docs = edge_docs(spark).withColumns({c: F.lit("clash") for c in ("word", "form", "near")})
    assert as_dict(spelling.variants(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows(spelling.variants(empty_docs(spark))) == []
