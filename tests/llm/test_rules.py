import re

import pytest
from llm_helpers import edge_docs, empty_docs

from seriesworks.llm import rules

SPACE = re.compile(r"[ \t-\r]+")


def counted(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by brute force."""
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", "   ", "a b c", "a b c a b c", "a a a a a", "x\nx\n\nx y", "é ß\u00a0ü # <> |", "a b c d a b c e f a b", "a b a b a b\x0ba b",
    "one two three\n" * 40,
]


def test_statistics_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id int, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in rules.with_statistics(df).collect():
        assert tuple(r[n] for n in names) == counted(TEXTS[r["doc_id"]]), TEXTS[r["doc_id"]]


def test_estimation_equals_plain_python(spark):
    patterns = [([1, 1, 0], 50), ([1, -1, 1], 7), ([-1, -1, 0], 9), ([0, 0, 0], 3), ([-1, 1, -1], 4)]
    df = spark.createDataFrame(patterns, "votes array<int>, n long")
    import math

    p, good, bad = None, None, None
    q = [1 - rules.START if -1 in v else rules.START for v, _ in patterns]
    for _ in range(rules.ITERATIONS + 1):
        total = sum(n for _, n in patterns)
        p = (sum(n * x for (_, n), x in zip(patterns, q)) + 1) / (total + 2)

        def rate(share, vote, j):
            said = sum(n * s for (v, n), s in zip(patterns, share) if v[j] == vote)
            voted = sum(n * s for (v, n), s in zip(patterns, share) if v[j])
            return min(0.9999, max(0.0001, (said + rules.START * rules.PRIOR_VOTES) / (voted + rules.PRIOR_VOTES)))

        good = [rate(q, 1, j) for j in range(3)]
        bad = [rate([1 - x for x in q], -1, j) for j in range(3)]
        q = []
        for v, _ in patterns:
            z = math.log(p / (1 - p))
            for j, x in enumerate(v):
                z += math.log(good[j] / (1 - bad[j])) if x == 1 else math.log((1 - good[j]) / bad[j]) if x == -1 else 0
            q.append(1 / (1 + math.exp(-z)))
    got = {tuple(r["votes"]): r["posterior"] for r in rules.estimate(df, 3).collect()}
    for (v, _), x in zip(patterns, q):
        assert got[tuple(v)] == pytest.approx(x, rel=1e-9)


def test_odd_rows_and_clashing_columns(spark):
    docs = edge_docs(spark)
    out = rules.apply_rules(docs)
    assert out.count() == docs.count() and len(set(out.columns)) == len(out.columns)
    assert {r["doc_id"] for r in out.filter("base_failed").collect()} >= {1, 2, 3, 6, 8}
    assert out.filter("doc_id = 4").first()["n_words"] == 20_000
    assert out.filter("base_failed AND kept").count() == 0


def test_empty_table(spark):
    assert rules.apply_rules(empty_docs(spark)).count() == 0
