import hashlib
import random

import numpy as np
import pytest
import xxhash
from llm_helpers import EDGE, edge_docs, empty_docs, rows
from pyspark.sql import functions as F

from seriesworks.llm import components, decontaminate, simhash, suffix
from seriesworks.llm.words import ASCII_LOWER


def fingerprint(text):
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ["", " ", "one", "a b c d", "a b c d e", "A b\tC  d e f g " * 9, "é ü ö ä ß"]:
        assert simhash.fingerprint(text.encode()) == fingerprint(text)


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(4)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)]
    out = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    want = groups(links, {x for e in links for x in e})
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert out == {n: want[n] for n in linked}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("segments", [2, 3, 4])
def test_links_equal_all_pairs(spark, segments):
    random.seed(segments)
    prints = [random.getrandbits(64) for _ in range(40)]
    for p in prints[:20]:
        for flips in range(1, 7):
            prints.append(p ^ sum(1 << b for b in random.sample(range(64), flips)))
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    got = rows(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 4, segments))
    want = [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4]
    assert got == sorted(want, key=str)


def test_near_duplicates_of_odd_rows(spark):
    out = simhash.near_duplicates(edge_docs(spark))
    assert out.count() == len(EDGE) and len(set(out.columns)) == len(out.columns)
    ids = {r["doc_id"]: r["component_id"] for r in out.collect()}
    assert ids[1] == ids[2] == ids[3] == 1 and ids[6] == ids[7] == 6 and ids[None] is None
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def order_of(text):
    padded = text + b"\xff" * 64
    return [padded[i : i + 50] for i in range(len(text))]


def test_suffix_order_and_common_prefixes():
    random.seed(2)
    texts = [b"banana", b"mississippi", b"aaaa", b"", b"z", b"ab\xffab\xff" * 9]
    texts += [bytes(random.choices(b"ab\xff", k=random.randrange(400))) for _ in range(40)]
    for text in texts:
        order = suffix.suffix_order(np.frombuffer(text, np.uint8), 50)
        parts = order_of(text)
        assert sorted(order) == list(range(len(text))) and [parts[i] for i in order] == sorted(parts)
        for a, b, n in zip(order, order[1:], suffix.common_prefixes(np.frombuffer(text, np.uint8), order, 50)[1:]):
            same = next((k for k in range(50) if parts[a][k] != parts[b][k]), 50)
            assert n == same


def cut(docs):
    first = {}
    for i, text in docs:
        b, i = (text or "").encode(), 2**63 - 1 if i is None else i
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(i, first.get(b[p : p + 50], i))
    out = []
    for i, text in docs:
        b, own = (text or "").encode(), 2**63 - 1 if i is None else i
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < own:
                gone[p : p + 50] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=str)


def repeated_texts():
    random.seed(6)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "été", "ß", "x"]
    passage = " ".join(random.choices(words, k=60))
    docs = [(i, " ".join(random.choices(words, k=random.randrange(200)))) for i in range(30)]
    docs += [(100 + i, docs[i][1] + passage[i : i + 140] + "!") for i in range(20)]
    docs += [(None, passage), (None, passage), (3, passage), (3, passage), (200, "a" * 500), (201, "b" + "a" * 300), (202, None), (203, "é" * 26)]
    return docs + [(204, "é" * 25), (205, "é" * 24)]


@pytest.mark.parametrize("block", [200, 1 << 22])
def test_cut_repeats_equals_brute_force(spark, block):
    docs = repeated_texts()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(suffix.digest(suffix.cut_repeats(df, block=block))) == cut(docs)


def test_cut_repeats_of_odd_rows(spark):
    docs = edge_docs(spark)
    out = suffix.cut_repeats(docs)
    assert out.count() == len(EDGE) and len(set(out.columns)) == len(out.columns)
    assert rows(suffix.digest(out)) == cut([(r[0], r[1]) for r in EDGE])
    assert suffix.cut_repeats(empty_docs(spark)).count() == 0
    text = suffix.cut_repeats(docs, as_text=True)
    assert dict(text.dtypes)["kept"] == "string"


def test_containment_threshold(spark):
    words = [f"w{i}" for i in range(44)]  # 40 shingles
    items = [(1, " ".join(words)), (2, "too short to count"), (3, None), (4, " ".join(words)), (5, "One two three FOUR five")]
    docs = [
        (10, "x " * 500 + " ".join(words) + " y" * 500),
        (11, " ".join(words[:36])),  # 32 of 40
        (12, " ".join(words[:35])),  # 31 of 40
        (13, None), (14, ""), (15, "one TWO three four five six"), (16, "one two three four"), (None, " ".join(words)), (10, "other text"),
    ]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contained(docs, items).select("doc_id", "item_id", "shared", "shingles")
    assert rows(found) == sorted([(d, i, s, 40) for d, s in ((10, 40), (11, 32), (None, 40)) for i in (1, 4)] + [(15, 5, 1, 1)], key=str)
    left = decontaminate.clean(docs.withColumn("item", F.lit(1)).withColumn("h", F.lit(2)), items)
    assert rows(left.select("doc_id", "text")) == sorted([(10, "other text"), (12, " ".join(words[:35])), (13, None), (14, ""), (16, "one two three four")], key=str)


def test_containment_of_odd_rows(spark):
    items = spark.createDataFrame([(1, "the same text twice here"), (1, "the same text twice here"), (None, "no id but a text")], "item_id long, text string")
    out = decontaminate.contained(edge_docs(spark), items).select("doc_id", "item_id")
    assert rows(out) == sorted([(6, 1), (7, 1), (None, None)], key=str)
    assert decontaminate.clean(empty_docs(spark), items).count() == 0
    assert decontaminate.contained(edge_docs(spark), items.limit(0)).count() == 0
