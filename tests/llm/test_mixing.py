import numpy as np
import pytest
from llm_helpers import edge_docs, empty_docs

from seriesworks.llm import mixing


def test_targets_stop_at_twice_the_size():
    sizes, weights = [100, 10, 1000, 0], [3, 1, 2, 3]
    got = mixing.targets(sizes, weights, 1.5 * sum(sizes))
    assert sum(got) == pytest.approx(1.5 * sum(sizes))
    assert all(t <= 2 * z for t, z in zip(got, sizes)) and got[3] == 0 and got[0] == 200 and got[1] == 20


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_permutation(n):
    k = np.arange(n)
    out = mixing.permuted(k, np.full(n, n), np.full(n, 5))
    assert sorted(out) == list(range(n))
    assert n < 10 or (out != k).sum() > n // 2


@pytest.mark.parametrize("size", [1, 7, 8, 9, 63, 64, 65, 200])
def test_slots_take_exactly_the_target(size):
    length = 8
    for want in range(0, 2 * size + 1):
        s = mixing.Source(0, "x", size, float(want))
        mixing.plan_slots(s, length, 99)
        blocks = -(-size // length)
        order = mixing.permuted(np.arange(blocks), np.full(blocks, blocks), np.full(blocks, 99))
        tail = size - (blocks - 1) * length
        words = [tail if order[j % blocks] == blocks - 1 else length for j in range(s.slots)]
        if words:
            words[-1] = min(words[-1], s.last)
        assert sum(words) == want and s.slots <= 2 * blocks


def test_draw_deals_all_slots():
    counts = mixing.draw([100, 0, 7, 1000], 16, 3)
    assert counts.sum(axis=0).tolist() == [100, 0, 7, 1000] and counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 1


def test_taken_words_and_reruns(spark):
    docs = spark.createDataFrame(
        [(i, f"s{i % 4}" if i % 7 else None, " ".join(f"w{j}" for j in range(i % 50))) for i in range(400)], "doc_id long, source string, text string"
    )
    runs = []
    for _ in range(2):
        documents, mixture = mixing.mix(docs, block_words=16, shards=4)
        out = mixing.taken_words(documents, mixture).toPandas().sort_values("doc_id")
        runs.append(out)
    assert runs[0]["taken"].tolist() == runs[1]["taken"].tolist()
    out = runs[0]
    assert (out["taken"] <= 2 * out["size"]).all() and len(out) == 400
    for _, g in out.groupby("source", dropna=False):
        assert g["taken"].sum() == round(g["target"].iloc[0]) and g["size"].sum() == g["source_size"].iloc[0]
    pieces = mixing.mixed_text(docs, *mixing.mix(docs, block_words=16, shards=4)).collect()
    assert sum(len(p["piece"].split()) for p in pieces) == out["taken"].sum()


def test_odd_rows_and_empty_table(spark):
    documents, mixture = mixing.mix(edge_docs(spark), block_words=32, shards=3)
    out = mixing.taken_words(documents, mixture).toPandas()
    assert len(out) == 10 and out.loc[out["doc_id"] == 1, "taken"].tolist() == [0]
    documents, mixture = mixing.mix(empty_docs(spark))
    assert documents.count() == 0 and mixture.count() == 0 and mixing.taken_words(documents, mixture).count() == 0


def test_the_place_of_a_block_is_found_backwards():
    for blocks in (1, 2, 3, 5, 64, 1000, 4097):
        for key in (0, 11, 1_000_014):
            order = mixing.permuted(np.arange(blocks), np.full(blocks, blocks), np.full(blocks, key))
            assert [mixing.place_of(b, blocks, key) for b in (0, blocks // 2, blocks - 1)] == [int(np.flatnonzero(order == b)[0]) for b in (0, blocks // 2, blocks - 1)]
    huge = 2 * 10**10
    at = mixing.place_of(huge - 1, huge, 3)
    assert mixing.permuted(np.array([at]), np.array([huge]), np.array([3]))[0] == huge - 1
