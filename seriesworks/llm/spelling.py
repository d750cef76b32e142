"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

A word is a vector of letter counts.  One inserted or deleted letter moves it by the
squared distance 1, a replaced one by 2, so only pairs at most two apart can be near.
The squared distances of a block of words against another one are a matrix product
(of the counts, extended by the squared lengths); the pairs kept are verified letter
by letter.

Blocks: the letters are dealt into ``GROUPS`` groups, and a word's *shape* is the number
of its letters in each.  Two words one replacement apart lose one letter each to reach
a common shape; a word with an inserted letter loses one to reach the other's shape.  So
a word goes to the blocks of the shapes that it has with one letter less, and to the
block of its own shape, where only words one letter longer look for it.  Words of equal
shape meet in one of their blocks only: each pair of near words is found once.
A block of more than ``TILE`` words is dealt into slices, and each pair of slices is a
block by itself, so that no task holds more than two slices.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesworks.session import cut_lineage

from .arrow_text import LOWER, chunks, kept_powers, lean, mask_spans, span_hashes

#: Groups of letters, and words of a block that are compared at a time.
GROUPS, TILE, ROWS = 12, 4096, 512
#: Words are as long and as frequent as this at least; a form is this many times as frequent as its variant.
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: One in so many (document, word) pairs loses a letter.
NOISE = 199
#: Doublings that surely reach the end of a chain of forms: counts grow by RATIO at each step and are below 2 ** 63.
DOUBLINGS = 5
#: The checksum's table: what a byte that is shifted out leaves behind.
_ZERO_BYTE = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)
#: Longer words have their checksums computed one by one.
_SHORT = 64


def letter_runs(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8 bytes.

    Those code points above 127 are the byte C3 and one more.
    """
    low = raw | 32
    lead = raw == 0xC3
    letter = ((low >= 97) & (low <= 122) & (raw < 128)) | lead
    letter[1:] |= lead[:-1]
    return mask_spans(letter, at)


def noisy_words(raw: np.ndarray, at: np.ndarray, ids: list[bytes], noise: int = NOISE) -> tuple[list[bytes], np.ndarray]:
    """Lower-cased words of the rows, as UTF-8, and their counts; one pair of id and word in ``noise`` loses a letter.

    The checksum of ``<id>:<word>`` is the one of ``<id>:``, carried over as many zero
    bytes as the word has, combined with the word's own: one look-up for each pair.
    """
    low = LOWER[raw]
    start, end, row = letter_runs(low, at)
    if not len(start):
        return [], np.zeros(0, np.int64)
    _, first, word = np.unique(span_hashes(low, start, end, kept_powers), return_index=True, return_inverse=True)
    pair, times = np.unique(row * len(first) + word, return_counts=True)
    row, word = pair // len(first), pair % len(first)
    text = low.tobytes()
    words = [text[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())]
    own = np.array([zlib.crc32(w) for w in words], np.uint32)
    size = (end - start)[first]
    heads = [zlib.crc32(i + b":") for i in ids]
    carried = np.empty((_SHORT + 1, len(ids)), np.uint32)
    carried[0] = heads
    for k in range(_SHORT):
        carried[k + 1] = (carried[k] >> 8) ^ _ZERO_BYTE[carried[k] & 255]
    checksum = carried[np.minimum(size, _SHORT)[word], row] ^ own[word]
    for i in np.flatnonzero(size[word] > _SHORT):
        checksum[i] = zlib.crc32(words[word[i]], heads[row[i]])
    hit = checksum % noise == 0
    counts = np.bincount(word[~hit], weights=times[~hit], minlength=len(words)).astype(np.int64)
    for w, h in zip(word[hit].tolist(), checksum[hit].tolist()):
        letters = words[w].decode()
        cut = h % len(letters)
        words.append((letters[:cut] + letters[cut + 1 :]).encode())
    return words, np.concatenate([counts, times[hit]])


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n): words of at least ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences over all rows."""
    plain = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [i.encode() for i in b["id"].to_pylist()]
            for lo, hi, raw, at in chunks(b["text"]):
                words, n = noisy_words(raw, at, ids[lo:hi])
                long = [(w, c) for w, c in zip(words, n.tolist()) if c and len(w) - w.count(b"\xc3") >= LEAST_LENGTH]
                columns = [pa.array([w for w, _ in long], pa.binary()).cast(pa.string()), pa.array([c for _, c in long], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    found = plain.mapInArrow(lean(count), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def shapes(words: list[bytes]) -> np.ndarray:
    """Letters of each group in each word (Latin-1 bytes); a group holds every GROUPS-th code point."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    row = np.repeat(np.arange(len(words)), size)
    codes = np.frombuffer(b"".join(words), np.uint8) % GROUPS
    return np.bincount(row * GROUPS + codes, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def _key(shape: np.ndarray) -> bytes:
    return shape.astype(np.uint8 if shape.sum() < 256 else np.int64).tobytes()


def block_rows(words: DataFrame) -> DataFrame:
    """(key, part, own, word, n): a word in each of its blocks.

    ``part`` is the group that the lost letter is from, -1 in the block of the word's own
    shape; ``own`` marks the one block in which words of equal shape are compared.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            table = shapes([w.encode("latin-1") for w in b["word"].to_pylist()])
            keys, part, own, row = [], [], [], []
            for i, shape in enumerate(table):
                keys.append(_key(shape))
                groups = np.flatnonzero(shape).tolist()
                for g in groups:
                    shape[g] -= 1
                    keys.append(_key(shape))
                    shape[g] += 1
                part += [-1, *groups]
                own += [False, True, *[False] * (len(groups) - 1)]
                row += [i] * (len(groups) + 1)
            pick = pa.array(row, pa.int32())
            columns = [pa.array(keys, pa.binary()), pa.array(part, pa.int8()), pa.array(own), b["word"].take(pick), b["n"].take(pick)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "part", "own", "word", "n"])

    return words.select("word", "n").mapInArrow(lean(spread), "key binary, part byte, own boolean, word string, n long")


def letter_counts(words: list[bytes], size: np.ndarray) -> np.ndarray:
    """One row of letter counts a word, in as few columns as the block has letters."""
    codes = np.frombuffer(b"".join(words), np.uint8)
    used = np.zeros(256, np.int64)
    used[codes] = 1
    width = int(used.sum())
    column = np.cumsum(used) - 1
    row = np.repeat(np.arange(len(words)), size)
    kind = np.float32 if size.max() < 2048 else np.float64  # products below 2 ** 24 are exact
    return np.bincount(row * width + column[codes], minlength=len(words) * width).reshape(-1, width).astype(kind)


def one_edit(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Whether exactly one letter is replaced in, or inserted into, ``a[i]`` to give ``b[i]``, no longer by more than one."""
    out = np.zeros(len(a), bool)
    length = np.fromiter(map(len, b), np.int64, len(b))
    same = np.fromiter(map(len, a), np.int64, len(a)) == length
    for size in np.unique(length).tolist():
        step = max(1, (1 << 21) // max(size, 1))
        for equal in (True, False):
            pick = np.flatnonzero((length == size) & (same == equal))
            for lo in range(0, len(pick), step):
                own = pick[lo : lo + step]
                right = np.frombuffer(b"".join([b[i] for i in own]), np.uint8).reshape(-1, size)
                left = np.frombuffer(b"".join([a[i] for i in own]), np.uint8).reshape(len(own), -1)
                if equal:
                    out[own] = (left != right).sum(axis=1) == 1
                else:
                    head = np.logical_and.accumulate(left == right[:, :-1], axis=1).sum(axis=1)
                    tail = np.logical_and.accumulate((left == right[:, 1:])[:, ::-1], axis=1).sum(axis=1)
                    out[own] = head + tail >= size - 1
    return out


def near_pairs(words: list[bytes], part: np.ndarray, own: np.ndarray, side: np.ndarray, split: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of the near pairs of one block, each once."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")  # a pair's first word is the shorter one
    words, size = [words[i] for i in order], size[order]
    part, own, side = part[order], own[order], side[order]
    x = letter_counts(words, size)
    square = np.einsum("ij,ij->i", x, x)[:, None]
    ones = np.ones_like(square)
    left, right = np.hstack([x, square, ones]), np.hstack([-2 * x, ones, square]).T
    found = [[], []]
    for lo in range(0, len(words), ROWS):
        distance = left[lo : lo + ROWS] @ right[:, lo:]
        i, j = np.nonzero(distance < 2.5)
        good = i < j
        i, j = i[good] + lo, j[good] + lo
        good = (part[i] != part[j]) | own[i]
        if split:
            good &= side[i] != side[j]
        i, j = i[good], j[good]
        good = one_edit([words[k] for k in i.tolist()], [words[k] for k in j.tolist()])
        found[0].append(order[i[good]])
        found[1].append(order[j[good]])
    return np.concatenate(found[0]), np.concatenate(found[1])


def _block_result(words: list[str], n: np.ndarray, part, own, side, split: bool) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
    """(word, near words, largest count, its word) of the words of a block that have near words."""
    if len(words) < 2:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64), []
    raw = [w.encode("latin-1") for w in words]
    i, j = near_pairs(raw, part, own, side, split)
    a, b = np.concatenate([i, j]), np.concatenate([j, i])
    if not len(a):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64), []
    rank = np.empty(len(words), np.int64)  # the best neighbour: largest n, then smallest word
    rank[sorted(range(len(words)), key=lambda k: (-n[k], raw[k]))] = np.arange(len(words))
    order = np.lexsort([rank[b], a])
    a, b = a[order], b[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    near = np.diff(np.append(first, len(a)))
    return [words[k] for k in a[first]], near, n[b[first]], [words[k] for k in b[first]]


def neighbours(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, form, form_n) of the words with near words; ``form`` is the most frequent of them.

    ``words`` (word, n) is read twice: write it before.
    """
    rows = block_rows(words)
    large = rows.groupBy("key").agg(F.count("*").alias("rows")).filter(F.col("rows") > tile)
    slices = F.coalesce(F.ceil(F.col("rows") / tile), F.lit(1)).cast("int")
    dealt = rows.join(large, "key", "left").withColumn("slices", slices)
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    dealt = dealt.select(
        "key", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "part", "own", "word", "n"
    )
    tiles = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def closed(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
            table = pa.Table.from_batches(parts).combine_chunks()
            words, n = table["word"].to_pylist(), table["n"].to_numpy()
            part, own, side = table["part"].to_numpy(), table["own"].to_numpy(), table["side"].to_numpy()
            lo, hi, key = table["lo"].to_numpy(), table["hi"].to_numpy(), table["key"].to_pylist()
            cut = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1] or lo[i] != lo[i - 1] or hi[i] != hi[i - 1]], len(key)]
            out: tuple[list, list, list, list] = ([], [], [], [])
            for s, e in zip(cut, cut[1:]):
                if e - s > 1:
                    for column, values in zip(out, _block_result(words[s:e], n[s:e], part[s:e], own[s:e], side[s:e], lo[s] != hi[s])):
                        column.extend(values)
            if not out[0]:
                return None
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["word", "near", "best_n", "best"])

        def block(b: pa.RecordBatch, i: int) -> tuple:
            return b["key"][i].as_py(), b["lo"][i].as_py(), b["hi"][i].as_py()

        for b in batches:  # whole blocks only: the last one of a batch may go on
            if not b.num_rows:
                continue
            last, k = block(b, b.num_rows - 1), b.num_rows
            if block(b, 0) == last and (not held or block(held[-1], 0) == last):
                held.append(b)
                continue
            while k and block(b, k - 1) == last:
                k -= 1
            if (done := closed([*held, b.slice(0, k)])) is not None:
                yield done
            held = [b.slice(k)]
        if held and (done := closed(held)) is not None:
            yield done

    found = tiles.mapInArrow(lean(compare), "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", "best.form", (-F.col("best.minus")).alias("form_n")
    )


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Null and empty texts have no words, a null id counts as the empty text, repeated rows
    count as often as they occur, and an empty table has no result.  Ties between forms go
    to the smaller word.  Other columns of ``docs`` are not looked at.  Texts and words of
    any length are read whole.
    """
    words = cut_lineage(vocabulary(docs, text, doc_id))
    near = neighbours(words)
    good = F.col("form_n") >= RATIO * F.col("n")
    found = cut_lineage(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n"),
        )
    )
    # a form has at most a few thousand near words, so no key of these joins is large
    steps = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = cut_lineage(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        steps = joined.select("word", "root")
        if joined.filter("next IS NOT NULL").isEmpty():
            break
    return found.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
