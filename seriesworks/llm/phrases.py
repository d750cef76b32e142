"""Phrase collocations by prefix-free parsing.

A text is cut where its own content says so: at every window of ``OVERLAP`` words whose
hash is divisible by ``PERIOD``.  A chunk reaches from one such window to the next one,
which it includes, so neighbouring chunks overlap by the window and no phrase of up to
``OVERLAP`` + 1 words is lost between them.  The same passage is cut in the same places
wherever it stands: the distinct chunks are a dictionary, and their frequencies stand for
the whole parse.  Phrases are counted inside the distinct chunks only, times the chunk's
frequency; an occurrence belongs to the chunk in whose own part (before the overlap) it
begins, so each is counted once.

Phrases of k words are counted only where both of their parts of k - 1 words are frequent.
From three words on, only the runs of frequent pairs are looked at.  The workers see the
frequent parts as a bitmap of hashes of bounded size: a false hit
costs a row more in the shuffle, the counts themselves are of the texts and exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesworks.session import cut_lineage

from .arrow_text import IS_SPACE, LOWER, chunks, flat, kept_powers, lean, mask_spans, mixed, span_hashes

#: Longest phrase, words that chunks share, one window in so many is a cut.
LONGEST, OVERLAP, PERIOD = 5, 4, 32
#: Occurrences of a candidate, and phrases of a language in the result.
LEAST_COUNT, TOP = 100, 2000
#: Bits of the bitmap for each frequent phrase, and its largest size (16 MB); a fuller one lets more phrases pass.
BITS_EACH, MAX_BITS = 16, 1 << 27
#: Bytes of chunks that a worker counts at a time.
HELD = 1 << 21
#: Parts in which the rows of one key are dealt.
SALTS = 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~(_BREAK | IS_SPACE)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def words_of(low: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, linked) of the words; ``linked``: the next word is of the same piece."""
    start, end, row = mask_spans(_WORD[low], at)
    linked = np.zeros(len(start), bool)
    if len(start):
        linked[:-1] = (row[1:] == row[:-1]) & ~_BREAK[low[end[:-1]]]
        wide = np.flatnonzero(linked[:-1] & (start[1:] - end[:-1] > 1))  # a break may come after blanks
        breaks = np.flatnonzero(_BREAK[low]) if len(wide) else wide
        linked[wide] = np.searchsorted(breaks, start[wide + 1]) == np.searchsorted(breaks, end[wide])
    return start, end, row, linked


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, where each is first, number of each value among them), by a hash table."""
    coded = pa.array(values).dictionary_encode()
    inverse = coded.indices.to_numpy()
    first = np.empty(len(coded.dictionary), np.int64)
    first[inverse[::-1]] = np.arange(len(values) - 1, -1, -1)
    return coded.dictionary.to_numpy(), first, inverse


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on; the last positions are of no use."""
    out = words.copy()
    for k in range(1, size):
        out[: len(words) - k] = mixed(out[: len(words) - k] * _STEP + words[k:])
    return out


def parse(raw: np.ndarray, at: np.ndarray, period: int = PERIOD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, own) of the chunks of the rows; ``own`` is the number of words before the overlap."""
    low = LOWER[raw]
    start, end, row, linked = words_of(low, at)
    n = len(start)
    if not n:
        return row, start, end, row
    windows = gram_hashes(span_hashes(low, start, end, kept_powers), OVERLAP)
    whole = np.zeros(n, bool)
    whole[: n - OVERLAP + 1] = row[: n - OVERLAP + 1] == row[OVERLAP - 1 :]
    cut = whole & (windows % np.uint64(period) == 0)
    cut[np.flatnonzero(np.r_[True, row[1:] != row[:-1]])] = True
    first = np.flatnonzero(cut)
    after = np.append(first[1:], n)
    # the window at the chunk's end, as far as it is of the same piece as the chunk's last own word
    piece_end = np.flatnonzero(~linked)
    last = np.minimum(after - 1 + OVERLAP, piece_end[np.searchsorted(piece_end, after - 1)])
    return row[first], start[first], end[last], after - first


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", period: int = PERIOD) -> DataFrame:
    """(lang, chunk, own, n): the distinct chunks of each language with their frequency in the parse."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, raw, at in chunks(b["text"]):
                row, start, end, own = parse(raw, at, period)
                whole = LOWER[raw].tobytes()
                pieces = pa.array([whole[s:e] for s, e in zip(start.tolist(), end.tolist())], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([b["lang"][lo:hi].take(pa.array(row)), pieces, pa.array(own, pa.int64())], names=["lang", "chunk", "own"])

    plain = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return plain.mapInArrow(lean(cut), "lang string, chunk string, own long").groupBy("lang", "chunk", "own").agg(F.count("*").alias("n"))


class Held:
    """The words of some chunks, with their hashes by language."""

    def __init__(self, table: pa.Table):
        self.raw, self.at = flat(table["chunk"])
        langs = table["lang"].combine_chunks().dictionary_encode()
        self.langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
        self.start, self.end, self.row, self.linked = words_of(self.raw, self.at)
        names = [name.as_py().encode() for name in self.langs.dictionary]
        cut = np.cumsum([0, *map(len, names)])
        # a word and a language may have the same letters
        seeds = span_hashes(np.frombuffer(b"".join(names), np.uint8), cut[:-1], cut[1:]) * _STEP
        self.words = mixed(span_hashes(self.raw, self.start, self.end, kept_powers) + seeds[self.langs.indices.to_numpy()[self.row]])
        first = np.searchsorted(self.row, np.arange(len(self.at) - 1))
        self.own_left = table["own"].to_numpy()[self.row] - (np.arange(len(self.start)) - first[self.row])
        self.n = table["n"].to_numpy()

    def frequent(self, size: int, bitmap: np.ndarray) -> np.ndarray:
        """Where ``size`` words begin whose hash is in the bitmap."""
        parts = gram_hashes(self.words, size)
        bit = parts & np.uint64(len(bitmap) * 8 - 1)
        return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def lang(self, place: np.ndarray) -> pa.Array:
        return self.langs.dictionary.take(self.langs.indices.take(pa.array(self.row[place])))

    def phrases(self, place: np.ndarray, size: np.ndarray) -> pa.Array:
        """Words from each place on, joined by one blank; where the text has just that between them, a slice will do."""
        start, end, raw = self.start, self.end, self.raw
        odd = np.zeros(len(start) + 1, np.int64)
        if len(start):
            gap = (start[1:] - end[:-1] != 1) | (raw[np.minimum(end[:-1], len(raw) - 1)] != 32)
            odd[2:] = np.cumsum(gap)
            odd[1] = 0
        text, last = raw.tobytes(), place + size - 1
        out = [text[s:e] for s, e in zip(start[place].tolist(), end[last].tolist())]
        for i in np.flatnonzero(odd[last + 1] != odd[place + 1]).tolist():
            own = slice(place[i], last[i] + 1)
            out[i] = b" ".join(text[s:e] for s, e in zip(start[own].tolist(), end[own].tolist()))
        return pa.array(out, pa.binary()).cast(pa.string())


def _grams(table: pa.Table, size: int, bitmap: np.ndarray | None) -> pa.RecordBatch:
    """(lang, phrase, h, n) of the phrases of ``size`` words in some chunks, each once."""
    held = Held(table)
    words = len(held.start)
    good = held.own_left > 0
    for k in range(1, size):
        good[: words - k] &= held.linked[k - 1 : words - 1]
        good[max(0, words - k) :] = False
    if bitmap is not None:
        frequent = held.frequent(size - 1, bitmap)
        good[:-1] &= frequent[:-1] & frequent[1:]
    place = np.flatnonzero(good)
    h, one, inverse = distinct(gram_hashes(held.words, size)[place])
    n = np.bincount(inverse, weights=held.n[held.row[place]], minlength=len(h)).astype(np.int64)
    place = place[one]
    columns = [held.lang(place), held.phrases(place, size), pa.array(h.view(np.int64)), pa.array(n)]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "h", "n"])


def _runs(table: pa.Table, pairs: np.ndarray) -> pa.RecordBatch:
    """(lang, chunk, own, n) of the longest runs of three words and more in which each two neighbours are frequent."""
    held = Held(table)
    pair = held.linked & held.frequent(2, pairs)
    begins = np.flatnonzero(pair & ~np.r_[False, pair[:-1]])
    size = np.flatnonzero(pair & ~np.r_[pair[1:], False]) - begins + 2
    own = np.minimum(held.own_left[begins], size)
    kept = (size > 2) & (own > 0)
    begins, size, own = begins[kept], size[kept], own[kept]
    columns = [held.lang(begins), held.phrases(begins, size), pa.array(own, pa.int64()), pa.array(held.n[held.row[begins]], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "chunk", "own", "n"])


def _by_lots(function, shared):
    """A worker function that calls ``function`` on about ``HELD`` bytes of chunks at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, size, known = [], 0, None if shared is None else shared.value
        for b in batches:
            lot.append(b)
            size += b.nbytes
            if size >= HELD:
                yield function(pa.Table.from_batches(lot), known)
                lot, size = [], 0
        if sum(b.num_rows for b in lot):
            yield function(pa.Table.from_batches(lot), known)

    return lean(run)


def count_phrases(chunk_table: DataFrame, size: int, bitmap: np.ndarray | None, least: int = LEAST_COUNT) -> DataFrame:
    """(lang, phrase, h, n, size) of the phrases of ``size`` words that occur ``least`` times or more."""
    shared = None if bitmap is None else chunk_table.sparkSession.sparkContext.broadcast(bitmap)  # MAX_BITS at most
    count = _by_lots(lambda table, known: _grams(table, size, known), shared)
    found = chunk_table.mapInArrow(count, "lang string, phrase string, h long, n long")
    total = found.groupBy("lang", "phrase", "h").agg(F.sum("n").alias("n"))
    return total.filter(F.col("n") >= least).withColumn("size", F.lit(size))


def bitmap_of(frequent: DataFrame, rows: int) -> np.ndarray:
    """Bitmap of the hashes of the frequent phrases, made by Spark as words of 64 bits."""
    bits = 1 << 16
    while bits < rows * BITS_EACH and bits < MAX_BITS:
        bits *= 2
    bit = F.col("h").bitwiseAND(F.lit(bits - 1))
    one = F.expr(f"shiftleft(1L, cast((h & {bits - 1}L) & 63 as int))")
    table = frequent.select(F.shiftright(bit, 6).alias("word"), one.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[table["word"].to_numpy()] = table["bits"].to_numpy()
    return out.view(np.uint8)


def frequent_runs(chunk_table: DataFrame, pairs: np.ndarray) -> DataFrame:
    """The dictionary without all that no frequent phrase of three words can be in, as a dictionary of runs."""
    shared = chunk_table.sparkSession.sparkContext.broadcast(pairs)  # MAX_BITS at most
    found = chunk_table.mapInArrow(_by_lots(_runs, shared), "lang string, chunk string, own long, n long")
    return found.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n"))


def frequent_phrases(chunk_table: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """All phrases of up to ``LONGEST`` words that occur ``least`` times or more, level by level."""
    levels, bitmap = [], None
    for size in range(1, LONGEST + 1):
        level = cut_lineage(count_phrases(chunk_table, size, bitmap, least))
        rows = level.count()
        levels.append(level)
        if not rows:
            break
        if size < LONGEST:
            bitmap = bitmap_of(level, rows)
        if size == 2:
            chunk_table = cut_lineage(frequent_runs(chunk_table, bitmap))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def cohesion(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, size) of the phrases of two words and more, by their lowest-scoring cut.

    A part of one word belongs to many phrases, so those keys are dealt over ``SALTS`` values.
    """
    counts = phrases.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"), "size")
    salts = F.when(F.col("size") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    counts = counts.withColumn("salt", F.explode(salts)).drop("size")
    words = F.split("phrase", " ")
    cuts = (
        phrases.filter("size > 1")
        .select("lang", "phrase", F.col("n").alias("a"), "size", words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
        .withColumn("first", F.concat_ws(" ", F.slice("words", F.lit(1), F.col("cut"))))
        .withColumn("rest", F.concat_ws(" ", F.slice("words", F.col("cut") + 1, F.col("size") - F.col("cut"))))
        .drop("words")
    )
    dealt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    for part, length, name in (("first", F.col("cut"), "l"), ("rest", F.col("size") - F.col("cut"), "r")):
        cuts = cuts.withColumn("salt", F.when(length == 1, dealt).otherwise(0))
        cuts = cuts.join(counts.withColumnsRenamed({"part": part, "f": name}), ["lang", part, "salt"])
    cuts = cuts.join(F.broadcast(totals), "lang")  # one row a language
    wide = {c: F.col(c).cast("decimal(19,0)").alias(c) for c in ("a", "n", "l", "r")}
    exact = cuts.select("lang", "phrase", "size", "cut", *wide.values())
    scored = exact.withColumn("score", F.expr("(a * n * 1000BD) div (l * r)"))
    best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    return scored.groupBy("lang", "phrase", "size", "a", "n").agg(best).select(
        "lang", "phrase", "size", *[F.col(c).cast("long").alias(c) for c in ("a", "n")],
        *[F.col(f"best.{c}").cast("long").alias(c) for c in ("l", "r", "score")],
    )


def without_parts(scored: DataFrame) -> DataFrame:
    """The phrases that do not occur inside a longer one just as often.

    If a phrase is as frequent as one longer by several words, it is as frequent as one
    longer by one word, so only those are looked up.
    """
    words = F.split("phrase", " ")
    inner = F.array(F.slice(words, F.lit(1), F.col("size") - 1), F.slice(words, F.lit(2), F.col("size") - 1))
    parts = scored.filter("size > 2").select("lang", F.explode(inner).alias("words"), "a")
    parts = parts.select("lang", F.concat_ws(" ", "words").alias("phrase"), "a").distinct()
    return scored.join(parts, ["lang", "phrase", "a"], "left_anti")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, top: int = TOP, period: int = PERIOD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Null and empty texts have no words; a null language is ``und``; repeated rows count as
    often as they occur; a table without frequent phrases, as an empty one, gives no rows.
    Ties in the score go to the more frequent, then to the smaller phrase.  Other columns
    of ``docs`` are not looked at.  Texts of any length are read whole.
    """
    chunk_table = cut_lineage(dictionary(docs, text, lang, period))
    totals = chunk_table.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n"))
    scored = cut_lineage(cohesion(frequent_phrases(chunk_table, least), totals))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rows = without_parts(scored).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    # the best of each part first: then at most SALTS x top rows of a language meet
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
