"""Language identification: one byte model per language, compared by exact code length.

Each language has a variable-order context trie with frozen counts (module ``ppm``);
all share one lookup.  The language with the shortest code wins.  Models learn from a
bounded sample of labelled rows; every text is scored whole, in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ppm
from .arrow_text import chunks, lean

DEPTH, LEAST = 4, 2.0**-18
#: Rows that a language's model learns from, about: those with the smallest hashes of their id.
ROWS_PER_LANGUAGE = 1000
UNKNOWN = "und"


def sample(docs: DataFrame, usable: Column, lang: str = "lang", text: str = "text", rows: int = ROWS_PER_LANGUAGE) -> tuple[list[str], DataFrame]:
    """Languages in order, and (model, text) of their training rows.

    A language with more than ``rows`` rows gives those whose hash of the id falls in
    the lowest ``rows / its rows`` share of the hash range.  The languages are a
    handful and counted on the driver.
    """
    labelled = docs.filter(usable).filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[lang]: r["count"] for r in labelled.groupBy(lang).count().collect()}
    names = sorted(sizes)
    spark = docs.sparkSession
    shares = spark.createDataFrame(
        [(name, i, min(1.0, rows / sizes[name])) for i, name in enumerate(names)], "__sw_lang string, __sw_model int, __sw_share double"
    )
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.join(F.broadcast(shares), F.col(lang) == F.col("__sw_lang")).filter(place < F.col("__sw_share"))
    return names, chosen.select("__sw_model", F.col(text).alias("__sw_text"))


def identify(
    docs: DataFrame, usable: Column, lang: str = "lang", text: str = "text", depth: int = DEPTH, least: float = LEAST,
    rows: int = ROWS_PER_LANGUAGE,
) -> DataFrame:
    """``docs`` without text and labels, with ``lang_pred`` and ``score``.

    ``usable`` says which rows may be learned from.  ``score`` is the winner's share of
    the texts' probabilities under all models (0 to 1).  Null texts and texts without a
    letter, and all texts if nothing was learned, are ``und`` with score 0.  At equal
    code lengths the first language by code point wins.  Result columns replace
    columns of the same names.
    """
    names, chosen = sample(docs, usable, lang, text, rows)
    trie = ppm.Trie(ppm.learn(chosen, depth, least, "__sw_model", "__sw_text"), len(names), depth) if names else None
    model = docs.sparkSession.sparkContext.broadcast((trie and trie.arrays(), names))
    kept = [c for c in docs.columns if c not in (text, lang, "lang_pred", "score")]
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, names = model.value
        trie = arrays and ppm.Trie.from_arrays(arrays)
        for b in batches:
            best, share = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            if trie:
                for lo, hi, raw, at in chunks(b["__sw_text"]):
                    logs = trie.log_probability(raw, at)
                    best[lo:hi] = logs.argmax(axis=1)
                    share[lo:hi] = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            good = b["__sw_letters"].to_numpy(zero_copy_only=False).astype(bool) & bool(trie)
            found = pa.array([names[i] if ok else UNKNOWN for i, ok in zip(best, good, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*(b[c] for c in kept), found, pa.array(np.where(good, share, 0.0))], names=[*kept, "lang_pred", "score"])

    plain = docs.select(*kept, F.col(text).alias("__sw_text"), letters.alias("__sw_letters"))
    return plain.mapInArrow(lean(named), docs.select(*kept).schema.add("lang_pred", "string").add("score", "double"))
