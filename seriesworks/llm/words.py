"""Column expressions on words and characters, shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of the contracts: blank and the code points 9 to 13.
SPACE = " \t\n\x0b\f\r"
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


def lower_ascii(text: Column) -> Column:
    """Lower-case the letters A to Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_chars_of(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def bucket(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds
