"""Numpy views of Arrow text columns, for operators that look at every byte."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of text worked on at a time; a longer text is one piece by itself.
CHUNK = 1 << 19
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Base of the rolling hash (odd) and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Rows of whole documents that Spark sends to a worker at a time.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Send documents by the thousand: a batch of whole texts is held several times on its way."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def lean(function: Callable) -> Callable:
    """A worker function that gives freed memory back to the system when its task is done."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library can
            ctypes.CDLL(None).malloc_trim(0)

    return run


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows, about ``size`` bytes together."""
    raw, at = flat(column)
    first, rows = 0, len(at) - 1
    while first < rows:
        end = max(first + 1, int(np.searchsorted(at, at[first] + size, side="right")) - 1)
        yield first, end, raw[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words end at white space and at the row's end."""
    solid = np.zeros(len(raw) + 2, bool)
    solid[1:-1] = ~IS_SPACE[raw]
    begins = solid[1:-1] & ~solid[:-2]
    ends = solid[1:-1] & ~solid[2:]
    inner = at[1:-1]
    cut = inner[(inner > 0) & (inner < len(raw))]
    begins[cut] = solid[cut + 1]
    ends[cut - 1] = solid[cut]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(at, start, side="right") - 1


def mask_spans(mask: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the maximal runs of marked bytes; runs end at the row's end."""
    held = np.zeros(len(mask) + 2, bool)
    held[1:-1] = mask
    begins, ends = held[1:-1] & ~held[:-2], held[1:-1] & ~held[2:]
    inner = at[1:-1]
    cut = inner[(inner > 0) & (inner < len(mask))]
    begins[cut] = mask[cut]
    ends[cut - 1] = mask[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(at, start, side="right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit values, so that any bits of them can be used."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = BASE) -> np.ndarray:
    """``base ** i`` modulo 2 ** 64 for i below ``n``."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Powers that a worker keeps, 16 MB a base; longer texts have theirs made anew.
KEPT = 1 << 21
_KEPT: dict[int, np.ndarray] = {}


def kept_powers(n: int, base: int = BASE) -> np.ndarray:
    """Like :func:`powers`, for operators that need them all the time; not to be written to."""
    if n > KEPT:
        return powers(n, base)
    if base not in _KEPT:
        _KEPT[base] = powers(KEPT, base)
    return _KEPT[base][: max(n, 1)]


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Callable = powers) -> np.ndarray:
    """64-bit hashes of the byte spans; equal spans have equal hashes."""
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(len(raw)), out=total[1:])
    back = powers(len(raw) + 1, INVERSE)
    return mixed((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))


def row_counts(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bytes of each row are marked."""
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[at[1:]] - total[at[:-1]]
