"""Integer arrays as small byte strings, to shuffle a few large rows instead of many small ones."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray, level: int = 1) -> bytes:
    """Byte planes, compressed: equal high bytes take almost no room."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=level).compress(planes.tobytes()) if len(values) else b""


def unpack(data: bytes, dtype) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype)
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Like :func:`pack`, for unsigned values in ascending order: their differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack(data, dtype), dtype=dtype)
