"""Sorted 64-bit values in few bytes, so that a count over all n-grams moves two or three bytes for each of them."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U = np.uint64


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned values: the first one, a byte width, and the gaps in that width, little-endian."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return int(values[0]).to_bytes(8, "little") + bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, U)
    width = blob[8]
    planes = np.frombuffer(blob, np.uint8, offset=9).reshape(width, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :width] = planes.T
    out = np.empty(planes.shape[1] + 1, U)
    out[0] = int.from_bytes(blob[:8], "little")
    out[1:] = gaps.view("<u8").ravel()
    return np.cumsum(out, dtype=U)


def pack_small(values: np.ndarray, width: int) -> bytes:
    """Unsigned values below 256**width in their order."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_small(blob: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(blob) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def ranges_for(docs: DataFrame, bytes_each: int = 16 << 20) -> tuple[int, int]:
    """How many hash ranges to deal n-grams over, a power of two, and the text bytes they hold together.

    Each range gets the n-grams of about ``bytes_each`` of text, at every size of the input.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 << max(6, math.ceil(math.log2(max(1, total / bytes_each)))), total


def hash_bits(total: int) -> int:
    """Bits of a hash for which about one in a hundred of the n-grams of ``total`` text bytes meets another by chance."""
    return min(64, max(24, math.ceil(math.log2(max(2, total / 5))) + 7))
