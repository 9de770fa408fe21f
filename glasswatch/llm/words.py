"""Words of whole texts, their 64-bit hashes and n-gram hashes, computed with numpy on Arrow batches.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return, which on UTF-8
equals the pattern ``[^\\x20\\x09-\\x0D]+``. Texts are handled in chunks of a megabyte at most, so memory does not depend on
the size of an Arrow batch; a text longer than that is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
#: For steps that give rows as they go: arrays of eight bytes for each byte of text stay in the processor's cache.
SMALL_CHUNK = 1 << 18
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
EXACT = mix(np.arange(256, dtype=U) + U(0x9E3779B97F4A7C15))
#: letters A-Z count as a-z
FOLDED = EXACT.copy()
FOLDED[65:91] = EXACT[97:123]
BYTE_BASE, WORD_BASE = 0x5851F42D4C957F2D, 0xD1342543DE82EF95
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, (SMALL_CHUNK if n <= SMALL_CHUNK + 1 else CHUNK_BYTES) + 1), base, dtype=U)
        factors[0] = 1
        known = _powers[base] = np.multiply.accumulate(factors)
    return known[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


class Chunk(NamedTuple):
    """Some rows of a batch: their indices from ``lo`` to ``hi``, text bytes, and where each text starts."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Per word: row in the chunk, first byte, byte after the last, hash. ``first``: where each row's words begin."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def chunks(texts: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a column of texts (null: empty) into chunks of whole texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64, count=n + 1, offset=8 * texts.offset)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n)
        yield Chunk(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def words_of(chunk: Chunk, table: np.ndarray = EXACT) -> Words:
    data, offsets = chunk.data, chunk.offsets
    inside = ~IS_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    if len(data):
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = np.unique(offsets[:-1])
        edges = edges[edges < len(data)]
        starts[edges] = inside[edges]
        before = edges[edges > 0] - 1
        ends[before] = inside[before]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(table[data] * powers(BYTE_BASE, len(data)), out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * powers(inverse(BYTE_BASE), len(data) + 1)[start])
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(row, start, end, hashes, first)


def ngrams(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of ``size`` words within one text."""
    n = len(w.hash)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, U)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(w.hash * powers(WORD_BASE, n), out=sums[1:])
    at = np.flatnonzero(w.row[: n - size + 1] == w.row[size - 1 :])
    return at, mix((sums[at + size] - sums[at]) * powers(inverse(WORD_BASE), n)[at])
