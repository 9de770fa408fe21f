"""Fill-in-the-middle: texts cut at two code points and rearranged, with a sparse index between code points and bytes.

For a chunk of texts only the multibyte characters are recorded: the code point each stands at, and how many bytes beyond one a character
all of them up to it take. ``searchsorted`` in that list converts code points to bytes and back; between two of its entries, and
in ASCII texts altogether, a place is plain arithmetic.

Three numbers from a hash of the document's id decide where a text is cut and which form it gets:

* ``plain``: the text itself; for empty texts, texts that hold a marker, and a share ``plain_percent`` of the others
* ``psm``: prefix, suffix, middle, each after its marker
* ``spm``: suffix, prefix, middle, each after its marker; ``spm_percent`` of the rearranged ones

``restored`` rebuilds the text from output and form alone, in Spark expressions. It is exact: a rearranged text holds no marker, and
``check_markers`` makes sure that none can arise where parts meet.

Null texts count as empty. Texts of any length are taken whole, a text above a megabyte as a chunk of its own. A null id hashes as no digits. Rows
are independent: repeated rows give repeated results, an empty table an empty one. Extra columns are kept unless they have the name of a result.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasswatch.llm.tables import ship
from glasswatch.llm.words import Chunk, chunks


class Markers(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


class Exceptions(NamedTuple):
    """Per multibyte character: its code point number ``place``, its first byte ``start``, and the excess bytes up to its end."""

    place: np.ndarray
    start: np.ndarray
    excess: np.ndarray

    def to_bytes(self, places: np.ndarray) -> np.ndarray:
        return places + self.excess[np.searchsorted(self.place, places)]

    def to_places(self, starts: np.ndarray) -> np.ndarray:
        return starts - self.excess[np.searchsorted(self.start, starts)]


def exceptions(data: np.ndarray) -> Exceptions:
    """The index of UTF-8 bytes. ``excess`` has a leading zero: entry i is what stands before exception i."""
    start = np.flatnonzero(data >= 0xC0)
    first = data[start]
    excess = np.zeros(len(start) + 1, np.int64)
    np.cumsum(1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0), out=excess[1:])
    return Exceptions(start - excess[:-1], start, excess)


def check_markers(markers: Markers) -> None:
    """Raise if a marker is empty, holds another one, or may overlap one: then a seam could hold a marker."""
    for i, a in enumerate(markers):
        others = markers[:i] + markers[i + 1 :]
        if not a or any(a in b for b in others) or any(b.startswith(a[j:]) for b in markers for j in range(1, len(a))):
            raise ValueError(f"markers {tuple(markers)} can't be told apart")


def numbers(doc_id: str | None) -> tuple[int, int, int, int]:
    """The first four groups of eight hexadecimal digits of the SHA-256 of ``1:`` and the id's digits."""
    digest = hashlib.sha256(f"1:{doc_id or ''}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def _marked(chunk: Chunk, pattern: re.Pattern) -> np.ndarray:
    """Which rows hold a marker."""
    spans = np.array([(m.start(), m.start() + len(m[1])) for m in pattern.finditer(chunk.data.tobytes())], np.int64).reshape(-1, 2)
    row = np.searchsorted(chunk.offsets, spans[:, 0], "right") - 1
    out = np.zeros(len(chunk.offsets) - 1, bool)
    out[row[spans[:, 1] <= chunk.offsets[row + 1]]] = True
    return out


def _strings(parts: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.StringArray.from_buffers(len(parts), pa.py_buffer(offsets), pa.py_buffer(b"".join(parts)))


def fill_in_middle(docs: DataFrame, markers: Markers = Markers(), plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """``docs`` without its text, and ``n`` code points, ``form``, ``prefix_chars``, ``middle_chars``, ``prefix_bytes``, ``middle_bytes`` (null
    where plain) and the ``output``."""
    ship(docs.sparkSession)
    check_markers(markers)
    names = ["n", "form", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes", "output"]
    own = [c for c in docs.columns if c != "text" and c.lower() not in names]
    p, s, m = (x.encode() for x in markers)
    pattern = re.compile(b"(?=(" + b"|".join(map(re.escape, (p, s, m))) + b"))")

    def rearranged(chunk: Chunk, ids: list[str | None]) -> list[pa.Array]:
        data, rows = memoryview(chunk.data.tobytes()), len(ids)
        index = exceptions(chunk.data)
        first = index.to_places(chunk.offsets)
        n = np.diff(first)
        h = np.array([numbers(i) for i in ids], np.int64).reshape(rows, 4)
        cuts = np.sort(h[:, :2] % (n[:, None] + 1), axis=1)
        at = index.to_bytes(first[:-1, None] + cuts)
        plain = (n == 0) | _marked(chunk, pattern) | (h[:, 2] % 100 >= 100 - plain_percent)
        spm = ~plain & (h[:, 3] % 100 < spm_percent)
        out = []
        for i, (lo, a, b, hi) in enumerate(zip(chunk.offsets[:-1].tolist(), *at.T.tolist(), chunk.offsets[1:].tolist(), strict=True)):
            if plain[i]:
                out.append(bytes(data[lo:hi]))
            elif spm[i]:
                out.append(b"".join((s, data[b:hi], p, data[lo:a], m, data[a:b])))
            else:
                out.append(b"".join((p, data[lo:a], s, data[b:hi], m, data[a:b])))
        lengths = (cuts[:, 0], cuts[:, 1] - cuts[:, 0], at[:, 0] - chunk.offsets[:-1], at[:, 1] - at[:, 0])
        form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
        return [pa.array(n), pa.array(form, pa.string()), *(pa.array(x, pa.int64(), mask=plain) for x in lengths), _strings(out)]

    def run(batches):
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1)
            for chunk in chunks(texts):
                kept = [c.slice(chunk.lo, chunk.hi - chunk.lo) for c in b.columns[2:]]
                yield pa.RecordBatch.from_arrays(kept + rearranged(chunk, keys[chunk.lo : chunk.hi]), own + names)

    # numbered inside, so that no own column clashes with them
    inner = [F.col("doc_id").cast("string"), F.col("text"), *[F.col(f"`{c}`") for c in own]]
    picked = docs.select(*[c.alias(f"_{i}") for i, c in enumerate(inner)])
    schema = docs.select(*[F.col(f"`{c}`") for c in own]).schema
    for name in names:
        schema = schema.add(name, "string" if name in ("form", "output") else "long")
    return picked.mapInArrow(run, schema)


def restored(output: Column | str, form: Column | str, markers: Markers = Markers()) -> Column:
    """The text that an output of a form was made from."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    after = lambda marker: F.substring_index(output, marker, -1)
    until = lambda rest, marker: F.substring_index(rest, marker, 1)
    p, s, m = markers
    psm = F.concat(until(after(p), s), after(m), until(after(s), m))
    spm = F.concat(until(after(p), m), after(m), until(after(s), p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
