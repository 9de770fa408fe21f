"""How far the sources of a language differ in their terms, by chunk factorization.

1. A chunk is a run of characters other than ASCII white space. Chunks are counted per document, and the counts of some megabytes of
   text condensed into one row per language, source and chunk.
2. Rows of one chunk meet in a hash range, and the chunk is cut into terms there, once for all its documents. Its terms take the place of
   the chunk, and are condensed in the same way.
3. Rows of one term meet in a hash range and give the occurrences per source, and whether enough documents of a language hold the term.

Rows of a piece that go to one range travel packed in one row, in about six bytes each. Ranges hold about 16 MB of text each, so there are more of
them for more text. Keys are told apart by 64-bit hashes.

Which documents hold a term decides only whether there are ``min_docs`` of them. So rows name their document while a language's
chunk or term is in fewer documents, and drop the names once it is in that many: a frequent term costs a row per source and
piece, a rare one fewer than ``min_docs`` rows. The decision is exact, for a set of named documents is complete as long as no row has dropped its
name. Copies of a row are documents of their own.

Measures are whole numbers: a term's probability in a group, in billionths, is smoothed by two occurrences a term, and two
probabilities differ by their squared difference over their sum. Pairs of sources are compared in blocks of terms, each with the
sources' whole columns for these terms, zeros included, and the blocks' sums added up.

Null texts, languages and sources count as ''. Texts are read whole, whatever their length. Groups without terms, or whose terms are too rare, are
compared all the same. Ties in a ranking go to the smaller item in UTF-8 order. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.llm.packing import pack_small, ranges_for, unpack_small
from glasswatch.llm.tables import ship, stored
from glasswatch.llm.words import IS_SPACE, Chunk, chunks, mix, words_of

U = np.uint64
MIN_DOCS, TOP = 10, 10
SCALE, PRIOR = 1_000_000_000, 2
#: Bytes of text, and rows, that are condensed at once; cells (sources x terms) of a block.
PIECE_BYTES, PIECE_ROWS, BLOCK_CELLS = 16 << 20, 1 << 20, 1 << 19
#: What separates terms: all of ASCII but letters. Upper-case letters are lowered.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_PACKED = "place int, size int, body binary"


class Counts(NamedTuple):
    """Rows of a piece: codes of language and source, a hash of the key, the document (-1: not named), and occurrences."""

    lang: np.ndarray
    source: np.ndarray
    key: np.ndarray
    doc: np.ndarray
    n: np.ndarray


def condense(c: Counts, min_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row that stays: an input row with its language, source and key; its occurrences; its document.

    Equal documents of a key are one row. Keys in ``min_docs`` documents of a language, or with an unnamed one, become a row per source.
    """
    if not len(c.key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = mix(c.key + c.lang.astype(U) * U(0x9E3779B97F4A7C15))
    order = np.lexsort((c.source, c.doc, both))
    both, doc, source = both[order], c.doc[order], c.source[order]
    new_key = np.append(True, both[1:] != both[:-1])
    new = new_key | np.append(True, doc[1:] != doc[:-1]) | np.append(True, source[1:] != source[:-1])
    at = np.flatnonzero(new)
    n, key, doc = np.add.reduceat(c.n[order], at), np.cumsum(new_key)[at] - 1, doc[at]
    order, source = order[at], source[at]
    # documents of a key: a document has one source, so its rows are one
    named = np.bincount(key, doc >= 0)
    frequent = (named >= min_docs) | (np.bincount(key, doc < 0) > 0)
    rare = ~frequent[key]
    rest = np.flatnonzero(~rare)
    rest = rest[np.lexsort((source[rest], key[rest]))]
    if not len(rest):
        return order[rare], n[rare], doc[rare]
    first = np.flatnonzero(np.append(True, (key[rest][1:] != key[rest][:-1]) | (source[rest][1:] != source[rest][:-1])))
    sums = np.add.reduceat(n[rest], first)
    return (
        np.concatenate([order[rare], order[rest[first]]]),
        np.concatenate([n[rare], sums]),
        np.concatenate([doc[rare], np.full(len(first), -1)]),
    )


def chunk_counts(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Per distinct chunk of each text: row, hash and count; the distinct chunks, and which of them it is."""
    w = words_of(chunk)
    if not len(w.hash):
        return w.row, w.hash, np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)
    order = np.argsort(w.hash, kind="stable")
    h, row = w.hash[order], w.row[order]
    new = np.append(True, h[1:] != h[:-1])
    at = np.flatnonzero(new | np.append(True, row[1:] != row[:-1]))
    names = _slices(chunk.data, w.start, w.end).take(pa.array(2 * order[new]))
    return row[at], h[at], np.diff(np.append(at, len(order))), names, (np.cumsum(new) - 1)[at]


def _slices(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Strings at ascending places; entry ``2 i`` is the i-th, entries between are what separates them."""
    offsets = np.empty(2 * len(start), np.int32)
    offsets[0::2], offsets[1::2] = start, end
    return pa.StringArray.from_buffers(max(0, len(offsets) - 1), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _bytes_of(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, and where each begins, with the end."""
    names = pa.concat_arrays([names])  # a new one starts at its buffers' first place
    _, offsets, data = names.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(names) + 1, 4 * names.offset).astype(np.int64) if len(names) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Piece:
    """Rows that are gathered, condensed, and sent on."""

    def __init__(self, min_docs: int):
        self.min_docs, self.rows, self.settled = min_docs, 0, PIECE_ROWS
        self.langs: dict[str, int] = {}
        self.sources: dict[str, int] = {}
        self.parts: list[tuple[Counts, pa.Array, np.ndarray]] = []

    def codes(self, known: dict[str, int], names: list[str], codes: np.ndarray) -> np.ndarray:
        return np.array([known.setdefault(v, len(known)) for v in names], np.int32)[codes] if len(codes) else codes.astype(np.int32)

    def add(self, counts: Counts, names: pa.Array, name: np.ndarray) -> None:
        """Rows whose languages and sources are codes of this piece; ``name`` is each key's place in ``names``."""
        self.parts.append((counts, names, name))
        self.rows += len(name)
        if self.rows > self.settled:  # rows of frequent keys become few; the others are as many as the range is wide
            self.parts = [self.condensed()]
            self.rows = len(self.parts[0][2])
            self.settled = 2 * self.rows + PIECE_ROWS

    def condensed(self) -> tuple[Counts, pa.Array, np.ndarray]:
        if not self.parts:
            none = np.zeros(0, np.int64)
            return Counts(none, none, none.astype(U), none, none), pa.array([], pa.string()), none
        counts = Counts(*(np.concatenate(x) for x in zip(*(p[0] for p in self.parts), strict=True)))
        before = np.cumsum([0] + [len(p[1]) for p in self.parts])
        name = np.concatenate([p[2] + b for p, b in zip(self.parts, before, strict=False)])
        names = pa.concat_arrays([p[1] for p in self.parts])
        self.parts = []
        row, n, doc = condense(counts, self.min_docs)
        order = np.argsort(counts.key[row], kind="stable")
        row, n, doc = row[order], n[order], doc[order]
        key = counts.key[row]
        new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        return Counts(counts.lang[row], counts.source[row], key, doc, n), names.take(pa.array(name[row[new]])), np.cumsum(new) - 1

    def packed(self, bits: int) -> Iterator[pa.RecordBatch]:
        """The condensed rows, those of one hash range in one row; empties the piece."""
        counts, names, name = self.condensed()
        langs, sources = list(self.langs), list(self.sources)
        self.rows = 0
        place = (counts.key >> U(64 - bits)).astype(np.int64)
        ends = np.append(np.flatnonzero(np.diff(place)) + 1, len(place)) if len(place) else []
        lo, out, size = 0, [], 0
        for hi in ends:
            body = _encode(Counts(*(x[lo:hi] for x in counts)), names, name[lo:hi], langs, sources)
            out.append((int(place[lo]), *body))
            lo, size = hi, size + len(body[1])
            if size > (4 << 20):
                yield _sent(out)
                out, size = [], 0
        if out:
            yield _sent(out)

    def unpack(self, size: int, body: bytes) -> None:
        self.add(*_decode(self, size, body))


def _sent(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["place", "size", "body"])


def _encode(c: Counts, names: pa.Array, name: np.ndarray, langs: list[str], sources: list[str]) -> tuple[int, bytes]:
    """Rows in the order of their keys: small numbers in as many bytes as the largest needs, each key once, all compressed."""
    data, offsets = _bytes_of(names.slice(name[0], name[-1] - name[0] + 1))
    used_langs, lang = np.unique(c.lang, return_inverse=True)
    used_sources, source = np.unique(c.source, return_inverse=True)
    base = int(c.doc[c.doc >= 0].min()) if (c.doc >= 0).any() else 0
    numbers = (np.diff(offsets), np.bincount(name - name[0]), lang, source, c.n, np.where(c.doc < 0, 0, c.doc - base + 1))
    widths = [max(1, (int(x.max()).bit_length() + 7) // 8) for x in numbers]
    head = json.dumps([[langs[i] for i in used_langs], [sources[i] for i in used_sources], base, [len(x) for x in numbers], widths]).encode()
    body = b"".join([len(head).to_bytes(4, "little"), head, *(pack_small(x, w) for x, w in zip(numbers, widths, strict=True)), data.tobytes()])
    return len(body), _codec().compress(body, asbytes=True)


def _decode(piece: Piece, size: int, body: bytes) -> tuple[Counts, pa.Array, np.ndarray]:
    body = _codec().decompress(body, size, asbytes=True)
    at = 4 + int.from_bytes(body[:4], "little")
    langs, sources, base, lengths, widths = json.loads(body[4:at])
    numbers = []
    for n, width in zip(lengths, widths, strict=True):
        numbers.append(unpack_small(body[at : at + n * width], width).astype(np.int64))
        at += n * width
    length, each, lang, source, n, doc = numbers
    offsets = np.append(0, np.cumsum(length))
    data = np.frombuffer(body, np.uint8, offset=at)
    key = words_of(Chunk(0, len(length), data, offsets)).hash
    name = np.repeat(np.arange(len(length)), each)
    names = pa.StringArray.from_buffers(len(length), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    codes = piece.codes(piece.langs, langs, lang), piece.codes(piece.sources, sources, source)
    return Counts(*codes, key[name], np.where(doc > 0, doc + base - 1, -1), n), names, name


def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def chunk_rows(docs: DataFrame, bits: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """Counts of whole chunks, packed by hash range: a row per document of a rare chunk, a row per piece and source of a frequent one."""

    def run(batches):
        piece, size = Piece(min_docs), 0
        for b in batches:
            doc = b.column(0).to_numpy()
            lang, source = (_coded(piece, known, b.column(i)) for i, known in ((1, piece.langs), (2, piece.sources)))
            for c in chunks(b.column(3)):
                row, key, n, names, name = chunk_counts(c)
                row = row + c.lo
                piece.add(Counts(lang[row], source[row], key, doc[row], n), names, name)
                size += len(c.data)
                if size >= PIECE_BYTES:
                    yield from piece.packed(bits)
                    size = 0
        yield from piece.packed(bits)

    own = F.monotonically_increasing_id()
    rows = docs.select(own.alias("doc"), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")), "text")
    return rows.mapInArrow(run, _PACKED)


def _coded(piece: Piece, known: dict[str, int], column: pa.Array) -> np.ndarray:
    coded = column.dictionary_encode()
    return piece.codes(known, coded.dictionary.to_pylist(), coded.indices.to_numpy())


def terms_of(names: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Terms of chunks, in order: the chunk's number, a hash, and the term itself."""
    data, offsets = _bytes_of(names)
    data = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
    w = words_of(Chunk(0, len(names), data, offsets))
    offsets = np.append(0, np.cumsum(w.end - w.start)).astype(np.int32)
    letters = np.ascontiguousarray(data[~IS_SPACE[data]])
    return w.row, w.hash, pa.StringArray.from_buffers(len(w.hash), pa.py_buffer(offsets), pa.py_buffer(letters))


def _by_range(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[Piece]:
    """A piece with all rows of a hash range, one range after another."""
    last, piece = None, None
    for b in batches:
        for place, size, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if place != last:
                if piece is not None:
                    yield piece
                last, piece = place, Piece(min_docs)
            piece.unpack(size, body)
    if piece is not None:
        yield piece


def term_rows(counted: DataFrame, bits: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """Counts of chunks as counts of terms, packed by hash range: all rows of a chunk meet, and it is cut into terms once."""

    def run(batches):
        out = Piece(min_docs)
        for piece in _by_range(batches, min_docs):
            counts, names, name = piece.condensed()
            of, key, terms = terms_of(names)
            # a row of chunk number c stands for its terms, those from first[c] on
            first = np.searchsorted(of, np.arange(len(names) + 1))
            many = np.diff(first)[name]
            row = np.repeat(np.arange(len(name)), many)
            term = np.arange(len(row)) - np.repeat(np.cumsum(many) - many - first[name], many)
            codes = out.codes(out.langs, list(piece.langs), counts.lang), out.codes(out.sources, list(piece.sources), counts.source)
            out.add(Counts(codes[0][row], codes[1][row], key[term], counts.doc[row], counts.n[row]), terms, term)
            if out.rows > PIECE_ROWS:
                yield from out.packed(bits)
        yield from out.packed(bits)

    return counted.repartition("place").sortWithinPartitions("place").mapInArrow(run, _PACKED)


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n`` of the terms in ``min_docs`` documents of their language, with ``total`` occurrences in the language and
    ``lead``, true in one row of each term and language."""
    ship(docs.sparkSession)
    bits = ranges_for(docs.select("text"))[0].bit_length() - 1

    def run(batches):
        for piece in _by_range(batches, min_docs):
            counts, names, name = piece.condensed()
            kept = np.flatnonzero(counts.doc < 0)  # the documents of the others are all named, and too few
            kept = kept[np.lexsort((counts.source[kept], counts.lang[kept], counts.key[kept]))]
            if not len(kept):
                continue
            lang, key = counts.lang[kept], counts.key[kept]
            lead = np.append(True, (lang[1:] != lang[:-1]) | (key[1:] != key[:-1]))
            total = np.add.reduceat(counts.n[kept], np.flatnonzero(lead))[np.cumsum(lead) - 1]
            text = lambda known, code: pa.array(list(known), pa.string()).take(pa.array(code))
            columns = [text(piece.langs, lang), text(piece.sources, counts.source[kept]), names.take(pa.array(name[kept]))]
            columns += [pa.array(counts.n[kept]), pa.array(total), pa.array(lead)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "total", "lead"])

    rows = term_rows(chunk_rows(docs, bits, min_docs), bits, min_docs).repartition("place").sortWithinPartitions("place")
    return rows.mapInArrow(run, "lang string, source string, term string, n long, total long, lead boolean")


def probability(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms))`` in exact decimals."""
    wide = lambda c: c.cast("decimal(20,0)")
    above, below = F.lit(SCALE).cast("decimal(10,0)") * wide(count + PRIOR), wide(total) + wide(terms * PRIOR)
    return F.call_function("div", above, F.when(below > 0, below)) + 1


def difference(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))`` of two probabilities, which fit in 31 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _compared(key, cells: pa.Table, groups: pa.Table) -> pa.Table:
    """All pairs of a block's sources: the sum of the differences over the block's terms."""
    names = groups["source"].to_pylist()
    known = {s: i for i, s in enumerate(names)}
    _, term = np.unique(cells["term"].to_numpy(), return_inverse=True)
    p = np.repeat(groups["base"].to_numpy()[:, None], term.max() + 1 if len(term) else 0, axis=1)
    coded = cells["source"].combine_chunks().dictionary_encode() if len(term) else None
    if coded is not None:
        p[np.array([known[s] for s in coded.dictionary.to_pylist()])[coded.indices.to_numpy()], term] = cells["p"].to_numpy()
    left, right, value = [], [], []
    for i in range(len(names) - 1):
        d = p[i + 1 :] - p[i]
        f = (d * d // (p[i + 1 :] + p[i])).sum(axis=1)
        left += [i] * len(f)
        right += range(i + 1, len(names))
        value.append(f)
    values = np.concatenate(value) if value else np.zeros(0, np.int64)
    name = pa.array(names, pa.string())
    left, right = name.take(pa.array(left, pa.int64())), name.take(pa.array(right, pa.int64()))
    lang = pa.array([key[0].as_py()] * len(values), pa.string())
    return pa.table({"lang": lang, "source": left, "item": right, "value": pa.array(values, pa.int64())})


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each ordered pair of a language's sources."""
    sized = groups.withColumn("blocks", F.expr(f"greatest(1, cast(ceil(terms * sources / {BLOCK_CELLS}) as int))"))
    spread = sized.select("lang", "source", "base", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    place = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    per_lang = sized.groupBy("lang").agg(F.max("blocks").alias("blocks"))
    placed = cells.join(per_lang, "lang").select("lang", place, "source", F.xxhash64("term", F.lit(7)).alias("term"), "p")
    sums = placed.groupBy("lang", "block").cogroup(spread.groupBy("lang", "block"))
    sums = sums.applyInArrow(_compared, "lang string, source string, item string, value long")
    half = stored(sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pairs")
    return half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` compares a source with the language's others, part ``term`` lists the
    ``top`` terms that it uses more than the language does."""
    kept = stored(kept_terms(docs, min_docs), "kept-terms")
    present = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    held = kept.groupBy("lang", "source").agg(F.sum("n").alias("held"))
    wide = kept.groupBy("lang").agg(F.count_if("lead").alias("terms"), F.sum("n").alias("lang_held"))
    groups = present.join(held, ["lang", "source"], "left").join(wide, "lang", "left").fillna(0, ["held", "terms", "lang_held"])
    groups = groups.withColumn("sources", F.count("*").over(Window.partitionBy("lang")))
    groups = stored(groups.withColumn("base", F.coalesce(probability(F.lit(0), F.col("held"), F.col("terms")), F.lit(1))), "groups")

    cells = kept.join(groups, ["lang", "source"])
    cells = cells.withColumn("p", probability(F.col("n"), F.col("held"), F.col("terms")))
    pairs = _pairs(cells.select("lang", "source", "term", "p"), groups).withColumn("part", F.lit("pair"))

    q = probability(F.col("total"), F.col("lang_held"), F.col("terms"))
    above = cells.withColumn("q", q).filter("p > q")
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")).alias("rank")
    out = ["lang", "source", "part", "item", "value", "rank"]
    first = above.withColumn("rank", place).filter(F.col("rank") <= top).select(out)
    return pairs.withColumn("rank", place).select(out).unionByName(first)
