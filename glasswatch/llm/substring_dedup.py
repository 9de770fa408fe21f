"""Removal of repeated word passages, found by fixed-block anchors.

Every text is cut into non-overlapping blocks of ``block`` words, the reference index. A run of ``window`` words holds a whole
block of its own text wherever it lies, as ``2 * block - 1 <= window``. Each text's rolling windows of ``block`` words probe
the index: hashes of blocks and probes meet in hash ranges, packed and sorted, so a probe costs about five bytes. An anchor is
a block that occurs at a second place; all its places are hits. Hits are extended: the ``window``-word runs around them, under full 64-bit
hashes, meet the same way, and those that occur twice are joined where they touch or overlap. Such a stretch holds every maximal exact repeat of ``window``
words or more that lies there; repeats that share words with different partners are one stretch. Nothing is ever paired, so a
passage in a million texts costs a million places.

The first hash has as many bits as the size of the input asks for; a chance meeting only adds a hit. The second has 64: of ``n`` runs
around hits, about ``n**2 / 2**65`` pairs meet by chance. Words are unchanged. Null texts have no words. Equal rows are different
places, so repeated rows lose all runs of ``window`` words; ``doc_id`` may be null. Extra columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasswatch.llm.packing import hash_bits, pack, pack_small, ranges_for, unpack, unpack_small
from glasswatch.llm.tables import ship
from glasswatch.llm.words import U, chunks, ngrams, words_of

#: Places held before they are packed and sent.
FLUSH = 1 << 22
BLOBS = "part int, hashes binary, places binary, width int, keys array<long>, firsts array<long>"
PLACES = "k long, places array<int>"


class Sender:
    """Collects hashed places of texts and packs them by hash range."""

    def __init__(self, parts: int, bits: int):
        self.parts, self.bits = parts, bits
        self.clear()

    def clear(self):
        self.h, self.at, self.keys, self.firsts, self.words = [], [], [], [], 0

    def add(self, keys: np.ndarray, first: np.ndarray, at: np.ndarray, mark: np.ndarray, h: np.ndarray):
        """Places ``at`` (word in the chunk) with a mark bit and a hash; rows' keys and first words."""
        self.h.append(h >> U(64 - self.bits) if self.bits < 64 else h)
        self.at.append(((at + self.words).astype(U) << U(1)) | mark.astype(U))
        self.keys.append(keys)
        self.firsts.append(first[:-1] + self.words)
        self.words += int(first[-1])

    @property
    def full(self) -> bool:
        return self.words >= FLUSH

    def flush(self) -> pa.RecordBatch:
        h, at = np.concatenate(self.h), np.concatenate(self.at)
        keys, firsts = np.concatenate(self.keys), np.concatenate(self.firsts)
        owner = np.searchsorted(firsts, (at >> U(1)).astype(np.int64), "right") - 1
        order = np.argsort(h, kind="stable")
        h, at, owner = h[order], at[order], owner[order]
        below = U(self.bits - (self.parts.bit_length() - 1))
        edges = np.append(np.searchsorted(h, np.arange(self.parts, dtype=U) << below), len(h))
        width = max(1, (int(at.max()).bit_length() + 7) // 8) if len(at) else 1
        rows = []
        for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            if b > a:
                # an empty text begins where the next one does; the last of these owns the words
                own = np.unique(owner[a:b])
                rows.append((p, pack(h[a:b]), pack_small(at[a:b], width), width, keys[own], firsts[own]))
        self.clear()
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [c.split(" ")[0] for c in BLOBS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _meet(needs_mark: bool) -> Callable[[pa.Table], pa.Table]:
    """Of all places of a hash range, those whose hash occurs twice (and, if asked for, has a marked place), by text."""

    def run(table: pa.Table) -> pa.Table:
        hs, marks, owners, places, keys, n = [], [], [], [], [], 0
        for r in table.select(["hashes", "places", "width", "keys", "firsts"]).to_pylist():
            at = unpack_small(r["places"], r["width"])
            firsts = np.array(r["firsts"], np.int64)
            word = (at >> U(1)).astype(np.int64)
            own = np.searchsorted(firsts, word, "right") - 1
            hs.append(unpack(r["hashes"]))
            marks.append((at & U(1)).astype(bool))
            places.append((word - firsts[own]).astype(np.int32))
            owners.append((own + n).astype(np.int32))
            keys.append(np.array(r["keys"], np.int64))
            n += len(firsts)
        h = np.concatenate(hs)
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        count = np.diff(np.append(first, len(h)))
        good = count > 1
        if needs_mark:
            good &= np.add.reduceat(np.concatenate(marks)[order].astype(np.int64), first) > 0
        hit = order[np.repeat(good, count)]
        k, at = np.concatenate(keys)[np.concatenate(owners)[hit]], np.concatenate(places)[hit]
        order = np.lexsort((at, k))
        k, at = k[order], at[order]
        new = np.flatnonzero(np.concatenate([[len(k) > 0], k[1:] != k[:-1]]))
        lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(k)).astype(np.int32)), pa.array(at))
        return pa.table([pa.array(k[new]), lists], ["k", "places"])

    return run


def _by_text(places: DataFrame) -> DataFrame:
    """All places of a text, which the text's length bounds."""
    return places.groupBy("k").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))


def probes(texts: DataFrame, block: int, parts: int, bits: int) -> DataFrame:
    """Every rolling window of ``block`` words; those that are reference blocks are marked."""

    def run(batches):
        s = Sender(parts, bits)
        for b in batches:
            keys = b.column(0).to_numpy()
            for c in chunks(b.column(1)):
                w = words_of(c)
                at, h = ngrams(w, block)
                s.add(keys[c.lo : c.hi], w.first, at, (at - w.first[w.row[at]]) % block == 0, h)
                if s.full:
                    yield s.flush()
        if s.words:
            yield s.flush()

    return texts.mapInArrow(run, BLOBS)


def runs_around(texts: DataFrame, block: int, window: int, parts: int) -> DataFrame:
    """The ``window``-word runs that contain a hit of ``texts(doc_id, text, k, places)``."""

    def run(batches):
        s = Sender(parts, 64)
        for b in batches:
            keys, hits = b.column(2).to_numpy(), b.column(3)
            lengths = np.diff(np.concatenate([[0], np.cumsum([len(x.values) if x.is_valid else 0 for x in hits])]))
            flat = hits.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            for c in chunks(b.column(1)):
                w = words_of(c)
                row = np.repeat(np.arange(c.hi - c.lo), lengths[c.lo : c.hi])
                hit = flat[ends[c.lo] : ends[c.hi]] + w.first[row]
                near = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(near, np.maximum(hit - (window - block), w.first[row]), 1)
                np.add.at(near, hit + 1, -1)
                at, h = ngrams(w, window)
                pick = np.cumsum(near[:-1])[at] > 0
                s.add(keys[c.lo : c.hi], w.first, at[pick], np.zeros(int(pick.sum()), bool), h[pick])
                if s.full:
                    yield s.flush()
        if s.words:
            yield s.flush()

    return texts.mapInArrow(run, BLOBS)


def _kept(window: int):
    def run(batches):
        for b in batches:
            counts, removed, texts, spans = [], [], [], []
            for t, starts in zip(b.column(1), b.column(3), strict=True):
                words = (t.as_py() or "").encode().split()
                first = starts.values.to_numpy().astype(np.int64) if starts.is_valid else np.zeros(0, np.int64)
                if len(first):
                    new = np.flatnonzero(np.concatenate([[True], first[1:] > first[:-1] + window]))
                    lo, hi = first[new], first[np.append(new[1:], len(first)) - 1] + window
                    keep = np.ones(len(words), bool)
                    for x, y in zip(lo, hi, strict=True):
                        keep[x:y] = False
                    kept = list(compress(words, keep.tolist()))
                    spans.append(list(map(int, np.stack([lo, hi], 1).ravel())))
                else:
                    kept = words
                    spans.append([])
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "repeats", "kept_text"],
            )

    return run


def substring_dedup(docs: DataFrame, window: int = 35, block: int | None = None) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_removed``, ``repeats`` (starts and ends of stretches covered by repeats, in words, in turn) and
    ``kept_text``, the other words joined by blanks. A word goes if a run of ``window`` words that covers it also starts elsewhere."""
    block = block or (window + 1) // 2
    if not 1 <= 2 * block - 1 <= window:
        raise ValueError("a run of window words must hold a whole block")
    ship(docs.sparkSession)
    parts, total = ranges_for(docs)
    bits = max(hash_bits(total), parts.bit_length() + 8)
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))
    hits = _by_text(probes(keyed.select("k", "text"), block, parts, bits).groupBy("part").applyInArrow(_meet(True), PLACES))
    # dealt by text once; both joins below use this exchange
    dealt = keyed.repartition("k")
    marked = dealt.join(hits.hint("shuffle_hash"), "k", "left").select("doc_id", "text", "k", "places")
    starts = _by_text(runs_around(marked, block, window, parts).groupBy("part").applyInArrow(_meet(False), PLACES))
    joined = dealt.join(starts.hint("shuffle_hash"), "k", "left").select("doc_id", "text", "k", "places")
    return joined.mapInArrow(_kept(window), "doc_id long, n_words long, n_removed long, repeats array<int>, kept_text string")
