"""Benchmark decontamination by latent semantic retrieval.

Texts fall into blocks of ``BLOCK`` words; a passage is two neighbouring blocks, so passages overlap by half and hold any run of
``BLOCK`` words whole. Words, A-Z folded, are hashed into FEATURES columns and weighted by the inverse passage frequency over all
documents. A randomised SVD of the TF-IDF passages gives the latent space: ``(AᵀA)Ω`` is summed over tasks for a random ``Ω``, twice, with an
orthonormal basis taken between, and the space is whitened by the singular values. The fit uses every distinct block of all texts, as
frequencies, search and checks do: a task adds its blocks up to ``AᵀA`` before it meets ``Ω``, so a block costs its pairs of words.

Benchmark items are cut into pieces of ``BLOCK`` words. Passages whose cosine with a piece reaches ``least_cosine`` are candidates.
So is every place where ``n + BLOCK`` words could hold ``least_lcs`` of an item's ``n`` words, whatever its cosine: of the words to be
matched, at least PROBES are among the item's rarest, as many as may be missing and PROBES more; places with so many of these
close together are found through an index of them. So no subsequence of ``least_lcs`` in that many words is missed. Around each, the longest common subsequence of the item's words and the text's is measured, so paraphrases with words put in, left
out or replaced still count. A document is contaminated by an item if the subsequence covers ``least_lcs`` of the item and the item's
answer, its last sentence, is covered by ``least_answer``, or if it covers ``sure_lcs``. Items are searched in blocks of ITEMS_AT_ONCE.

Null and empty texts and items match nothing; rows without an id take part with a null id. Repeated rows give the same pairs once.
Extra columns are ignored. Texts are searched whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasswatch.llm.tables import give_back, ship, stored
from glasswatch.llm.words import FOLDED, SMALL_CHUNK, Chunk, U, Words, chunks, mix, words_of

BLOCK = 16
FEATURES = 1 << 12
RANK = 128
#: Power of the inverse passage frequency; above 1 it keeps the commonest words from ruling the space.
DAMPING = 1.5
ITEMS_AT_ONCE = 20_000
FIXED_POINT = 1 << 24
#: Of an item's rarest words, how many a place must hold; fewer are rarer words, more are fewer places by chance.
PROBES = 3
#: Rows of the sums over pairs of features that are held together.
BAND = 256
#: First bits of a word's hash, of which a table tells whether any rare word begins with them; most words are let go by it.
MAYBE_BITS = 20


@dataclass(frozen=True)
class Limits:
    least_cosine: float = 0.5
    least_lcs: float = 0.6
    least_answer: float = 0.5
    sure_lcs: float = 0.8


def _features(w: Words) -> np.ndarray:
    return (w.hash >> U(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def _blocks(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and row of each block of the chunk's texts."""
    counts = np.diff(w.first)
    n = (counts + BLOCK - 1) // BLOCK
    row = np.repeat(np.arange(len(counts)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return w.first[:-1][row] + at * BLOCK, row


def passage_counts(docs: DataFrame) -> DataFrame:
    """``(feature, n)``: in how many blocks a feature is, and as feature FEATURES all blocks; with feature -1, ``passage``: the features of
    a block, two bytes each."""

    def rows(feature, n, passage):
        return pa.RecordBatch.from_arrays([pa.array(feature, pa.int32()), pa.array(n, pa.int64()), passage], ["feature", "n", "passage"])

    def run(batches):
        give_back()
        sums, n = np.zeros(FEATURES, np.int64), 0
        for b in batches:
            for c in chunks(b.column(0), SMALL_CHUNK):
                w = words_of(c, FOLDED)
                if not len(w.hash):
                    continue
                start, _ = _blocks(w)
                f = _features(w)
                ends = np.append(start, len(f))
                # a row for each block, in order: what differs from the one before it is there for the first time
                held = np.full((len(start), BLOCK), FEATURES, np.uint16)
                held[np.arange(BLOCK) < np.diff(ends)[:, None]] = f
                held.sort(axis=1)
                once = np.ones(held.shape, bool)
                np.not_equal(held[:, 1:], held[:, :-1], out=once[:, 1:])
                sums += np.bincount(held[once], minlength=FEATURES + 1)[:FEATURES]
                n += len(start)
                ends = pa.py_buffer(ends.astype(np.int32) * 2)
                passages = pa.Array.from_buffers(pa.binary(), len(start), [None, ends, pa.py_buffer(f.astype("<u2"))])
                yield rows(np.full(len(start), -1), np.zeros(len(start), np.int64), passages)
        used = np.flatnonzero(sums)
        yield rows(np.append(FEATURES, used), np.append(n, sums[used]), pa.nulls(len(used) + 1, pa.binary()))

    return docs.select("text").mapInArrow(run, "feature int, n long, passage binary")


def _weighted(passages: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and TF-IDF weights of passages, a row of BLOCK places each; what a short one lacks has no weight."""
    joined = b"".join(passages.to_pylist())
    n = pc.binary_length(passages).to_numpy() // 2
    inside = np.arange(BLOCK) < n[:, None]
    f = np.zeros((len(n), BLOCK), np.int64)
    f[inside] = np.frombuffer(joined, "<u2")
    weight = np.where(inside, idf[f], 0.0)
    return f, weight / np.sqrt(np.maximum((weight * weight).sum(1), 1e-12))[:, None]


def latent_basis(fit: DataFrame, idf: np.ndarray, rank: int) -> np.ndarray:
    """Whitened right singular vectors of the TF-IDF rows of ``fit(passage)``: FEATURES x rank.

    A task adds up its rows' share of ``AᵀAX`` in whole numbers, so the sums don't depend on the order of tasks.
    """
    spark = fit.sparkSession
    x = np.random.default_rng(7).standard_normal((FEATURES, rank)) / np.sqrt(rank)
    columns = [F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(rank)]
    values = np.ones(rank)
    for _ in range(2):
        held = spark.sparkContext.broadcast((x, idf))

        def run(batches, held=held):
            x, idf = held.value
            give_back()
            # frequent features side by side: most sums stay in the processor's cache
            order = np.argsort(idf, kind="stable")
            place = np.argsort(order)
            # of each pair one half, the other one is its mirror image: a band of rows has no columns before its own first
            starts = np.arange(0, FEATURES, BAND)
            size = BAND * (FEATURES - starts)
            begin = np.cumsum(size) - size
            band = np.arange(FEATURES) // BAND
            at = begin[band] + (np.arange(FEATURES) - starts[band]) * (FEATURES - starts[band]) - starts[band]
            half = np.zeros(size.sum())
            for b in batches:
                f, weight = _weighted(b.column(0), idf)
                f = place[f]
                inner = np.argsort(f, axis=1)
                f, weight = (np.ascontiguousarray(np.take_along_axis(v, inner, 1).T) for v in (f, weight))
                for i in range(BLOCK):
                    row = at[f[i]]
                    for j in range(i, BLOCK):
                        np.add.at(half, row + f[j], weight[i] * weight[j] * (0.5 if i == j else 1.0))
            x, sums = x[order], np.zeros((FEATURES, rank))
            for lo, a, n in zip(starts, begin, size, strict=True):
                part = half[a : a + n].reshape(BAND, -1)
                sums[lo : lo + BAND] += part @ x[lo:]
                sums[lo:] += part.T @ x[lo : lo + BAND]
            del half, part
            out = np.empty((FEATURES, rank))
            out[order] = sums
            used = np.flatnonzero(np.abs(out).sum(1))
            fixed = np.rint(out[used] * FIXED_POINT).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * rank), pa.array(fixed.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), lists], ["f", "v"])

        rows = fit.select("passage").mapInArrow(run, "f int, v array<long>").groupBy("f").agg(*columns).toArrow()
        z = np.zeros((FEATURES, rank))
        z[rows.column("f").to_numpy()] = np.stack([rows.column(f"v{i}").to_numpy() for i in range(rank)], 1) / FIXED_POINT
        # z = AᵀA x; of an orthonormal x, the eigenvalues of xᵀz are the squared singular values
        q, r = np.linalg.qr(z)
        values = np.abs(np.linalg.svd(r, compute_uv=False))
        u, _, _ = np.linalg.svd(r)
        x = q @ u
    return (x / np.sqrt(np.maximum(values, values.max() * 1e-6 + 1e-12))).astype(np.float32)


def _lcs(mask: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence with a sequence of ``n`` words whose places ``mask`` has as bits."""
    full = v = (1 << n) - 1
    for m in filter(None, map(mask.get, words)):
        u = v & m
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, x in enumerate(words):
        out[x] = out.get(x, 0) | 1 << i
    return out


def last_sentence(text: str) -> str:
    """The part of an item that gives its answer: its last sentence of three words or more, else its last eight words."""
    parts = [p for p in re.split(r"(?<=[.!?\n])\s+", text.strip()) if len(p.split()) >= 3]
    return parts[-1] if len(parts) > 1 else " ".join(text.split()[-8:])


def _words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for c in chunks(pa.array(texts, pa.string())):
        w = words_of(c, FOLDED)
        out += [w.hash[a:b] for a, b in zip(w.first, w.first[1:], strict=False)]
    return out


class Items:
    """Benchmark items as pieces in the latent space and word sequences."""

    def __init__(self, rows: list[tuple[int | None, str]], basis: np.ndarray, idf: np.ndarray, least_lcs: float = Limits.least_lcs):
        self.ids = [r[0] for r in rows]
        self.words = [w.tolist() for w in _words([r[1] for r in rows])]
        self.masks = [_masks(w) for w in self.words]
        self.answers = [w.tolist() for w in _words([last_sentence(r[1]) for r in rows])]
        self.answer_masks = [_masks(w) for w in self.answers]
        # a row per feature, weighted; the last one pads short blocks
        self.rows = np.concatenate([basis * idf.astype(np.float32)[:, None], np.zeros((1, basis.shape[1]), np.float32)])
        pieces, owner = [], []
        for i, w in enumerate(self.words):
            starts = [*range(0, max(1, len(w) - BLOCK + 1), BLOCK)]
            if len(w) > BLOCK and starts[-1] + BLOCK < len(w):
                starts.append(len(w) - BLOCK)
            for a in starts if w else []:
                f = (np.array(w[a : a + BLOCK], U) >> U(64 - FEATURES.bit_length() + 1)).astype(np.int64)
                v = self.rows[f].sum(0)
                pieces.append(v / max(1e-9, float(np.linalg.norm(v))))
                owner.append(i)
        self.pieces, self.owner = np.array(pieces, np.float32).reshape(-1, basis.shape[1]), np.array(owner, np.int64)
        self._index(idf, least_lcs)

    def _index(self, idf: np.ndarray, least_lcs: float) -> None:
        """The rarest words of all items with the items they belong to, and how many of them an item asks for."""
        pairs: list[tuple[int, int]] = []
        self.span = np.array([len(w) + BLOCK for w in self.words], np.int64)
        self.probes = np.zeros(len(self.words), np.int64)
        shift = 64 - FEATURES.bit_length() + 1
        for i, w in enumerate(self.words):
            need = max(1, math.ceil(least_lcs * len(w) - 1e-9))
            self.probes[i] = min(PROBES, need)
            missing = len(w) - need + self.probes[i]
            for word in sorted(set(w), key=lambda x: (-idf[x >> shift], x)):
                if missing <= 0:
                    break
                pairs.append((word, i))
                missing -= self.masks[i][word].bit_count()
        pairs.sort()
        self.rare, first = np.unique(np.array([x for x, _ in pairs], U), return_index=True)
        self.rare_first, self.rare_item = np.append(first, len(pairs)), np.array([i for _, i in pairs], np.int64)
        self.maybe = np.zeros(1 << MAYBE_BITS, bool)
        self.maybe[(self.rare >> U(64 - MAYBE_BITS)).astype(np.int64)] = True


def block_vectors(w: Words, start: np.ndarray, row: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the latent rows of each block's words."""
    f = np.append(_features(w), FEATURES)
    at = start[:, None] + np.arange(BLOCK)
    f = f[np.where(at < w.first[1:][row][:, None], at, len(f) - 1)]
    out = np.zeros((len(start), rows.shape[1]), np.float32)
    for lo in range(0, len(start), 1024):
        for i in range(BLOCK):
            out[lo : lo + 1024] += rows[f[lo : lo + 1024, i]]
    return out


def candidates(w: Words, items: Items, least: float):
    """(row, item, first word, word after the last) of neighbouring passages of a chunk that are close to an item."""
    start, row = _blocks(w)
    block = block_vectors(w, start, row, items.rows)
    passage = block.copy()
    same = row[1:] == row[:-1]
    passage[:-1][same] += block[1:][same]
    passage /= np.maximum(np.linalg.norm(passage, axis=1), 1e-9)[:, None]
    seen: dict[tuple[int, int], list[int]] = {}
    for lo in range(0, len(passage), 4096):
        for at in range(0, len(items.pieces), 1024):  # a product of 16 MB at a time, however many pieces there are
            near = passage[lo : lo + 4096] @ items.pieces[at : at + 1024].T >= least
            close = np.flatnonzero(near.any(axis=1))  # few passages are
            i, j = np.nonzero(near[close])
            for p, item in zip((close[i] + lo).tolist(), items.owner[j + at].tolist(), strict=True):
                seen.setdefault((int(row[p]), item), []).append(p)
    for (r, item), passages in seen.items():
        passages = sorted(set(passages))
        reach = len(items.words[item]) // BLOCK + 2
        first = last = passages[0]
        for p in passages[1:]:
            if p - last > reach:
                yield r, item, int(start[first]), int(start[last]) + 2 * BLOCK
                first = p
            last = p
        yield r, item, int(start[first]), int(start[last]) + 2 * BLOCK


def word_candidates(w: Words, items: Items):
    """(row, item, first word, word after the last) of places of a chunk with enough of an item's rarest words within its span."""
    if not len(items.rare):
        return
    pos = np.flatnonzero(items.maybe[(w.hash >> U(64 - MAYBE_BITS)).astype(np.int64)])
    at = np.minimum(np.searchsorted(items.rare, w.hash[pos]), len(items.rare) - 1)
    found = items.rare[at] == w.hash[pos]
    pos, at = pos[found], at[found]
    lo = items.rare_first[at]
    n = items.rare_first[at + 1] - lo
    item = items.rare_item[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    pos = np.repeat(pos, n)
    row = w.row[pos]
    order = np.lexsort((pos, row, item))
    pos, row, item = pos[order], row[order], item[order]
    # the last of as many words as the item asks for, counted from each
    last = np.arange(len(pos)) + items.probes[item] - 1
    inside = np.minimum(last, len(pos) - 1)
    enough = (last < len(pos)) & (item[inside] == item) & (row[inside] == row) & (pos[inside] - pos < items.span[item])
    before = None
    for i, r, p in zip(item[enough].tolist(), row[enough].tolist(), pos[enough].tolist(), strict=True):
        if (i, r) != before or p >= end:
            before, end = (i, r), p + int(items.span[i])
            yield r, i, p, end


def _found(c: Chunk, it, limits: Limits) -> dict[tuple[int, int], tuple[float, float]]:
    """Row and item of each match in a chunk of texts, with the largest shares of the item and of its answer."""
    w = words_of(c, FOLDED)
    best: dict[tuple[int, int], tuple[float, float]] = {}
    if not len(w.hash) or not len(it.pieces):
        return best
    found = [(*x, 0) for x in candidates(w, it, limits.least_cosine)] + [(*x, BLOCK) for x in word_candidates(w, it)]
    for r, item, first, end, more in found:
        n = len(it.words[item])
        words = w.hash[max(w.first[r], first - n - more) : min(w.first[r + 1], end + n + more)].tolist()
        share = _lcs(it.masks[item], n, words) / n
        if share >= limits.least_lcs:
            answer = _lcs(it.answer_masks[item], len(it.answers[item]), words) / max(1, len(it.answers[item]))
            if share >= limits.sure_lcs or answer >= limits.least_answer:
                best[r, item] = max(best.get((r, item), (0.0, 0.0)), (share, answer))
    return best


def matches(docs: DataFrame, items, limits: Limits) -> DataFrame:
    """``doc_id``, ``item_id``, ``lcs`` and ``answer`` (shares of the item and its answer) of contaminated documents."""

    def run(batches):
        it = items.value
        for b in batches:
            ids, out = b.column(0), []
            for c in chunks(b.column(1), SMALL_CHUNK):
                out += [(ids[c.lo + r].as_py(), it.ids[i], x, y) for (r, i), (x, y) in _found(c, it, limits).items()]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "item_id", "lcs", "answer"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, lcs double, answer double")
    return found.groupBy("doc_id", "item_id").agg(F.round(F.max("lcs"), 6).alias("lcs"), F.round(F.max("answer"), 6).alias("answer"))


def without_matches(docs: DataFrame, items, limits: Limits) -> DataFrame:
    """The rows of ``docs`` whose text holds none of the items, told in the pass that reads the text: nothing is shuffled."""

    def clean(text: pa.Array) -> pa.Array:
        keep = np.ones(len(text), bool)
        for c in chunks(text, SMALL_CHUNK):
            keep[[c.lo + r for r, _ in _found(c, items.value, limits)]] = False
        return pa.array(keep)

    return docs.filter(F.arrow_udf(clean, "boolean")("text"))


def latent_space(docs: DataFrame, rank: int = RANK) -> tuple[np.ndarray, np.ndarray]:
    """The basis and the inverse passage frequencies of a corpus."""
    ship(docs.sparkSession)
    counted = stored(passage_counts(docs), "passages")
    rows = counted.filter("feature >= 0").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(FEATURES + 1)
    n[rows.column("feature").to_numpy()] = rows.column("n").to_numpy()
    idf = np.maximum(np.log(max(1.0, n[FEATURES]) / (1.0 + n[:FEATURES])), 0.0) ** DAMPING
    # copies would each bend the space towards themselves: a passage counts once
    fit = stored(counted.filter("feature = -1").select("passage").distinct(), "fit")
    return latent_basis(fit, idf, rank), idf


def _item_blocks(docs: DataFrame, benchmark: DataFrame, limits: Limits) -> Iterator[Broadcast]:
    """The items of a benchmark with the space of the documents, ITEMS_AT_ONCE of them at a time; one empty block if there are none."""
    spark = ship(docs.sparkSession)
    basis, idf = latent_space(docs)
    rows = benchmark.filter("text is not null").select("item_id", "text").distinct().orderBy("item_id", "text")
    held: list[tuple[int | None, str]] = []
    blocks = 0
    for r in rows.toLocalIterator():
        held.append((r["item_id"], r["text"]))
        if len(held) == ITEMS_AT_ONCE:
            yield spark.sparkContext.broadcast(Items(held, basis, idf, limits.least_lcs))
            held, blocks = [], blocks + 1
    if held or not blocks:
        yield spark.sparkContext.broadcast(Items(held, basis, idf, limits.least_lcs))


def contaminated(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pairs ``doc_id``, ``item_id`` of documents that hold a benchmark item, with ``lcs`` and ``answer``."""
    found = reduce(DataFrame.union, [matches(docs, items, limits) for items in _item_blocks(docs, benchmark, limits)])
    return found.groupBy("doc_id", "item_id").agg(F.max("lcs").alias("lcs"), F.max("answer").alias("answer"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    return reduce(lambda left, items: without_matches(left, items, limits), _item_blocks(docs, benchmark, limits), docs)
