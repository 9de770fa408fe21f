"""N-gram Jaccard join by vertical partitioning, and the components of its links.

A document's set holds its distinct word n-grams, A-Z folded to a-z, as 64-bit hashes (two n-grams of a pair collide
with probability below |A||B| / 2**64). All n-grams have one global order: those outside a list of the most frequent
ones come first, by hash; the listed ones follow, rarest first. The order is cut into fragments at fixed pivots, so
every set falls into segments, and a pair's overlap is the sum of the overlaps counted in each fragment alone.

Candidates come from the first n-grams of each set in that order: with ``n`` members and a threshold of ``t`` percent,
two linked sets share SHARED of their first ``n - ceil(t n / 100) + SHARED`` (or all that are needed, if fewer). A block is all sets with such an n-gram in
common. It isn't expanded into pairs. First every set is compared with the block's anchor, the set in which
the n-gram comes earliest; then only sets of one block that are still in different components are paired. A block of
near copies thus costs its size, and every link between components is still looked for, so the components are exact.

Equal sets are one node. Tables: ``documents(doc_id, text)``. Rows without text or words have an empty set and no
links; rows without ``doc_id`` have a set but take no part in links and get no component. Repeated rows are
equal sets. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.llm.graph import components
from glasswatch.llm.packing import hash_bits, pack, ranges_for, unpack
from glasswatch.llm.tables import give_back, ship, stored
from glasswatch.llm.words import FOLDED, SMALL_CHUNK, U, chunks, mix, ngrams, words_of

#: Bound of the list of frequent n-grams, which every task holds: 16 bytes each. It only shapes the order.
FREQUENT = 1 << 19
#: Pivots: fragments of the n-grams outside the list by hash, and of the listed ones by rank.
HASH_FRAGMENTS, RANK_FRAGMENTS = 6, 2
#: How many of the first n-grams a pair must share.
SHARED = 8
#: Bits of the filter by which tasks know the sets to be compared. False hits only cost time.
FILTER_BITS = 1 << 25
LISTED = U(1 << 63)


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each chunk: first row, offsets into the n-grams by row, and the distinct n-grams of each row."""
    for c in chunks(texts, SMALL_CHUNK):
        w = words_of(c, FOLDED)
        at, h = ngrams(w, size)
        row = w.row[at]
        count = np.diff(w.first)
        short = np.flatnonzero((count > 0) & (count < size))
        if len(short):  # the whole sequence is the only member
            whole = [mix(np.sum(w.hash[w.first[r] : w.first[r + 1]] * (U(2) * np.arange(1, count[r] + 1, dtype=U) + U(1)), keepdims=True) ^ U(count[r]))[0] for r in short]
            row, h = np.concatenate([row, short]), np.concatenate([h, np.array(whole, U)])
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        row, h = row[new], h[new]
        yield c.lo, np.searchsorted(row, np.arange(len(c.offsets))), h


def _signature(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each whole set."""
    sums = np.zeros(len(h) + 1, U)
    np.cumsum(mix(h ^ U(0xA0761D6478BD642F)), out=sums[1:])
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) + np.diff(offsets).astype(U)).view(np.int64)


def set_sizes(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id``, the number of its distinct n-grams ``n``, and ``sig``, which equal sets share."""

    def run(batches):
        for b in batches:
            ids = b.column(0)
            for lo, offsets, h in _sets(b.column(1), size):
                n = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([ids.slice(lo, n), pa.array(np.diff(offsets).astype(np.int64)), pa.array(_signature(h, offsets))], ["doc_id", "n", "sig"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, sig long")


def frequent_ngrams(docs: DataFrame, size: int, limit: int = FREQUENT) -> tuple[np.ndarray, int]:
    """The n-grams in the most documents, rarest first, as the top bits of their hashes, and the number of these bits.

    All n-grams of all documents are counted, hash range by hash range; each range names its share of ``limit``. Where there
    are more ranges than that, every so many-th range names one, so the list never grows beyond ``limit``.
    """
    parts, total = ranges_for(docs)
    bits = max(hash_bits(total), parts.bit_length() + 8)
    below = U(bits - (parts.bit_length() - 1))
    share, every = max(1, limit // parts), max(1, -(-parts // limit))

    def flush(held):
        v = np.sort(np.concatenate(held))
        cuts = np.searchsorted(v, np.arange(parts + 1, dtype=U) << below)
        rows = [(p, pack(v[a:b])) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a and p % every == 0]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "blob"])

    def spread(batches):
        give_back()
        held, n = [], 0
        for b in batches:
            for _, _, h in _sets(b.column(0), size):
                held.append(h >> U(64 - bits))
                n += len(h)
                if n >= 1 << 21:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    def count(table: pa.Table) -> pa.Table:
        v = np.sort(np.concatenate([unpack(x.as_py()) for x in table.column("blob")]))
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        n = np.diff(np.append(first, len(v)))
        keep = n >= 3
        v, n = v[first][keep], n[keep]
        top = np.lexsort((v, -n))[:share]
        return pa.table({"v": v[top].astype(np.int64), "n": n[top].astype(np.int64)})

    rows = docs.select("text").mapInArrow(spread, "part int, blob binary").groupBy("part").applyInArrow(count, "v long, n long").toArrow()
    v, n = rows.column("v").to_numpy(), rows.column("n").to_numpy()
    return v[np.lexsort((v, n))].astype(U), bits


class Order:
    """The global order of n-grams as a 64-bit key, and the fragment of a key."""

    def __init__(self, frequent: np.ndarray, bits: int):
        self.bits = bits
        self.rank = np.argsort(frequent, kind="stable").astype(U)
        self.values = frequent[self.rank.astype(np.int64)]

    def key(self, h: np.ndarray) -> np.ndarray:
        key = h >> U(1)
        if len(self.values):
            v = h >> U(64 - self.bits)
            at = np.minimum(np.searchsorted(self.values, v), len(self.values) - 1)
            listed = self.values[at] == v
            # n-grams that share the counted bits keep an order by their other bits
            key[listed] = LISTED | (self.rank[at[listed]] << U(40)) | (mix(h[listed]) >> U(24))
        return key

    def fragment(self, key: np.ndarray) -> np.ndarray:
        listed = key >= LISTED
        by_hash = (key >> U(47)) * U(HASH_FRAGMENTS) >> U(16)
        by_rank = ((key ^ LISTED) >> U(40)) * U(RANK_FRAGMENTS) // U(max(1, len(self.values))) + U(HASH_FRAGMENTS)
        return np.where(listed, by_rank, by_hash).astype(np.int32)


def _sorted_keys(h: np.ndarray, offsets: np.ndarray, order: Order) -> np.ndarray:
    """Keys of each row's set, in the global order."""
    key = order.key(h)
    return key[np.lexsort((key, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))))]


def prefixes(docs: DataFrame, size: int, percent: int, order) -> DataFrame:
    """A row for each of the first n-grams of every set: block ``h``, ``listed``, ``sig``, ``n``, and position ``pos``."""

    def run(batches):
        give_back()
        o, seen = order.value, set()
        for b in batches:
            for _, offsets, h in _sets(b.column(0), size):
                n, sig = np.diff(offsets), _signature(h, offsets)
                key = _sorted_keys(h, offsets, o)
                # a task names equal sets once
                fresh = np.zeros(len(n), bool)
                for i, s in enumerate(sig.tolist()):
                    if n[i] and s not in seen:
                        seen.add(s)
                        fresh[i] = True
                least = (percent * n + 99) // 100
                take = np.where(fresh, n - least + np.minimum(SHARED, least), 0)
                row = np.repeat(np.arange(len(n)), take)
                pos = np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take)
                k = key[offsets[:-1][row] + pos]
                listed = k >= LISTED
                # blocks may meet by chance: they only name candidates
                block = np.where(listed, k, k >> U(16)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(listed), pa.array(sig[row]), pa.array(n[row].astype(np.int32)), pa.array(pos.astype(np.int32))], ["h", "listed", "sig", "n", "pos"])

    return docs.select("text").mapInArrow(run, "h long, listed boolean, sig long, n int, pos int")


def _places(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two places of a set in the filter."""
    h = mix(sig.view(U))
    return (h % U(FILTER_BITS)).astype(np.int64), ((h >> U(32)) % U(FILTER_BITS)).astype(np.int64)


def set_filter(nodes: DataFrame) -> np.ndarray:
    """A bit set of fixed size that holds every ``sig`` of ``nodes``; bits are joined by an aggregate over its words."""

    def run(batches):
        for b in batches:
            at = np.concatenate(_places(b.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["word", "bit"])

    rows = nodes.select("sig").mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(FILTER_BITS // 32, np.uint32)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return words


def segments(docs: DataFrame, size: int, order, wanted) -> DataFrame:
    """The wanted sets of ``docs``, fragment by fragment: ``sig``, ``fragment``, ``segment`` (the keys that fall into it).

    ``wanted`` is a broadcast filter; texts stay where they are, and a task gives equal sets once.
    """

    def run(batches):
        give_back()
        o, bits, seen = order.value, wanted.value, set()
        held = lambda at: (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1
        for b in batches:
            for _, offsets, h in _sets(b.column(0), size):
                sig = _signature(h, offsets)
                x, y = _places(sig)
                pick = np.flatnonzero((held(x) & held(y)) == 1)
                pick = np.array([i for i, s in zip(pick, sig[pick].tolist(), strict=True) if not (s in seen or seen.add(s))], np.int64)
                if not len(pick):
                    continue
                n = np.diff(offsets)[pick]
                row = np.repeat(np.arange(len(pick)), n)
                h = h[np.repeat(offsets[:-1][pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                key = _sorted_keys(h, np.append(0, np.cumsum(n)), o)
                frag = o.fragment(key)
                new = np.flatnonzero(np.concatenate([[len(key) > 0], (row[1:] != row[:-1]) | (frag[1:] != frag[:-1])]))
                lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(key)).astype(np.int32)), pa.array(key.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(sig[pick][row[new]]), pa.array(frag[new]), lists], ["sig", "fragment", "segment"])

    return docs.select("text").mapInArrow(run, "sig long, fragment int, segment array<long>")


def needed(n: str, m: str):
    """The smallest overlap that links sets of sizes ``n`` and ``m``."""
    return lambda percent: F.ceil(F.lit(percent) * (F.col(n) + F.col(m)) / F.lit(100 + percent))


def shared_blocks(tokens: DataFrame) -> DataFrame:
    """The rows of blocks with two sets or more, with the block's anchor.

    Blocks of listed n-grams may hold any share of the rows: they are summed up by partial aggregates, of which there
    are no more than the list is long, and these go to every task. The others hold sets whose n-gram is
    not among the most frequent, and are dealt by block once.
    """

    def sums(df):
        return (
            df.groupBy("h").agg(F.min("sig").alias("lo"), F.max("sig").alias("hi"), F.min(F.struct("pos", "sig", "n")).alias("first"))
            .filter("lo <> hi").select("h", F.col("first.sig").alias("a"), F.col("first.n").alias("n_a"))
        )

    tokens = tokens.select("h", "listed", "sig", "n", "pos")
    rare = tokens.filter("not listed").drop("listed").repartition("h")
    often = stored(tokens.filter("listed").drop("listed").distinct(), "frequent")
    return rare.join(sums(rare), "h").unionByName(often.join(F.broadcast(sums(often)), "h"))


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b, n_a, n_b)`` that are similar enough: overlaps are counted per fragment and summed per pair."""
    left = sets.select(F.col("sig").alias("a"), "fragment", F.col("segment").alias("of_a"))
    right = sets.select(F.col("sig").alias("b"), "fragment", F.col("segment").alias("of_b"))
    partial = (
        pairs.join(left, "a").join(right, ["b", "fragment"])
        .select("a", "b", "n_a", "n_b", F.size(F.array_intersect("of_a", "of_b")).alias("overlap"))
    )
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return total.filter(F.lit(100) * F.col("overlap") >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("overlap")))


def enough_shared(percent: int):
    """The number of first n-grams that a pair must share."""
    return F.least(F.lit(SHARED), F.ceil(F.lit(percent) * F.least("n_a", "n_b") / F.lit(100)))


def close_pairs(pairs: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """The pairs that share enough of their first n-grams, all of which lie in blocks."""
    left = blocks.select(F.col("sig").alias("a"), "h")
    right = blocks.select(F.col("sig").alias("b"), "h")
    counts = pairs.join(left, "a").join(right, ["b", "h"]).groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared"))
    return counts.filter(F.col("shared") >= enough_shared(percent)).drop("shared")


def compared(docs: DataFrame, pairs: DataFrame, size: int, percent: int, order) -> DataFrame:
    """The linked ones of stored ``pairs``."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    wanted = docs.sparkSession.sparkContext.broadcast(set_filter(nodes))
    sets = segments(docs, size, order, wanted).groupBy("sig", "fragment").agg(F.first("segment").alias("segment"))
    return stored(links(pairs, stored(sets, "segments"), percent).select("a", "b"), "links")


def ngram_components(docs: DataFrame, size: int = 4, percent: int = 85, frequent: int = FREQUENT) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` (size of its set) and ``component_id``, the smallest reachable ``doc_id``.

    Documents link when ``100 * overlap >= percent * union`` of their sets of ``size``-word n-grams. ``frequent`` bounds
    the list that shapes the global order; results don't depend on it.
    """
    docs = docs.select("doc_id", "text")
    spark = ship(docs.sparkSession)
    named = docs.filter("doc_id is not null")
    sizes = stored(set_sizes(docs, size), "sizes")
    values, bits = frequent_ngrams(named, size, frequent)
    order = spark.sparkContext.broadcast(Order(values, bits))

    # dealt by set once: equal sets named by several tasks become one, and sets that share too few n-grams with anyone go
    rows = shared_blocks(prefixes(named, size, percent, order)).repartition("sig").dropDuplicates()
    alone = F.count("*").over(Window.partitionBy("sig")) < F.least(F.lit(SHARED), F.ceil(F.lit(percent) * F.col("n") / F.lit(100)))
    blocks = stored(rows.withColumn("alone", alone).filter("not alone").drop("alone"), "blocks")
    stars = (
        blocks.filter("sig <> a").filter((F.lit(100) * F.least("n", "n_a")) >= F.lit(percent) * F.greatest("n", "n_a"))
        .groupBy("a", F.col("sig").alias("b"), "n_a", F.col("n").alias("n_b")).agg(F.count("*").alias("shared"))
        .filter(F.col("shared") >= enough_shared(percent)).drop("shared")
    )
    first = compared(named, stored(stars, "stars"), size, percent, order)
    roots = components(first)

    placed = stored(
        blocks.join(roots, blocks["sig"] == roots["node"], "left").select("h", "sig", "n", "pos", F.coalesce("root", "sig").alias("root")),
        "placed",
    )
    # a row stays if its block has another component, and if a set as small as the block's smallest could link with it
    open_blocks = placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least")).filter("lo <> hi")
    smallest = F.greatest(F.col("least"), F.ceil(F.lit(percent) * F.col("n") / F.lit(100)))
    alive = placed.join(open_blocks, "h").filter(F.ceil(F.lit(percent) * (F.col("n") + smallest) / F.lit(100 + percent)) <= F.col("n") - F.col("pos"))
    alive = stored(alive.select("h", "sig", "n", "pos", "root"), "alive")
    x = alive.select("h", F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("pos").alias("p_a"), F.col("root").alias("r_a"))
    y = alive.select("h", F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("p_b"), F.col("root").alias("r_b"))
    # where h is the first shared n-gram, no more than what follows it on either side can be shared
    fits = needed("n_a", "n_b")(percent) <= F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b"))
    close = (F.lit(100) * F.least("n_a", "n_b")) >= F.lit(percent) * F.greatest("n_a", "n_b")
    crossing = x.join(y, (x["h"] == y["h"]) & (F.col("a") < F.col("b")) & (F.col("r_a") != F.col("r_b")) & close & fits)
    crossing = stored(close_pairs(crossing.select("a", "b", "n_a", "n_b").distinct(), placed, percent), "crossing")
    if not crossing.isEmpty():
        roots = components(first.union(compared(named, crossing, size, percent, order)))

    named_sizes = sizes.join(roots, sizes["sig"] == roots["node"], "left").select("doc_id", "n", F.coalesce("root", "sig").alias("root"))
    least = named_sizes.filter("doc_id is not null and n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return named_sizes.join(least, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
