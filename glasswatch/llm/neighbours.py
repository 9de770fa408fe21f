"""Nearest neighbours by largest inner product: a forest of random-projection trees, one priority queue over all of them, exact reranking.

1. Equal vectors are one class, known by its smallest id; classes are indexed and searched, their ids come back at the end. A
   vector that a third of all rows share is one entry, and at most ``k + 1`` of its ids are carried.
2. The trees are fitted on a sample of at most ``MOST_SAMPLE`` distinct vectors; every distinct vector is then put into its leaf of every tree.
3. How many rows a query takes off the queue is found by brute force: for ``TRIALS`` queries the true neighbours among all rows
   are found, and the budget is what reaches ``recall`` of them. The rest of a query's work doesn't depend on the sample.
4. Leaves that lie together in the trees form blocks. A vector goes to its block of each tree, a query once to each block in which it visits
   any leaf. A block of too many vectors is split into parts, each of which gets the block's queries. Queries stream past a part,
   so a task holds one part at a time.
5. Scores are inner products in double precision of the vectors as given; ties go to the smaller id.

Left out, as query and as candidate: rows whose id or vector is null, vectors without components, zero vectors, vectors with null, NaN or infinite
components, and vectors whose length isn't the most common one (of equally common ones the smallest). Of different vectors under
one id that with the smallest hash counts; equal rows count once. Ties go to the smaller id. With at most ``k`` other rows a query gets all
of them. Empty tables give no rows. Extra columns are ignored. A query's own id is never its neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasswatch.llm import forest as rp
from glasswatch.llm.tables import ship, stored

TREES = 4
#: Rows of a leaf, as far as the sample allows (SAMPLE_LEAF sampled vectors to a leaf), and of a block and tree.
LEAF_ROWS, SAMPLE_LEAF, BLOCK_ROWS = 16, 4, 16_384
#: The sample grows with the rows up to MOST_SAMPLE.
LEAST_SAMPLE, MOST_SAMPLE, SAMPLE_SHARE = 8_192, 262_144, 1 / 8
TRIALS = 256
#: Rows a query takes from each tree at least; smaller tables are searched whole.
LEAST_ROWS = 1_024
RECALL, SEED = 0.94, 11
QUERY_TILE, LEAF_TILE = 2_048, 256
_MESSAGE = "block int, part int, kind int, tree int, ids binary, vectors binary, marks binary"
_HITS = "hits array<struct<below: double, id: long>>"


class Plan(NamedTuple):
    """What every task needs: the trees, rows per leaf, rows a query takes, levels above a block, parts per block, component type, result size."""

    trees: rp.Forest
    sizes: np.ndarray
    budget: int
    block_depth: int
    parts: np.ndarray
    dtype: str
    k: int

    @property
    def block_leaves(self) -> int:
        return self.trees.leaves >> self.block_depth


def distinct_vectors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``id, v, is_query``: ``cls, v, is_query``, a row per distinct vector, and ``id, cls, is_query`` of the rows in classes of several."""
    hashed = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    one = hashed.select("id", "h1", "h2").distinct().groupBy("id").agg(F.min(F.struct("h1", "h2")).alias("of"), F.count("*").alias("n"))
    clash = stored(one.filter("n > 1").select("id", "of"), "clash")
    hashed = hashed.join(clash, "id", "left").filter("of is null or (of.h1 = h1 and of.h2 = h2)").drop("of")
    classes = hashed.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("cls"), F.max("is_query").alias("asked"))
    shared = stored(classes.filter("n > 1").select("h1", "h2", "cls", "asked"), "shared")
    joined = hashed.join(shared, ["h1", "h2"], "left")
    single = joined.filter("cls is null").select(F.col("id").alias("cls"), "v", "is_query")
    several = joined.filter("cls is not null")
    firsts = several.groupBy("cls").agg(F.first("v").alias("v"), F.first("asked").alias("is_query"))
    return single.unionByName(firsts), several.select("id", "cls", "is_query")


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def _hit_lists(below: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    values = pa.StructArray.from_arrays([pa.array(below, pa.float64()), pa.array(ids, pa.int64())], ["below", "id"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _merged(hits: DataFrame, key: str, k: int, salt: Column | None = None) -> DataFrame:
    """The best ``k`` distinct hits of each key; ``salt`` merges in two steps."""
    best = lambda x: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(x)))), 1, k).alias("hits")
    if salt is not None:
        hits = hits.groupBy(key, salt.alias("_salt")).agg(best("hits"))
    return hits.groupBy(key).agg(best("hits"))


def exact_neighbours(vectors: DataFrame, queries: np.ndarray, dtype: str, k: int) -> DataFrame:
    """``q`` (place in ``queries``) and ``hits``, its ``k`` nearest of ``cls, v``, by brute force over all rows in one pass."""
    asked = queries.astype(np.float64)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            scores = asked @ _matrix(b.column(1), dtype).astype(np.float64).T
            top = min(k, len(ids))
            order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :top]
            below = 0.0 - np.take_along_axis(scores, order, axis=1)
            lists = _hit_lists(below.ravel(), ids[order].ravel(), np.full(len(asked), top))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(asked)), pa.int32()), lists], ["q", "hits"])

    return _merged(vectors.select("cls", "v").mapInArrow(run, f"q int, {_HITS}"), "q", k, F.spark_partition_id() % 64)


def leaf_sizes(vectors: DataFrame, trees: rp.Forest, dtype: str) -> np.ndarray:
    """Rows in each leaf, tree after tree."""

    def run(batches):
        total = np.zeros(trees.trees * trees.leaves, np.int64)
        for b in batches:
            if b.num_rows:
                places = rp.leaves_of(trees, _matrix(b.column(0), dtype)) + np.arange(trees.trees) * trees.leaves
                total += np.bincount(places.ravel(), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["leaf", "n"])

    counted = vectors.select("v").mapInArrow(run, "leaf int, n long").groupBy("leaf").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(trees.trees * trees.leaves, np.int64)
    out[counted["leaf"].to_numpy()] = counted["n"].to_numpy()
    return out


def _sample(df: DataFrame, rows: int, wanted: int, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """About ``wanted`` of ``rows`` rows, never more than an eighth above it; picked by hash, so that reruns pick the same."""
    cut = F.lit(min(2**63 - 1, int(2**64 * min(1.0, wanted / max(rows, 1))) - 2**63))
    picked = df.select("cls", "v").filter(F.xxhash64("v", F.lit(SEED)) <= cut).limit(wanted + wanted // 8 + 64).toArrow()
    picked = picked.sort_by("cls")
    v = picked["v"].combine_chunks() if picked.num_rows else pa.array([], pa.list_(pa.float64()))
    return picked["cls"].to_numpy(), _matrix(v, dtype)


def make_plan(vectors: DataFrame, dtype: str, k: int, trees: int, recall: float) -> Plan | None:
    """Fit the forest on a sample, count all leaves, and find the budget that reaches ``recall`` of the neighbours of the trial queries."""
    scale = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    n, asked, norm = vectors.agg(F.count("*"), F.count_if("is_query"), F.sqrt(F.max(scale))).first()
    if not asked:
        return None
    wanted = min(max(LEAST_SAMPLE, int(n * SAMPLE_SHARE)), MOST_SAMPLE)
    _, sample = _sample(vectors, n, wanted, dtype)
    depth = max(0, min(int(math.log2(max(1, n / LEAF_ROWS))), int(math.log2(max(1, len(sample) / SAMPLE_LEAF)))))
    fitted = rp.fit(sample if len(sample) else np.ones((1, 1)), norm * (1 + 1e-12), trees, depth, SEED) if depth else None
    if fitted is None:
        size = len(vectors.select("v").first()["v"]) + 1
        fitted = rp.Forest(np.zeros((trees, size, 0)), np.zeros((trees, 0)), norm * (1 + 1e-12), 1.0)
    sizes = leaf_sizes(vectors, fitted, dtype)
    own, trial = _sample(vectors.filter("is_query"), asked, TRIALS, dtype)
    budget = _budget(vectors, fitted, sizes, own, trial, dtype, k, recall)
    block_depth = max(0, min(depth, math.ceil(math.log2(max(1, n / BLOCK_ROWS)))))
    in_block = sizes.reshape(trees, 1 << block_depth, -1).sum(axis=2).max(axis=0)
    parts = np.maximum(1, -(-in_block // (2 * BLOCK_ROWS)))
    return Plan(fitted, sizes, budget, block_depth, parts, dtype, k)


def _budget(vectors, fitted, sizes, own, trial, dtype, k, recall) -> int:
    least = fitted.trees * LEAST_ROWS
    if not len(own):
        return int(sizes.sum())
    exact = {r["q"]: [h["id"] for h in r["hits"]] for r in exact_neighbours(vectors, trial, dtype, k + 1).collect()}
    near = [(q, [i for i in exact[q] if i != own[q]][:k]) for q in range(len(own))]
    wanted = sorted({i for _, ids in near for i in ids})  # at most TRIALS * k ids
    if not wanted:
        return least
    keys = vectors.sparkSession.createDataFrame([(i,) for i in wanted], "cls long")
    found = vectors.join(F.broadcast(keys), "cls", "left_semi").select("cls", "v").toArrow().sort_by("cls")
    leaf = dict(zip(found["cls"].to_pylist(), rp.leaves_of(fitted, _matrix(found["v"].combine_chunks(), dtype)), strict=True))
    need = [rp.rows_until(fitted, trial[q : q + 1], sizes, np.array([[leaf[i] for i in ids]])).ravel() for q, ids in near if ids]
    need = np.sort(np.concatenate(need))
    return max(least, int(need[min(len(need) - 1, math.ceil(recall * len(need)) - 1)]))


def vector_messages(vectors: DataFrame, plan: Plan) -> DataFrame:
    """Every vector to its block in each tree, the vectors of a batch that go the same way packed into one row."""

    def run(batches):
        shift, local = plan.trees.depth - plan.block_depth, plan.block_leaves - 1
        for b in batches:
            if not b.num_rows:
                continue
            ids, v = b.column(0).to_numpy(), _matrix(b.column(1), plan.dtype)
            leaves = rp.leaves_of(plan.trees, v)
            out = []
            for t in range(plan.trees.trees):
                block = leaves[:, t] >> shift
                part = ids % plan.parts[block]
                order = np.lexsort((part, block))
                ends = np.flatnonzero(np.diff(block[order]) | np.diff(part[order])) + 1
                for at in np.split(order, ends):
                    marks = (leaves[at, t] & local).astype("<u4")
                    out.append((int(block[at[0]]), int(part[at[0]]), 0, t, ids[at].astype("<i8").tobytes(), v[at].tobytes(), marks.tobytes()))
            yield _batch(out)

    return vectors.select("cls", "v").mapInArrow(run, _MESSAGE)


def query_messages(vectors: DataFrame, plan: Plan) -> DataFrame:
    """Every query to the blocks in which it visits leaves, with a bit for each leaf of the block."""

    def run(batches):
        blocks = 1 << plan.block_depth
        tile = max(1, (1 << 22) // (plan.trees.trees * plan.trees.leaves))
        for b in batches:
            ids, v = b.column(0).to_numpy(), _matrix(b.column(1), plan.dtype)
            for lo in range(0, len(ids), tile):
                part_ids, part_v = ids[lo : lo + tile], v[lo : lo + tile]
                taken = rp.visits(plan.trees, part_v, plan.sizes, plan.budget)
                taken = taken.reshape(len(part_ids), plan.trees.trees, blocks, plan.block_leaves).transpose(2, 0, 1, 3)
                out = []
                for block in range(blocks):
                    at = np.flatnonzero(taken[block].any(axis=(1, 2)))
                    if len(at):
                        bits = np.packbits(taken[block][at].reshape(len(at), -1), axis=1)
                        row = (1, 0, part_ids[at].astype("<i8").tobytes(), part_v[at].tobytes(), bits.tobytes())
                        out += [(block, p, *row) for p in range(int(plan.parts[block]))]
                yield _batch(out)

    return vectors.filter("is_query").select("cls", "v").mapInArrow(run, _MESSAGE)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32()] * 4 + [pa.binary()] * 3
    names = ["block", "part", "kind", "tree", "ids", "vectors", "marks"]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


class Part:
    """The vectors of one part of a block, per tree in the order of their leaves."""

    def __init__(self, plan: Plan):
        self.plan, self.rows, self.trees = plan, [[] for _ in range(plan.trees.trees)], None

    def add(self, tree: int, ids: bytes, vectors: bytes, marks: bytes) -> None:
        n = len(ids) // 8
        self.rows[tree].append((np.frombuffer(ids, "<i8"), np.frombuffer(vectors, self.plan.dtype).reshape(n, -1), np.frombuffer(marks, "<u4")))

    def close(self) -> None:
        self.trees = []
        for rows in self.rows:
            if not rows:
                self.trees.append(None)
                continue
            ids, v, leaf = (np.concatenate(c) for c in zip(*rows, strict=True))
            order = np.lexsort((ids, leaf))
            starts = np.searchsorted(leaf[order], np.arange(self.plan.block_leaves + 1))
            self.trees.append((ids[order], v[order].astype(np.float64), starts))
        self.rows = None

    def search(self, queries: np.ndarray, visited: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest visited vectors of each query: negated scores, ids, and how many of each."""
        k, n = self.plan.k + 1, len(queries)
        floor = np.full(n, -np.inf)  # what a vector must reach to be among the k best
        found = []
        for t, tree in enumerate(self.trees):
            if tree is None:
                continue
            ids, v, starts = tree
            best, row = np.full((n, k), -np.inf), np.full((n, k), -1, np.int64)
            for lo, hi in _leaf_tiles(starts):
                at = np.flatnonzero(visited[:, t, lo:hi].any(axis=1))
                if not len(at) or starts[lo] == starts[hi]:
                    continue
                scores = queries[at] @ v[starts[lo] : starts[hi]].T
                scores[~np.repeat(visited[at, t, lo:hi], np.diff(starts[lo : hi + 1]), axis=1)] = -np.inf
                better = scores.max(axis=1) >= floor[at]
                at, scores = at[better], scores[better]
                if not len(at):
                    continue
                rows = np.broadcast_to(np.arange(starts[lo], starts[hi]), scores.shape)
                best[at], row[at] = _best(np.hstack([best[at], scores]), np.hstack([row[at], rows]), ids, k)
                floor[at] = np.maximum(floor[at], best[at].min(axis=1))
            found.append(_rescored(queries, v, ids, best, row))
        if not found:
            return np.zeros(0), np.zeros(0, np.int64), np.zeros(n, np.int64)
        return _union(np.hstack([f[0] for f in found]), np.hstack([f[1] for f in found]), k)


def _leaf_tiles(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of leaves that hold about LEAF_TILE rows together."""
    lo, last = 0, len(starts) - 1
    while lo < last:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + LEAF_TILE, "right")) - 1)
        hi = min(hi, last)
        yield lo, hi
        lo = hi


def _best(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest scores of each line, in any order; of equal ones at the edge those with the smallest ids."""
    if scores.shape[1] <= k:
        return scores, rows
    pick = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    out, out_rows = np.take_along_axis(scores, pick, axis=1), np.take_along_axis(rows, pick, axis=1)
    edge = out.min(axis=1)
    tied = np.flatnonzero((edge > -np.inf) & ((scores >= edge[:, None]).sum(axis=1) > k))
    if len(tied):
        names = np.where(rows[tied] >= 0, ids[rows[tied]], np.iinfo(np.int64).max)
        order = np.lexsort((names, -scores[tied]), axis=1)[:, :k]
        out[tied], out_rows[tied] = np.take_along_axis(scores[tied], order, axis=1), np.take_along_axis(rows[tied], order, axis=1)
    return out, out_rows


def _rescored(queries, v, ids, best, row):
    """Scores summed anew, a pair at a time, so that they don't depend on the place in a matrix product."""
    scores = np.full(best.shape, -np.inf)
    q, c = np.nonzero((row >= 0) & (best > -np.inf))
    scores[q, c] = (queries[q] * v[row[q, c]]).sum(axis=1)
    return scores, np.where(scores > -np.inf, ids[np.maximum(row, 0)], np.iinfo(np.int64).max)


def _union(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trees' lists as one: each id once, the ``k`` best of a line."""
    order = np.lexsort((ids, -scores), axis=1)
    scores, ids = np.take_along_axis(scores, order, axis=1), np.take_along_axis(ids, order, axis=1)
    keep = scores > -np.inf
    keep[:, 1:] &= ids[:, 1:] != ids[:, :-1]  # one id has one score, so its copies are neighbours unless others tie with it
    by_id = np.lexsort((scores, ids), axis=1)
    sorted_ids = np.take_along_axis(ids, by_id, axis=1)
    again = np.zeros(ids.shape, bool)
    np.put_along_axis(again, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
    keep &= ~again
    keep &= np.cumsum(keep, axis=1) <= k
    return 0.0 - scores[keep], ids[keep], keep.sum(axis=1)


def search(messages: DataFrame, plan: Plan) -> DataFrame:
    """``q`` and its ``hits`` in one part of a block, a row for each tile of queries that meets the part."""

    def run(batches):
        key, part = None, None
        for b in batches:
            for block, number, kind, tree, ids, vectors, marks in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (block, number) != key:
                    key, part = (block, number), Part(plan)
                if kind == 0:
                    part.add(tree, ids, vectors, marks)
                    continue
                if part.trees is None:
                    part.close()
                names = np.frombuffer(ids, "<i8")
                v = np.frombuffer(vectors, plan.dtype).reshape(len(names), -1).astype(np.float64)
                bits = np.frombuffer(marks, np.uint8).reshape(len(names), -1)
                for lo in range(0, len(names), QUERY_TILE):
                    rows = slice(lo, lo + QUERY_TILE)
                    visited = np.unpackbits(bits[rows], axis=1, count=plan.trees.trees * plan.block_leaves).astype(bool)
                    below, found, counts = part.search(v[rows], visited.reshape(len(visited), plan.trees.trees, -1))
                    lists = _hit_lists(below, found, counts)
                    yield pa.RecordBatch.from_arrays([pa.array(names[rows], pa.int64()), lists], ["q", "hits"])

    dealt = messages.repartition("block", "part").sortWithinPartitions("block", "part", "kind")
    return dealt.mapInArrow(run, f"q long, {_HITS}")


def _rows(table: DataFrame, id_column: str, vector_column: str, is_query: Column) -> DataFrame:
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.filter(F.col("id").isNotNull() & sound & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return rows.filter(F.size("v") == (common["n"] if common else 0))


def nearest(
    table: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
    trees: int = TREES, recall: float = RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for the rows where ``is_query`` holds, their ``k`` nearest other rows."""
    spark = ship(table.sparkSession)
    dtype = "<f4" if "array<float>" in table.select(vector_column).schema.simpleString() else "<f8"
    vectors, several = distinct_vectors(_rows(table, id_column, vector_column, is_query))
    plan = make_plan(vectors, dtype, k, trees, recall)
    if plan is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    messages = vector_messages(vectors, plan).unionByName(query_messages(vectors, plan))
    classes = _merged(search(messages, plan), "q", k + 1)
    return _named(classes, several, k)


def _named(classes: DataFrame, several: DataFrame, k: int) -> DataFrame:
    """Classes back to ids: the smallest ``k + 1`` ids of each class found, for each query id of a class."""
    few = Window.partitionBy("cls").orderBy("id")
    ids = several.select("cls", "id").distinct().withColumn("n", F.row_number().over(few)).filter(F.col("n") <= k + 1)
    ids = stored(ids.groupBy("cls").agg(F.collect_list("id").alias("ids")), "class-ids")
    hits = classes.select("q", F.explode("hits").alias("h")).select("q", "h.below", F.col("h.id").alias("cls")).join(ids, "cls", "left")
    hits = hits.withColumn("id", F.explode(F.coalesce("ids", F.array("cls"))))
    best = hits.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("below", "id"))), 1, k + 1).alias("hits"))
    # classes of one row are their own query; the others are looked up, as many rows may share one
    asked = several.filter("is_query").select("cls", F.col("id").alias("query_id")).distinct()
    shared = asked.select("cls").distinct()
    alone = best.join(shared, best["q"] == shared["cls"], "left_anti").withColumn("query_id", F.col("q"))
    rest = asked.join(best, asked["cls"] == best["q"])
    rows = alone.select("query_id", "hits").unionByName(rest.select("query_id", "hits"))
    own = F.slice(F.filter("hits", lambda h: h["id"] != F.col("query_id")), 1, k)
    rows = rows.select("query_id", F.posexplode(own).alias("at", "h"))
    return rows.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("h.id").alias("vec_id"), (0.0 - F.col("h.below")).alias("score"))
