"""Nearest neighbours against brute force: recall, exact scores, ties, copies, and rows that take no part."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from glasswatch.llm import forest, neighbours

SCHEMA = "vec_id long, embedding array<double>, label int, cls string"


def brute(rows, k, is_query):
    vectors = {i: np.array(v, float) for i, v in rows}
    out = {}
    for i, q in vectors.items():
        if is_query(i):
            near = sorted((-float((q * v).sum()), j) for j, v in vectors.items() if j != i)
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x") for i, v in rows], SCHEMA)


def test_recall_on_many_vectors_of_different_lengths(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 24))
    data = centres[rng.integers(0, 40, 6000)] + 0.7 * rng.standard_normal((6000, 24))
    data *= rng.uniform(0.5, 2.0, (6000, 1))
    rows = list(enumerate(data.round(6).tolist()))
    got = collected(neighbours.nearest(frame(spark, rows).repartition(5), F.col("vec_id") % 20 == 0))
    want = brute(rows, 20, lambda i: i % 20 == 0)
    assert got.keys() == want.keys()
    hits = 0
    for q, near in want.items():
        assert len(got[q]) == 20
        scores = dict(got[q])
        edge = near[-1][1]
        hits += sum(s >= edge - 1e-12 for s in scores.values())
        for j, s in scores.items():
            assert math.isclose(s, float(np.dot(data[q].round(6), data[j].round(6))), rel_tol=1e-12, abs_tol=1e-12)
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
    assert hits / (20 * len(want)) >= 0.9


def test_small_tables_are_searched_whole_with_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 3).tolist()) for i in range(400)]
    rows = [(i, v) for i, v in rows if any(v)]
    rows += [(1000 + i, [1.0, 1.0, 0.0]) for i in range(300)]
    got = collected(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == brute(rows, 20, lambda i: i % 20 == 0)


def test_rows_that_take_no_part(spark):
    good = [(20, [1, 0]), (1, [0, 1]), (2, [-1, 0]), (40, [3, 4])]
    bad = [(60, None), (80, []), (100, [0, 0]), (120, [1, None]), (140, [1, math.nan]), (160, [math.inf, 1]), (180, [1, 2, 3]), (None, [1, 1])]
    got = collected(neighbours.nearest(frame(spark, good + bad + good[:2]), F.col("vec_id") % 20 == 0))
    assert got == brute(good, 20, lambda i: i % 20 == 0)


def test_one_id_with_two_vectors_counts_once(spark):
    got = collected(neighbours.nearest(frame(spark, [(20, [1, 0]), (5, [1, 0]), (5, [0, 1]), (7, [1, 1])]), F.col("vec_id") == 20))
    assert [i for i, _ in got[20]] in ([5, 7], [7, 5]) and len(got) == 1


def test_empty_tables_and_tables_without_queries(spark):
    assert neighbours.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert neighbours.nearest(frame(spark, [(1, [1, 2])]), F.col("vec_id") % 20 == 0).collect() == []
    assert neighbours.nearest(frame(spark, [(20, [1, 2])]), F.col("vec_id") % 20 == 0).collect() == []


def test_floats_and_blocks_of_several_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)  # read on the driver only
    monkeypatch.setattr(neighbours, "LEAST_ROWS", 4)
    rng = np.random.default_rng(3)
    data = rng.standard_normal((2000, 8)).astype(np.float32)
    data[:900, 1:] = data[0, 1:]  # a dense region: blocks above the limit are dealt over parts
    rows = list(enumerate(data.tolist()))
    df = frame(spark, rows).withColumn("embedding", F.col("embedding").cast("array<float>"))
    got, want = collected(neighbours.nearest(df, F.col("vec_id") % 10 == 0, recall=1.0)), brute(rows, 20, lambda i: i % 10 == 0)
    found = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert found >= 0.97 * 20 * len(want)


def test_priorities_fall_along_paths_and_visits_follow_them():
    rng = np.random.default_rng(4)
    data = rng.standard_normal((500, 6))
    trees = forest.fit(data, float(np.linalg.norm(data, axis=1).max()), 3, 5, 1)
    leaves = forest.leaves_of(trees, data)
    sizes = np.concatenate([np.bincount(leaves[:, t], minlength=32) for t in range(3)])
    assert sizes.reshape(3, 32).sum(axis=1).tolist() == [500] * 3 and sizes.max() <= 17
    ranks = forest.priorities(trees, data[:20])
    taken = forest.visits(trees, data[:20], sizes, 200)
    for r, t in zip(ranks, taken, strict=True):
        assert r[t].min() >= r[~t].max()
        assert sizes[t].sum() >= 200 > sizes[t].sum() - sizes[t][np.argmin(r[t])]
    need = forest.rows_until(trees, data[:20], sizes, leaves[:20, None, :])
    assert (need >= 1).all() and (need <= 1500).all()


@pytest.mark.parametrize("k", [1, 3])
def test_k_is_honoured(spark, k):
    rows = [(i, [i + 1.0, 1.0]) for i in range(30)]
    assert collected(neighbours.nearest(frame(spark, rows), F.col("vec_id") < 5, k=k)) == brute(rows, k, lambda i: i < 5)
