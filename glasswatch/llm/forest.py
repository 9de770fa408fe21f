"""A forest of random-projection trees in numpy: fitting on a sample, leaves of vectors, and the order in which queries visit leaves.

Vectors are scaled by the largest norm and get one more component that brings them to length one; a query gets length one and a
zero there. The largest inner product is then the smallest angle, so plain trees serve vectors of any lengths.

All nodes of a tree's level share one direction; the directions of a tree are orthonormal as far as the dimension allows.
Each node is cut at the median of the sample's vectors in it.

A query's priority of a leaf is the log-likelihood, over the cuts on its path, that a near vector lies on the leaf's side. It can
only fall along a path, so taking leaves of all trees by falling priority is what a shared priority queue of nodes hands out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: How far a near vector's projection strays from the query's, as a part of the sample's spread, and the slope that makes the
#: logistic function follow the normal distribution's.
STRAY, LOGISTIC = 0.92, 1.702


class Forest(NamedTuple):
    """``directions``: trees x dimension x depth; ``cuts``: trees x inner nodes, level by level; ``norm``: the largest length."""

    directions: np.ndarray
    cuts: np.ndarray
    norm: float
    spread: float

    @property
    def trees(self) -> int:
        return len(self.cuts)

    @property
    def depth(self) -> int:
        return self.directions.shape[2]

    @property
    def leaves(self) -> int:
        return 1 << self.depth


def on_sphere(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Vectors of at most length ``norm`` as unit vectors with one more component."""
    scaled = vectors.astype(np.float64) / norm
    rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
    return np.hstack([scaled, rest[:, None]])


def as_queries(vectors: np.ndarray) -> np.ndarray:
    """Queries of any length as unit vectors with a zero as the one more component."""
    scaled = vectors.astype(np.float64)
    scaled = scaled / np.abs(scaled).max(axis=1, keepdims=True)
    scaled /= np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return np.hstack([scaled, np.zeros((len(scaled), 1))])


def _directions(rng: np.random.Generator, size: int, depth: int) -> np.ndarray:
    blocks = [np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(-(-max(depth, 1) // size))]
    return np.hstack(blocks)[:, :depth]


def fit(sample: np.ndarray, norm: float, trees: int, depth: int, seed: int) -> Forest:
    """Trees of ``depth`` levels over a sample of vectors; the same sample and seed give the same trees."""
    rng = np.random.default_rng(seed)
    points = on_sphere(sample, norm)
    size, n = points.shape[1], len(points)
    directions = np.empty((trees, size, depth))
    cuts = np.zeros((trees, (1 << depth) - 1))
    spreads = []
    for t in range(trees):
        directions[t] = _directions(rng, size, depth)
        places = points @ directions[t]
        spreads.append(places.std() if places.size else 0.0)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first = (1 << level) - 1
            order = np.lexsort((places[:, level], node))
            count = np.bincount(node, minlength=1 << level)
            middle = np.cumsum(count) - count + count // 2
            some = count > 0
            cuts[t, first : first + len(count)][some] = places[order[middle[some]], level]
            node = 2 * node + (places[:, level] >= cuts[t, first + node])
    return Forest(directions, cuts, norm, max(STRAY * float(np.mean(spreads)), 1e-9))


def leaves_of(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """The leaf of each vector in each tree: n x trees."""
    points = on_sphere(vectors, forest.norm)
    out = np.zeros((len(points), forest.trees), np.int64)
    for t in range(forest.trees):
        places = points @ forest.directions[t]
        node = out[:, t]
        for level in range(forest.depth):
            node[:] = 2 * node + (places[:, level] >= forest.cuts[t, (1 << level) - 1 + node])
    return out


def priorities(forest: Forest, queries: np.ndarray) -> np.ndarray:
    """Priority of each leaf of each tree for each query: n x (trees * leaves), at most 0."""
    points = as_queries(queries)
    out = np.empty((len(points), forest.trees, forest.leaves), np.float32)
    for t in range(forest.trees):
        places = points @ forest.directions[t]
        path = np.zeros((len(points), 1), np.float32)
        for level in range(forest.depth):
            first = (1 << level) - 1
            margin = (places[:, level : level + 1] - forest.cuts[t, first : 2 * first + 1]) * (LOGISTIC / forest.spread)
            right = -np.logaddexp(0.0, -margin).astype(np.float32)
            both = np.empty((len(points), 2 * path.shape[1]), np.float32)
            both[:, 1::2] = path + right
            both[:, 0::2] = path + (right - margin.astype(np.float32))
            path = both
        out[:, t] = path
    return out.reshape(len(points), -1)


def visits(forest: Forest, queries: np.ndarray, sizes: np.ndarray, budget: int) -> np.ndarray:
    """Which leaves each query takes off the queue until they hold ``budget`` rows together: n x (trees * leaves), Boolean."""
    order = np.argsort(-priorities(forest, queries), axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1)
    taken = np.zeros(order.shape, bool)
    np.put_along_axis(taken, order, held - sizes[order] < budget, axis=1)
    return taken


def rows_until(forest: Forest, queries: np.ndarray, sizes: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """How many rows the queue has handed out when it first reaches one of the given ``leaves`` (n x wanted x trees): n x wanted."""
    order = np.argsort(-priorities(forest, queries), axis=1, kind="stable")
    held = np.empty(order.shape, np.int64)
    np.put_along_axis(held, order, np.cumsum(sizes[order], axis=1), axis=1)
    wanted = leaves + np.arange(forest.trees) * forest.leaves
    flat = wanted.reshape(len(queries), -1)
    return np.take_along_axis(held, flat, axis=1).reshape(wanted.shape).min(axis=2)
