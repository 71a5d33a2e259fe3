"""Isolation trees as arrays: growing one from a sample, and walking many at once."""

from __future__ import annotations

import math

import numpy as np


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary search tree of `n` values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def uniforms(seed: np.ndarray, k: int) -> np.ndarray:
    """The k-th number between 0 and 1 that belongs to each 64-bit seed."""
    h = seed + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    h ^= h >> np.uint64(31)
    return ((h >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def grow_tree(x: np.ndarray, depth: int, rng: np.random.Generator):
    """A complete binary tree in heap order: `feature` and `cut` of the inner nodes, and the
    path length stored at each bottom position."""
    inner = 2**depth - 1
    feature = np.zeros(inner, dtype=np.int32)
    cut = np.full(inner, np.inf)  # below a leaf everything falls to the left
    path = np.zeros(inner + 1)
    open_nodes = [(0, 0, np.arange(len(x)))]
    while open_nodes:
        node, level, rows = open_nodes.pop()
        values = x[rows]
        varying = np.flatnonzero(values.max(axis=0) > values.min(axis=0)) if len(rows) > 1 else []
        if level == depth or len(varying) == 0:
            bottom = (node + 1) * 2 ** (depth - level) - 1 - inner
            path[bottom] = level + mean_path(len(rows))
            continue
        f = int(rng.choice(varying))
        feature[node] = f
        cut[node] = rng.uniform(values[:, f].min(), values[:, f].max())
        right = values[:, f] > cut[node]
        open_nodes.append((2 * node + 1, level + 1, rows[~right]))
        open_nodes.append((2 * node + 2, level + 1, rows[right]))
    return feature, cut, path


def path_lengths(
    x: np.ndarray, feature: np.ndarray, cut: np.ndarray, path: np.ndarray, block: int = 8192
) -> np.ndarray:
    """Mean path length of every row over all trees (arrays of shape trees x nodes)."""
    trees, inner = feature.shape
    depth = (inner + 1).bit_length() - 1
    result = np.empty(len(x))
    for start in range(0, len(x), block):  # small blocks stay in the processor cache
        columns = np.ascontiguousarray(x[start : start + block].T)
        values, n = columns.ravel(), columns.shape[1]
        row = np.arange(n)
        total = np.zeros(n)
        for t in range(trees):
            column = feature[t].astype(np.intp) * n
            node = np.zeros(n, dtype=np.intp)
            for _ in range(depth):
                right = values.take(column.take(node) + row) > cut[t].take(node)
                node = 2 * node + 1 + right
            total += path[t].take(node - inner)
        result[start : start + block] = total / trees
    return result
