"""Trees of a boosted model as arrays in heap order, and the sums and splits they grow from.

The children of node i are 2 i + 1 and 2 i + 2. A row goes left if its value is below the cut,
or its bin at or below the cut's bin. Small numpy helpers, used inside tasks and on sums.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

BINS = 256
NO_VALUE = 255  # the bin of missing values
LEAST_GAIN = 1e-6


@dataclass
class Tree:
    feature: np.ndarray  # -1 at leaves, -2 at places the tree has not reached
    bin: np.ndarray
    cut: np.ndarray
    left: np.ndarray  # whether rows without a value go left
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        feature = np.full(n, -2, dtype=np.int64)
        feature[0] = -1
        return cls(
            feature, np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n, dtype=bool), np.zeros(n)
        )

    def open_at(self, depth: int) -> bool:
        return bool((self.feature[2**depth - 1 : 2 ** (depth + 1) - 1] == -1).any())


def MISSING(bins: np.ndarray) -> np.ndarray:
    return bins == NO_VALUE


def bin_values(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    bins = np.searchsorted(borders, values, "right").astype(np.uint8)
    bins[np.isnan(values)] = NO_VALUE
    return bins


def leaves(
    tree: Tree, x: np.ndarray, cut: np.ndarray, missing: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """The node each row ends at; `x` has a row per feature, of values or of bins."""
    whole = x.dtype == np.uint8
    node = np.zeros(x.shape[1], dtype=np.int64)
    row = np.arange(x.shape[1])
    while True:
        feature = tree.feature[node]
        inner = np.flatnonzero(feature >= 0)
        if not len(inner):
            return node
        at = node[inner]
        v = x[feature[inner], row[inner]]
        below = v <= cut[at] if whole else v < cut[at]
        node[inner] = 2 * at + 2 - np.where(missing(v), tree.left[at], below)


def node_histograms(
    tree: Tree, bins: np.ndarray, gradient: np.ndarray, depth: int, unit: float
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients, in units, and of Hessians by (node of the level, feature, bin)."""
    first, nodes = 2**depth - 1, 2**depth
    node = leaves(tree, bins, tree.bin, MISSING)
    here = np.flatnonzero(node >= first)
    whole = np.rint(gradient[here] / unit)
    features = len(bins)
    sums, counts = [], []
    for f in range(features):
        key = (node[here] - first) * BINS + bins[f, here]
        sums.append(np.bincount(key, weights=whole, minlength=nodes * BINS))
        counts.append(np.bincount(key, minlength=nodes * BINS))
    shape = (features, nodes, BINS)
    return tuple(
        np.stack(v).reshape(shape).transpose(1, 0, 2).ravel().astype(np.int64)
        for v in (sums, counts)
    )


def best_splits(
    tree: Tree,
    depth: int,
    borders: list[np.ndarray],
    slot: np.ndarray,
    gradient: np.ndarray,
    hessian: np.ndarray,
    rate: float,
    l2: float,
    least: float,
) -> None:
    """Split the level's nodes where that gains most, and give their children values."""
    first, nodes, features = 2**depth - 1, 2**depth, len(borders)
    g = np.zeros(nodes * features * BINS)
    h = np.zeros_like(g)
    g[slot], h[slot] = gradient, hessian
    g, h = g.reshape(nodes, features, BINS), h.reshape(nodes, features, BINS)
    for k in np.flatnonzero(tree.feature[first : first + nodes] == -1).tolist():
        node = first + k
        total_g, total_h = g[k, 0].sum(), h[k, 0].sum()
        if not depth:
            tree.value[node] = -rate * total_g / (total_h + l2)
        best = None
        most = LEAST_GAIN
        for f in range(features):
            cuts = len(borders[f])
            if not cuts:
                continue
            below_g, below_h = np.cumsum(g[k, f, :cuts]), np.cumsum(h[k, f, :cuts])
            absent_g, absent_h = g[k, f, NO_VALUE], h[k, f, NO_VALUE]
            for to_left in (False, True) if absent_h else (False,):
                gl, hl = below_g + to_left * absent_g, below_h + to_left * absent_h
                gr, hr = total_g - gl, total_h - hl
                gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - total_g**2 / (total_h + l2)
                gain[(hl < least) | (hr < least)] = -np.inf
                at = int(gain.argmax())
                if gain[at] > most:
                    most, best = gain[at], (f, at, to_left, gl[at], hl[at])
        if best is not None:
            f, at, to_left, gl, hl = best
            tree.feature[node], tree.bin[node], tree.left[node] = f, at, to_left
            tree.cut[node] = borders[f][at]
            tree.feature[2 * node + 1 : 2 * node + 3] = -1
            tree.value[2 * node + 1] = -rate * gl / (hl + l2)
            tree.value[2 * node + 2] = -rate * (total_g - gl) / (total_h - hl + l2)


def boost_block(
    bins: np.ndarray,
    target: np.ndarray,
    margin: np.ndarray,
    borders: list[np.ndarray],
    rounds: int,
    max_depth: int,
    unit: float,
    *settings: float,
) -> list[Tree]:
    """All trees of rows that are a single block: its sums are the sums of all rows."""
    trees = []
    for _ in range(rounds):
        tree = Tree.empty(max_depth)
        for depth in range(max_depth):
            if not tree.open_at(depth):
                break
            g, h = node_histograms(tree, bins, margin - target, depth, unit)
            slot = np.flatnonzero(h)
            best_splits(
                tree, depth, borders, slot, g[slot] * unit, h[slot].astype(float), *settings
            )
        margin = margin + tree.value[leaves(tree, bins, tree.bin, MISSING)]
        trees.append(tree)
    return trees
