"""Splits of tree nodes from sums of gradients and Hessians per (node, bin), and trees over binned columns.

The same few functions serve both ways of growing: sums of a level that Spark adds up over all rows, and sums of the
rows of one small node inside a task.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np

from .binning import Layout

#: A Newton split must gain more than this.
LEAST_GAIN = 1e-6
#: Cells (rows x columns) whose sums a task holds at a time while it grows a tree; a larger node is one of its own.
CELLS_AT_ONCE = 1 << 17
#: Decimal places at which gains are compared.
DIGITS = 9


@dataclass(frozen=True)
class Growth:
    """How a tree grows. ``max_depth`` 0 stands for no limit; ``columns`` is the share of features drawn for a tree, or
    with ``per_node`` for each of its nodes."""

    max_depth: int = 6
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    columns: float = 1.0
    per_node: bool = False
    shrink: float = 0.3
    mean: bool = False  # leaves hold the mean target in place of a Newton step


@dataclass
class Splits:
    """The best split of each node; ``column`` is -1 where no split gains."""

    node: np.ndarray
    column: np.ndarray
    code: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    g: np.ndarray
    h: np.ndarray
    left_g: np.ndarray
    left_h: np.ndarray
    rows: np.ndarray
    left_rows: np.ndarray


@dataclass
class Tree:
    """Node 0 is the root; ``column`` is -1 at leaves. A row goes left if its bin is at most ``code`` (numeric), or is
    not ``code`` (category); ``missing_left`` says where a missing number goes."""

    column: np.ndarray
    code: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    @classmethod
    def root(cls) -> Tree:
        kinds = (np.int32, np.int32, bool, np.int32, np.int32, np.float64, np.float64, np.float64)
        tree = cls(*(np.zeros(1, k) for k in kinds))
        tree.column[0] = -1
        return tree

    def leaves(self, codes: np.ndarray, layout: Layout) -> np.ndarray:
        """The leaf that each row of ``codes`` falls into."""
        node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        while len(rows):
            rows = rows[self.column[node[rows]] >= 0]
            at = node[rows]
            left = goes_left(codes[rows, self.column[at]], self.column[at], self.code[at], self.missing_left[at], layout)
            node[rows] = np.where(left, self.left[at], self.right[at])
        return node

    def grow(self, splits: Splits, at: np.ndarray, growth: Growth) -> np.ndarray:
        """Writes the sums of nodes ``at`` and hangs two children below each that is split; returns those children."""
        self.value[at], self.cover[at] = leaf_value(splits.g, splits.h, growth), splits.h
        cut = splits.column >= 0
        parents, n = at[cut], int(cut.sum())
        first = len(self.column)
        for f in fields(self):
            old = getattr(self, f.name)
            setattr(self, f.name, np.concatenate([old, np.full(2 * n, -1 if f.name == "column" else 0, old.dtype)]))
        self.column[parents], self.code[parents] = splits.column[cut], splits.code[cut]
        self.missing_left[parents], self.gain[parents] = splits.missing_left[cut], splits.gain[cut]
        self.left[parents], self.right[parents] = first + 2 * np.arange(n), first + 2 * np.arange(n) + 1
        g = np.stack([splits.left_g[cut], (splits.g - splits.left_g)[cut]], 1).ravel()
        h = np.stack([splits.left_h[cut], (splits.h - splits.left_h)[cut]], 1).ravel()
        children = first + np.arange(2 * n)
        self.value[children], self.cover[children] = leaf_value(g, h, growth), h
        return children

    def graft(self, at: int, sub: Tree) -> None:
        """Puts ``sub`` in the place of leaf ``at``."""
        shift = len(self.column) - 1
        move = lambda x: np.where(x > 0, x + shift, x).astype(np.int32)
        sub = Tree(sub.column, sub.code, sub.missing_left, move(sub.left), move(sub.right), sub.value, sub.gain, sub.cover)
        for f in fields(self):
            mine, other = getattr(self, f.name), getattr(sub, f.name)
            mine[at] = other[0]
            setattr(self, f.name, np.concatenate([mine, other[1:]]))


def goes_left(code, column, split, missing_left, layout: Layout) -> np.ndarray:
    missing = code == layout.last[column]
    return np.where(layout.is_category[column], code != split, np.where(missing, missing_left, code <= split))


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0) if alpha else g


def leaf_value(g: np.ndarray, h: np.ndarray, growth: Growth) -> np.ndarray:
    if growth.mean:
        return g / np.maximum(h, 1e-300)
    return -growth.shrink * _shrunk(g, growth.reg_alpha) / np.maximum(h + growth.reg_lambda, 1e-300)


def _score(g: np.ndarray, h: np.ndarray, growth: Growth) -> np.ndarray:
    g = _shrunk(g, growth.reg_alpha)
    return g * g / np.maximum(h + growth.reg_lambda, 1e-300)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values; the source of every draw, so that a repeated task draws the same."""
    x = (np.asarray(x, np.uint64) ^ (np.asarray(x, np.uint64) >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(*parts: int) -> int:
    """One 62-bit seed from several numbers."""
    out = 0
    for part in parts:
        out = int(mixed(np.array([(out + part * 0x9E3779B97F4A7C15 + 1) % (1 << 64)], np.uint64))[0])
    return out >> 2


def drawn_features(features: int, share: float, seed: int) -> np.ndarray:
    """Flags of the features a tree may use: a fixed number of them, at least one."""
    take = max(1, int(features * share))
    out = np.zeros(features + 1, bool)  # the entry -1 is no feature
    if features:
        out[np.argsort(mixed(np.arange(features, dtype=np.uint64) + np.uint64(seed)), kind="stable")[:take]] = True
    return out


def cell_sums(node: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, layout: Layout, nodes: int):
    """(node, cell, g, h, rows) of all cells in use, by node and cell; ``node`` runs from 0, ``n`` counts the rows of an
    entry."""
    key = (node[:, None] * layout.cells + layout.offsets[:-1] + codes).ravel()
    if nodes * layout.cells <= 4 * len(key) + (1 << 16):
        used, at, size = None, key, nodes * layout.cells
    else:
        used, at = np.unique(key, return_inverse=True)
        size = len(used)
    g, h, rows = (np.bincount(at, weights=np.repeat(x, layout.columns), minlength=size) for x in (g, h, n))
    if used is None:
        used = np.flatnonzero(rows)
        g, h, rows = g[used], h[used], rows[used]
    return used // layout.cells, used % layout.cells, g, h, rows


def best_splits(node, cell, g, h, rows, layout: Layout, growth: Growth, allowed: np.ndarray | None = None,
                seed: int = 0) -> Splits:
    """The split of largest gain of each node, ties to the first cell. Cells come ordered by node and cell.
    Gains are compared at ``DIGITS`` places, so that equal splits tie in whatever order their rows were added up.

    ``allowed`` flags the features of the tree. With ``growth.per_node`` a share of the features is drawn for every
    node; a node that none of them can split may use all."""
    column, code, feature = layout.column[cell], layout.code[cell], layout.feature[cell]
    ids, first, index = np.unique(node, return_index=True, return_inverse=True)
    once = column == 0
    total_g, total_h, total_n = (np.bincount(index[once], weights=x[once], minlength=len(ids)) for x in (g, h, rows))
    new = np.ones(len(cell), bool)
    new[1:] = (node[1:] != node[:-1]) | (column[1:] != column[:-1])
    part, category = np.cumsum(new) - 1, layout.is_category[column]
    missing = ~category & (code == layout.last[column])

    def running(x):
        kept = np.where(missing, 0.0, x)
        total = np.cumsum(kept)
        return total - (total - kept)[new][part]

    def lost(x):
        return np.bincount(part, weights=np.where(missing, x, 0.0), minlength=part[-1] + 1 if len(part) else 0)[part]

    sums = []
    for x, total in ((g, total_g), (h, total_h), (rows.astype(float), total_n)):
        below = np.where(category, total[index] - x, running(x))
        sums.append((below, below + np.where(category, 0.0, lost(x)), total[index]))
    (ga, gb, gt), (ha, hb, ht), (na, nb, nt) = sums
    root = _score(gt, ht, growth)

    def gains(gl, hl, nl):
        out = _score(gl, hl, growth) + _score(gt - gl, ht - hl, growth) - root - growth.gamma
        fits = (nl > 0) & (nl < nt) & (hl >= growth.min_child_weight) & (ht - hl >= growth.min_child_weight)
        return np.where(fits & (feature >= 0) & ~missing, out, -np.inf)

    right, left = gains(ga, ha, na), gains(gb, hb, nb)
    right, left = right.round(DIGITS), left.round(DIGITS)
    gain = np.maximum(right, left)
    if allowed is not None:
        gain = np.where(allowed[feature], gain, -np.inf)
    if growth.per_node and len(cell):
        draw = mixed(mixed(ids.astype(np.uint64) + np.uint64(seed))[index] + feature.astype(np.uint64))
        some = np.where(draw < np.uint64(int(growth.columns * (1 << 63)) * 2 - 1), gain, -np.inf)
        gain = np.where((np.maximum.reduceat(some, first) > 0)[index], some, gain)
    best = np.maximum.reduceat(gain, first) if len(cell) else np.zeros(0)
    hits = np.flatnonzero(gain == best[index])
    pick = hits[np.unique(index[hits], return_index=True)[1]]
    to_left = left[pick] > right[pick]
    split = best > (1e-9 * root[pick] if growth.mean else LEAST_GAIN)
    chosen = lambda a, b: np.where(to_left, b[pick], a[pick])
    return Splits(ids, np.where(split, column[pick], -1), code[pick], to_left, np.where(split, best, 0.0),
                  total_g, total_h, chosen(ga, gb), chosen(ha, hb), total_n, chosen(na, nb))


def _level(here: np.ndarray, rows: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, layout: Layout,
           growth: Growth, allowed: np.ndarray | None, seed: int, nodes: int) -> Splits:
    """Best splits of the nodes ``here`` that ``rows`` lie in, so many nodes at a time as have ``CELLS_AT_ONCE`` cells."""
    order, ends = np.argsort(here, kind="stable"), np.cumsum(np.bincount(here, minlength=nodes))
    parts, first, start = [], 0, 0
    while first < nodes:
        last = max(first + 1, int(np.searchsorted(ends, start + CELLS_AT_ONCE // layout.columns, side="right")))
        some = order[start:ends[last - 1]]
        own = rows[some]
        node, *sums = cell_sums(here[some] - first, codes[own], g[own], h[own], n[own], layout, last - first)
        parts.append(best_splits(node + first, *sums, layout, growth, allowed, seed))
        first, start = last, int(ends[last - 1])
    return Splits(*(np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Splits)))


def grow_here(codes: np.ndarray, g: np.ndarray, h: np.ndarray, n: np.ndarray, layout: Layout, growth: Growth, seed: int,
              allowed: np.ndarray | None = None, depth: int = 0) -> Tree:
    """A whole (sub)tree from sums of like rows at hand, ``n`` rows each; ``depth`` is that of its root."""
    tree, node, rows = Tree.root(), np.zeros(len(codes), np.int64), np.arange(len(codes))
    frontier, start = np.zeros(1, np.int64), depth
    while len(frontier) and (depth == start or not growth.max_depth or depth < growth.max_depth):  # deeper ones have their values
        place = np.zeros(len(tree.column), np.int64)
        place[frontier] = np.arange(len(frontier))
        splits = _level(place[node[rows]], rows, codes, g, h, n, layout, growth, allowed, seeded(seed, depth), len(frontier))
        if growth.max_depth and depth >= growth.max_depth:
            splits.column[:] = -1
        tree.grow(splits, frontier, growth)
        at = node[rows]
        keep = tree.column[at] >= 0
        rows, at = rows[keep], at[keep]
        left = goes_left(codes[rows, tree.column[at]], tree.column[at], tree.code[at], tree.missing_left[at], layout)
        node[rows] = np.where(left, tree.left[at], tree.right[at])
        frontier, depth = np.flatnonzero(np.bincount(node[rows], minlength=1)), depth + 1
    return tree
