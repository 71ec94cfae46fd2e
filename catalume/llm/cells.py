"""Exact join of one cell of texts in Jaccard's metric space: Voronoi cells of pivots, replication at their boundaries, recursion.

A text belongs to the cell of its nearest pivot. Two texts at most `radius` apart have distances to any pivot that differ by radius at most, so a text
is replicated into the cell of each pivot that is no farther than 2 * radius beyond its nearest: there it meets whatever it may link with.
Cells are joined in the same way, until hardly anything is left in them or pivots no longer separate them; then all overlaps of the cell are counted at once.
"""

from __future__ import annotations

import math

import numpy as np

LEAF = 4  # texts that are compared without pivots
PIVOTS = 8  # of a cell at most; a small one has the root of its size
SMALL = 64  # texts whose overlaps are a matrix product throughout
DENSE = 8  # in larger cells, a shingle in more texts than this is counted by a matrix product
CELLS = 1 << 22  # numbers of a matrix that are worked on at once


def overlaps(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of all sets (sorted, distinct) with all others, or with themselves."""
    both = [*sets, *others] if others is not None else sets
    k, m = len(both), len(sets)
    values, row = np.concatenate(both), np.repeat(np.arange(k), [len(x) for x in both])
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    times = np.diff(np.append(first, len(values)))
    out = np.zeros((k, k), np.int64)
    # Few texts of a large cell have it: each pair of them counts one more.
    few = DENSE if k > SMALL else 1
    for t in range(2, few + 1):
        members = row[first[times == t][:, None] + np.arange(t)]
        a, b = np.triu_indices(t, 1)
        if len(members):
            out += np.bincount((members[:, a] * k + members[:, b]).ravel(), minlength=k * k).reshape(k, k)
    # Many have it: a product of the matrix of texts and shingles.
    heavy = np.flatnonzero(times > few)
    step = max(1, CELLS // k)
    for a in range(0, len(heavy), step):
        some = heavy[a : a + step]
        place = np.repeat(first[some] - np.append(0, np.cumsum(times[some])[:-1]), times[some]) + np.arange(times[some].sum())
        matrix = np.zeros((k, len(some)), np.float32)
        matrix[row[place], np.repeat(np.arange(len(some)), times[some])] = 1
        out += np.triu(np.rint(matrix @ matrix.T).astype(np.int64), 1)
    out += out.T
    out[np.arange(k), np.arange(k)] = [len(x) for x in both]
    return out[:m, m:] if others is not None else out


def linked(both: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs have 100 * intersection >= percent * union."""
    return 100 * both >= percent * (n[:, None] + m[None, :] - both)


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (text, root) that connect what a symmetric matrix of links connects."""
    left, out = np.ones(len(links), bool), []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root] = False
        edge = np.array([root])
        while len(edge):
            edge = np.flatnonzero(links[edge].any(0) & left)
            left[edge] = False
            out += [(int(x), root) for x in edge]
    return out


def join(sets: list[np.ndarray], percent: int, at: np.ndarray | None = None, counts: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of positions that connect all texts that links of this cell connect.

    counts: four numbers that this call adds to: pairs of the cell (at the first call), pairs whose distance to a pivot was measured, pairs that no cell of a pivot holds together any more, and pairs that were compared in the end.
    """
    counts = np.zeros(4, np.int64) if counts is None else counts
    if at is None:
        at = np.arange(len(sets))
        counts[0] += len(at) * (len(at) - 1) // 2
    n = np.array([len(sets[i]) for i in at])
    if len(at) > LEAF:
        k = min(PIVOTS, math.isqrt(len(at)))
        pivots = at[:: -(-len(at) // k)]
        both = overlaps([sets[i] for i in at], [sets[i] for i in pivots])
        m = np.array([len(sets[i]) for i in pivots])
        distance = 1 - both / (n[:, None] + m[None, :] - both)
        inside = distance <= distance.min(1)[:, None] + 2 * (100 - percent) / 100 + 1e-9
        counts[1] += both.size
        if (inside.sum(0).astype(float) ** 2).sum() <= len(at) ** 2 / 2:
            met = inside.astype(np.float32) @ inside.T.astype(np.float32) > 0
            counts[2] += (len(at) ** 2 - int(met.sum())) // 2
            return [pair for j in range(len(pivots)) if inside[:, j].sum() > 1 for pair in join(sets, percent, at[inside[:, j]], counts)]
    counts[3] += len(at) * (len(at) - 1) // 2
    return [(int(at[a]), int(at[b])) for a, b in forest(linked(overlaps([sets[i] for i in at]), n, n, percent))]


def join_between(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs (of left and right) that connect all texts that links between the two blocks connect."""
    n, m = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    k = len(left)
    links = np.zeros((k + len(right), k + len(right)), bool)
    links[:k, k:] = linked(overlaps(left, right), n, m, percent)
    return forest(links | links.T)
