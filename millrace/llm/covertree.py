"""Cover trees over unit vectors and their dual traversal, exact for a distance threshold.

A tree's rows stand in depth-first order: every node is a slice, its centre the slice's first
row, which is also the centre of its first child (nesting). The nodes of a level lie within
the level's radius of their centre (covering), centres under one parent more than it apart
(separation), and radii halve from level to level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

RADII = (0.5, 0.25)
TIGHT = 0.1
ROUNDING = 1e-9
# Centres are compared in single precision first, whose error in a cosine is below this for every component.
SINGLE = 2e-7
NET_BLOCK = 512
MATRIX_ROWS = 1024
FEW = 4096
PAIRS_AT_ONCE = 1 << 15
# Rows and columns of a block of cosines that stays in a core's cache.
BLOCK = (256, 2048)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between all rows of two sets of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def cosine_at(distance: np.ndarray) -> np.ndarray:
    """The cosine of unit vectors so far apart; below -1 where no two are."""
    return 1.0 - distance * distance / 2.0


def net(points: np.ndarray, radius: float) -> np.ndarray:
    """For each point the number of its centre: the first row, then every row farther than the radius from all centres."""
    centre = np.full(len(points), -1, np.int64)
    chosen: list[int] = []
    for start in range(0, len(points), NET_BLOCK):
        block = points[start:start + NET_BLOCK]
        mine = np.full(len(block), -1, np.int64)
        if chosen:
            cosine = block @ points[chosen].T
            nearest = cosine.argmax(axis=1)
            near = cosine[np.arange(len(block)), nearest] >= cosine_at(radius)
            mine[near] = np.array(chosen)[nearest[near]]
        open_rows = np.flatnonzero(mine < 0)
        if len(open_rows):
            close = block[open_rows] @ block[open_rows].T >= cosine_at(radius)
            for i, row in enumerate(open_rows.tolist()):
                if mine[row] < 0:
                    chosen.append(start + row)
                    reached = open_rows[close[i] & (mine[open_rows] < 0)]
                    mine[reached] = start + row
                    mine[row] = start + row
        centre[start:start + len(block)] = mine
    return centre


@dataclass
class Tree:
    """Unit vectors in depth-first order and, for every level, where its nodes start."""

    points: np.ndarray
    starts: list[np.ndarray]

    def ends(self, level: int) -> np.ndarray:
        return np.append(self.starts[level][1:], len(self.points))

    def radii(self, level: int) -> np.ndarray:
        """Covering radius of every node: the farthest of its rows from its centre."""
        starts = self.starts[level]
        centre = np.repeat(starts, np.diff(starts, append=len(self.points)))
        cosine = np.einsum("ij,ij->i", self.points, self.points[centre])
        return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.minimum.reduceat(cosine, starts)))


def build(points: np.ndarray, radii: tuple[float, ...] = RADII) -> tuple[Tree, np.ndarray]:
    """The tree of some points and their order in it."""
    order = np.arange(len(points))
    bounds = np.array([0, len(points)])
    starts = []
    for radius in radii:
        cuts = [0]
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if high - low == 1:
                cuts.append(high)
                continue
            members = order[low:high]
            centre = net(points[members], radius)
            # Centres come first of their node: sorting by (centre, not the centre) keeps nodes together.
            rank = np.lexsort((np.arange(len(members)), np.arange(len(members)) != centre, centre))
            order[low:high] = members[rank]
            cuts += (low + np.flatnonzero(np.diff(centre[rank])) + 1).tolist() + [high]
        bounds = np.array(cuts)
        starts.append(bounds[:-1])
    return Tree(points[order], starts), order


class Links:
    """Links found between two trees: how many each row has, and edges that keep linked rows together."""

    def __init__(self, size_a: int, size_b: int, least_cosine: float, same: bool):
        self.least, self.same = least_cosine, same
        self.count_a = np.zeros(size_a, np.int64)
        self.count_b = np.zeros(size_b, np.int64)
        self.edges: list[np.ndarray] = []

    def add(self, rows_a: np.ndarray, rows_b: np.ndarray) -> None:
        """Linked pairs."""
        if self.same:
            different = rows_a != rows_b
            rows_a, rows_b = rows_a[different], rows_b[different]
        np.add.at(self.count_a, rows_a, 1)
        np.add.at(self.count_b, rows_b, 1)
        self.edges.append(np.stack([rows_a, rows_b]))

    def add_block(self, a: Tree, b: Tree, low_a: int, high_a: int, low_b: int, high_b: int) -> None:
        """All pairs of two slices, by blocks; of a block's links only a spanning set is kept."""
        for i in range(low_a, high_a, MATRIX_ROWS):
            for j in range(low_b, high_b, MATRIX_ROWS):
                rows, columns = np.arange(i, min(i + MATRIX_ROWS, high_a)), np.arange(j, min(j + MATRIX_ROWS, high_b))
                linked = a.points[rows] @ b.points[columns].T >= self.least
                if self.same:
                    linked &= rows[:, None] != columns[None, :]
                self.count_a[rows] += linked.sum(axis=1)
                self.count_b[columns] += linked.sum(axis=0)
                self._span(linked, rows, columns)

    def _span(self, linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        """Ties every row and column with links to the first column of its connected part."""
        some_row, some_column = linked.any(axis=1), linked.any(axis=0)
        linked, rows, columns = linked[some_row][:, some_column], rows[some_row], columns[some_column]
        if not len(rows):
            return
        own = np.arange(len(columns))
        while True:
            row_label = np.where(linked, own[None, :], len(columns)).min(axis=1)
            label = np.where(linked, row_label[:, None], len(columns)).min(axis=0)
            label = np.minimum(label, own)
            label = label[label]
            if (label == own).all():
                break
            own = label
        self.edges.append(np.stack([rows, columns[row_label]]))
        # A column's root is reached through a row that both are linked with, or through other columns' rows.
        first_row = linked.argmax(axis=0)
        self.edges.append(np.stack([rows[first_row], columns]))


def dual_traversal(a: Tree, b: Tree, links: Links, reach: float) -> None:
    """Finds all links of two trees: node pairs too far apart for their covering radii are cut with all below."""
    pairs_a = pairs_b = np.zeros(1, np.int64)
    slices = [(np.zeros(1, np.int64), np.array([len(t.points)])) for t in (a, b)]
    for level in range(len(a.starts)):
        (low_a, high_a), (low_b, high_b) = slices
        below = [np.searchsorted(t.starts[level], s) for t, s in ((a, low_a), (a, high_a), (b, low_b), (b, high_b))]
        radius_a, radius_b = a.radii(level), b.radii(level)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        n_a, n_b = below[1] - below[0], below[3] - below[2]
        large = n_a[pairs_a] * n_b[pairs_b] > FEW
        for x, y in zip(pairs_a[large].tolist(), pairs_b[large].tolist()):
            members = np.arange(below[2][y], below[3][y])
            for children_b in (members[radius_b[members] <= TIGHT], members[radius_b[members] > TIGHT]):
                if not len(children_b):
                    continue
                children_a = np.arange(below[0][x], below[1][x])
                # First by the largest radius of these nodes, then by each one's own.
                most = cosine_at(radius_a[children_a] + radius_b[children_b].max() + reach)
                for i, j in maybe_near(a.points[a.starts[level][children_a]], b.points[b.starts[level][children_b]], most):
                    i, j = children_a[i], children_b[j]
                    cosine = np.einsum("ij,ij->i", a.points[a.starts[level][i]], b.points[b.starts[level][j]])
                    near = cosine >= cosine_at(radius_a[i] + radius_b[j] + reach) - ROUNDING
                    kept.append((i[near], j[near]))
        for i, j in expanded(pairs_a[~large], pairs_b[~large], below[0], n_a, below[2], n_b):
            cosine = np.einsum("ij,ij->i", a.points[a.starts[level][i]], b.points[b.starts[level][j]])
            apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))
            near = apart <= radius_a[i] + radius_b[j] + reach
            kept.append((i[near], j[near]))
        pairs_a = np.concatenate([i for i, _ in kept]) if kept else np.zeros(0, np.int64)
        pairs_b = np.concatenate([j for _, j in kept]) if kept else np.zeros(0, np.int64)
        slices = [(t.starts[level], t.ends(level)) for t in (a, b)]
    (low_a, high_a), (low_b, high_b) = slices
    n_a, n_b = high_a - low_a, high_b - low_b
    large = n_a[pairs_a] * n_b[pairs_b] > FEW
    for x, y in zip(pairs_a[large].tolist(), pairs_b[large].tolist()):
        links.add_block(a, b, low_a[x], high_a[x], low_b[y], high_b[y])
    for i, j in expanded(pairs_a[~large], pairs_b[~large], low_a, n_a, low_b, n_b):
        near = np.einsum("ij,ij->i", a.points[i], b.points[j]) >= links.least
        links.add(i[near], j[near])


def maybe_near(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows whose cosine is at least ``least`` of the first, and some below, a bounded number at a time."""
    rows, columns = BLOCK
    single, bound = a.astype(np.float32), (least - SINGLE * (a.shape[1] + 8)).astype(np.float32)
    for start in range(0, len(b), columns):
        across = np.ascontiguousarray(b[start:start + columns].T, np.float32)
        for first in range(0, len(a), rows):
            near = np.flatnonzero(single[first:first + rows] @ across >= bound[first:first + rows, None])
            for low in range(0, len(near), PAIRS_AT_ONCE):
                i, j = np.divmod(near[low:low + PAIRS_AT_ONCE], across.shape[1])
                yield first + i, start + j


def expanded(pairs_a: np.ndarray, pairs_b: np.ndarray, first_a: np.ndarray, n_a: np.ndarray,
             first_b: np.ndarray, n_b: np.ndarray):
    """All pairs of members of the paired nodes, a bounded number at a time."""
    sizes = n_a[pairs_a] * n_b[pairs_b]
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, "right")))
        part = slice(at, upto)
        size = sizes[part]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = np.repeat(n_b[pairs_b[part]], size)
        yield (np.repeat(first_a[pairs_a[part]], size) + inside // width,
               np.repeat(first_b[pairs_b[part]], size) + inside % width)
        at = upto


def roots(size: int, edges: np.ndarray) -> np.ndarray:
    """The smallest number each of ``size`` rows is connected with; edges are two rows of numbers."""
    label = np.arange(size)
    x, y = edges
    while len(x):
        least = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(least, x, low)
        np.minimum.at(least, y, low)
        np.minimum.at(least, label[x], low)
        np.minimum.at(least, label[y], low)
        least = least[least]
        if (least == label).all():
            break
        label = least
    return label
