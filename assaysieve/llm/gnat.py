"""A tree of split points over whole-number vectors, searched for the largest inner products within windows.

Each node has up to `ARITY` split points, rows of its own, and deals its rows to the nearest one. For every split point and every child it keeps the range of distances from the
point to the child's rows. An inner product window becomes an annulus of distances around the query, because the children's lengths lie in known ranges; a child is
passed over if, for any split point, the distances its rows could have do not meet the range that is stored. Leaves are compared exactly.
"""

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from assaysieve.llm.vectors import spread_out

ARITY = 16
LEAF = 512
SPLIT_SAMPLE = 1024  # rows of a node from which its split points are chosen; ranges are over all rows
QUERIES = 256  # queries taken through the tree together
DEPTH = 30
ROUNDING = 1e-12  # of squared lengths; far more than their products lose
EXACT = float(1 << 53)


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, all below 2^63: in double precision where that holds every sum, in 64-bit numbers otherwise."""
    if not queries.size or not rows.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    bound = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    if bound < EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries.astype(np.int64) @ rows.astype(np.int64).T  # right wherever the products themselves fit


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


@dataclass
class Ranges:
    """What a node knows of its children: distances to the split points, low[point, child] to high[point, child], and their squared lengths."""

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    shortest: np.ndarray
    longest: np.ndarray

    def open(self, queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Per query and child, whether the child can hold a row with an inner product from `least` to `most`."""
        lengths = (queries * queries).sum(1)[:, None]
        apart = distances(queries, self.points)
        inner = np.sqrt(np.maximum(lengths + self.shortest - 2 * most[:, None], 0))  # an empty child has no rows at any distance
        outer = np.sqrt(np.maximum(lengths + self.longest - 2 * least[:, None], 0))
        slack = np.sqrt(ROUNDING * (1 + lengths + np.maximum(self.longest, 0)))
        nearest = np.maximum(apart[:, :, None] - outer[:, None, :], inner[:, None, :] - apart[:, :, None]) - slack[:, None, :]
        farthest = apart[:, :, None] + outer[:, None, :] + slack[:, None, :]
        reached = ((nearest <= self.high) & (farthest >= self.low)).all(1)
        fits = lengths + self.longest - 2 * least[:, None] >= -slack * slack
        return reached & fits


def ranges_of(points: np.ndarray, rows: np.ndarray, child: np.ndarray, children: int, apart: np.ndarray) -> Ranges:
    low, high = np.full((len(points), children), np.inf), np.full((len(points), children), -np.inf)
    shortest, longest = np.full(children, np.inf), np.full(children, -np.inf)
    squares = (rows * rows).sum(1)
    for c in np.unique(child).tolist():
        which = child == c
        low[:, c], high[:, c] = apart[which].min(0), apart[which].max(0)
        shortest[c], longest[c] = squares[which].min(), squares[which].max()
    return Ranges(points, low, high, shortest, longest)


@dataclass
class Node:
    rows: np.ndarray | None  # places of a leaf
    ranges: Ranges | None = None
    children: list["Node"] | None = None


def grow(vectors: np.ndarray, places: np.ndarray, arity: int = ARITY, leaf: int = LEAF, depth: int = 0) -> Node:
    """The tree of these rows. Rows on one spot, and what is left at the greatest depth, are cut into leaves of the same size."""
    if places.size <= leaf:
        return Node(places)
    rows = vectors[places].astype(np.float64)
    sample = np.unique(np.linspace(0, places.size - 1, SPLIT_SAMPLE).astype(np.int64))
    points = rows[sample[spread_out(rows[sample], arity, 0.5)]]
    cut = len(points) < 2 or depth >= DEPTH
    points = points[:1] if cut else points
    apart = distances(rows, points)
    child = np.arange(places.size) // leaf if cut else apart.argmin(1)
    parts = [places[child == c] for c in range(child.max() + 1 if cut else len(points))]
    ranges = ranges_of(points, rows, child, len(parts), apart)
    del rows, apart
    return Node(None, ranges, [Node(p) if cut else grow(vectors, p, arity, leaf, depth + 1) for p in parts])


class Best:
    """Per window the best candidates so far: larger scores first, then smaller ids, then the earlier row."""

    def __init__(self, least: np.ndarray, most: np.ndarray, wanted: int) -> None:
        self.least, self.most, self.wanted = least.copy(), most, wanted
        self.window, self.score, self.row = np.zeros(0, np.int64), np.zeros(0, least.dtype), np.zeros(0, np.int64)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, window: np.ndarray, score: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        self.held.append((window, score, row))
        self.waiting += window.size
        if self.waiting > 8 * self.wanted * self.least.size + (1 << 16):
            self.settle(ids)

    def settle(self, ids: np.ndarray) -> None:
        """Keep the best of each window; from then on, less than its last one is out."""
        parts = [(self.window, self.score, self.row), *self.held]
        window, score, row = (np.concatenate([p[n] for p in parts]) for n in range(3))
        order = np.lexsort((row, ids[row], -score, window))
        window, score, row = window[order], score[order], row[order]
        begin = np.searchsorted(window, window)
        place = np.arange(window.size) - begin
        keep = place < self.wanted
        self.window, self.score, self.row, self.held, self.waiting = window[keep], score[keep], row[keep], [], 0
        last = place == self.wanted - 1
        self.least[window[last]] = np.maximum(self.least[window[last]], score[last])


def search(tree: Node, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, of: np.ndarray, least: np.ndarray, most: np.ndarray, wanted: int,
           allowed: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window, score and row place of the `wanted` best rows of each window; a window belongs to query `of` and reaches from `least` to `most`.

    `vectors` are whole numbers and so are the queries; `allowed` tells for query places and row places which pairs may be returned. `of` is sorted.
    """
    best = Best(least, most, wanted)
    as_doubles = queries.astype(np.float64)
    for at in range(0, len(queries), QUERIES):
        windows = slice(*np.searchsorted(of, [at, at + QUERIES]))
        if windows.start == windows.stop:
            continue
        stack = [(tree, np.unique(of[windows]))]
        while stack:
            node, asked = stack.pop()
            # The widest window of each query that still matters: thresholds rise while candidates are found.
            own = np.flatnonzero(np.isin(of[windows], asked)) + windows.start
            own = own[best.least[own] <= most[own]]
            if not own.size:
                continue
            asked, begins = np.unique(of[own], return_index=True)
            low = np.minimum.reduceat(best.least[own], begins)
            high = np.maximum.reduceat(most[own], begins)
            if node.rows is not None:
                _compare(node.rows, vectors, ids, queries, asked, of, own, best, allowed)
                continue
            open_ = node.ranges.open(as_doubles[asked], low.astype(np.float64), high.astype(np.float64))
            nearest = np.resize(distances(as_doubles[asked], node.ranges.points).min(0), len(node.children))
            for c in np.argsort(-nearest, kind="stable").tolist():  # the nearest child is taken from the stack first
                if open_[:, c].any():
                    stack.append((node.children[c], asked[open_[:, c]]))
        best.settle(ids)
    return best.window, best.score, best.row


def _compare(rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, asked: np.ndarray, of: np.ndarray, own: np.ndarray, best: Best,
             allowed: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
    table = scores(queries[asked], vectors[rows])
    fine = allowed(asked, rows)
    place = np.searchsorted(asked, of[own])
    found = fine[place] & (table[place] >= best.least[own][:, None]) & (table[place] <= best.most[own][:, None])
    window, row = np.nonzero(found)
    if window.size:
        best.add(own[window], table[place[window], row], rows[row], ids)
        # A leaf can hold more than is wanted; settle early so that the thresholds rise.
        if best.waiting > 4 * best.wanted * own.size:
            best.settle(ids)
