"""How regression trees grow from sums of gradients and curvatures per node, feature and bin.

The rules stand apart from where the sums come from: `Rows` adds up rows that one task holds, and `histogram_trees` adds up a table of any size
by one job per step. A bin is a byte: values up to 254 in the order of the numbers, 255 for a missing value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np

BINS = 256
MISSING = 255
CUTS = 254  # cut points of a feature at most; with more distinct values they are quantiles
TINY = 1e-12
TIE = 1e-10  # gains that differ by less, against the scores they come from, are equal: the order in which rows are added must not decide


@dataclass(frozen=True)
class Style:
    """How the trees of a model grow."""

    trees: int
    rate: float
    leaf_penalty: float = 0.0  # added to a leaf's weight
    least_weight: float = 0.0  # weight that each side of a split needs
    least_gain: float = 0.0
    depth: int | None = None  # None: until nothing can be split
    leaves: int | None = None  # best-first with so many leaves
    symmetric: bool = False  # one split for all nodes of a level
    bagged: bool = False  # trees that do not follow on each other, with their mean as the model
    resampled: bool = True  # whether each of these is grown on its own resampled rows
    one_sided: tuple[float, float] | None = None  # share of rows with the largest gradients that stay, and share of the others, reweighted


@dataclass
class Tree:
    """Nodes in arrays; a leaf has no children (-1). Rows whose bin is at most `cut` go left; `at` is the same border as a number."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [-1])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    weight: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node] = int(feature), int(cut), bool(missing_left)
        self.left[node], self.right[node] = left, left + 1
        for column, empty in ((self.feature, -1), (self.cut, -1), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.weight, 0.0)):
            column.extend([empty, empty])
        return left, left + 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf that each row of bins reaches."""
        feature, cut, missing, left, right = (np.array(x) for x in (self.feature, self.cut, self.missing_left, self.left, self.right))
        node = np.zeros(len(bins), np.int64)
        moving = np.flatnonzero(feature[node] >= 0)
        while moving.size:
            at = node[moving]
            own = bins[moving, feature[at]]
            goes_left = np.where(own == MISSING, missing[at], own <= cut[at])
            node[moving] = np.where(goes_left, left[at], right[at])
            moving = moving[feature[node[moving]] >= 0]
        return node


def cut_points(values: np.ndarray) -> np.ndarray:
    """Borders between neighbouring values; between quantiles if there are too many values."""
    kinds = np.unique(values[~np.isnan(values)])
    if kinds.size > CUTS + 1:
        known = np.sort(values[~np.isnan(values)])
        kinds = np.unique(known[np.linspace(0, known.size - 1, CUTS + 1).astype(np.int64)])
    return kinds[:-1] / 2 + kinds[1:] / 2


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, borders in enumerate(cuts):
        out[:, j] = np.where(np.isnan(x[:, j]), MISSING, np.searchsorted(borders, x[:, j], "left"))
    return out


@dataclass
class Splits:
    """The best split of each node: nothing gained means none."""

    gain: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray


def _score(gradient: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    total = weight + penalty
    return np.divide(gradient * gradient, total, out=np.zeros_like(gradient), where=total > TINY)


def _gains(sums: np.ndarray, style: Style) -> tuple[np.ndarray, np.ndarray]:
    """Gain of every cut: nodes x features x {missing right, missing left} x cuts, -inf where a side is too light; and each node's own score.

    `sums` has nodes x features x bins x {gradient, weight}.
    """
    known = np.cumsum(sums[:, :, :CUTS, :], axis=2)
    total = sums.sum(2)[:, :, None, :]
    lost = sums[:, :, MISSING, None, :]
    whole = _score(total[..., 0], total[..., 1], style.leaf_penalty)
    out = np.full((*sums.shape[:2], 2, CUTS), -np.inf)
    for side, left in ((0, known), (1, known + lost)):
        if side and not lost.any():
            continue  # nothing is missing: the first of two equal cuts counts
        right = total - left
        heavy = max(style.least_weight, TINY)
        fits = (left[..., 1] >= heavy) & (right[..., 1] >= heavy)
        gain = _score(left[..., 0], left[..., 1], style.leaf_penalty) + _score(right[..., 0], right[..., 1], style.leaf_penalty) - whole
        out[:, :, side] = np.where(fits, gain, -np.inf)
    return out, whole[:, 0, 0]


def _tie(gain: np.ndarray) -> np.ndarray:
    return TIE * np.abs(np.where(np.isfinite(gain), gain, 0.0))


def _first_of_best(gains: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Per row the first place whose gain is the largest or as good as it."""
    most = gains.max(1)
    return (gains >= (most - TIE * (np.abs(most) + score))[:, None]).argmax(1)


def best_splits(sums: np.ndarray, style: Style) -> Splits:
    """Per node the split of the largest gain; of equal ones that of the first feature and lowest cut."""
    nodes, features = sums.shape[:2]
    if not nodes or not features:
        return Splits(np.zeros(nodes), *(np.full(nodes, -1) for _ in range(2)), np.zeros(nodes, bool))
    gains, score = _gains(sums, style)
    gains = gains.transpose(0, 1, 3, 2).reshape(nodes, -1)  # feature, cut, side
    at = _first_of_best(gains, score)
    gain = gains[np.arange(nodes), at]
    floor = style.least_gain + TINY * np.abs(sums[:, 0, :, 0]).sum(1)
    return Splits(np.where(gain > floor, gain, 0.0), at // (2 * CUTS), at // 2 % CUTS, (at % 2).astype(bool))


def shared_split(sums: np.ndarray, style: Style) -> Splits:
    """One split for all nodes: that of the largest gain over all of them. A side may be empty in some nodes."""
    if not sums.shape[1]:
        return Splits(np.zeros(1), np.full(1, -1), np.full(1, -1), np.zeros(1, bool))
    gains, score = _gains(sums, style)
    total = np.where(np.isfinite(gains), gains, 0.0).sum(0).transpose(0, 2, 1).ravel()
    at = int(_first_of_best(total[None], score.sum()[None])[0])
    floor = style.least_gain + TINY * np.abs(sums[:, 0, :, 0]).sum()
    return Splits(np.array([total[at] if total[at] > floor else 0.0]), np.array([at // (2 * CUTS)]), np.array([at // 2 % CUTS]), np.array([bool(at % 2)]))


class Summing(Protocol):
    """Where sums come from, and who is told of splits.

    Where each question costs a job, `ahead` answers for one child (0 or 1) of several splits that are not made yet; elsewhere it is None.
    """

    ahead: Callable[[list[tuple[int, int, int, bool, int]]], np.ndarray] | None

    def sums(self, nodes: list[int]) -> np.ndarray: ...

    def split(self, node: int, feature: int, cut: int, missing_left: bool, left: int, right: int) -> None: ...


def _leaf(tree: Tree, node: int, total: np.ndarray, style: Style) -> None:
    gradient, weight = float(total[0]), float(total[1])
    tree.weight[node] = weight
    tree.value[node] = -style.rate * gradient / (weight + style.leaf_penalty) if weight + style.leaf_penalty > TINY else 0.0


def grow(rows: Summing, style: Style) -> Tree:
    """One tree of a boosted model."""
    return _best_first(rows, style) if style.leaves else _by_level(rows, style)


def _by_level(rows: Summing, style: Style) -> Tree:
    tree, level = Tree(), [0]
    sums = rows.sums(level)
    _leaf(tree, 0, sums[0, 0].sum(0), style)
    for depth in range(style.depth):
        found = shared_split(sums, style) if style.symmetric else best_splits(sums, style)
        children = []
        for i, node in enumerate(level):
            k = 0 if style.symmetric else i
            if found.gain[k] <= 0:
                continue
            pair = tree.split(node, found.feature[k], found.cut[k], found.missing_left[k])
            rows.split(node, int(found.feature[k]), int(found.cut[k]), bool(found.missing_left[k]), *pair)
            children += pair
        if not children:
            break
        # Only one child of each pair is summed; the other is the parent less its sibling. The last level needs totals alone, which the parents have.
        parents = {tree.left[node]: sums[i] for i, node in enumerate(level) if tree.left[node] >= 0}
        last = depth + 1 == style.depth
        own = None if last else rows.sums(children[::2])
        sums = np.empty((len(children), *sums.shape[1:]))
        for i in range(0, len(children), 2):
            parent = parents[children[i]]
            if last:
                node = tree.left.index(children[i])
                sums[i], sums[i + 1] = _sides(parent, tree.feature[node], tree.cut[node], tree.missing_left[node])
            else:
                sums[i], sums[i + 1] = own[i // 2], parent - own[i // 2]
        for i, node in enumerate(children):
            _leaf(tree, node, sums[i, 0].sum(0), style)
        level = children
    return tree


def _sides(sums: np.ndarray, feature: int, cut: int, missing_left: bool) -> tuple[np.ndarray, np.ndarray]:
    """Totals of both sides of a split, in the first feature's first bin."""
    column = sums[feature]
    left = column[:cut + 1].sum(0) + (column[MISSING] if missing_left else 0.0)
    out = np.zeros((2, *sums.shape))
    out[0, 0, 0], out[1, 0, 0] = left, column.sum(0) - left
    return out[0], out[1]


def _best_first(rows: Summing, style: Style) -> Tree:
    """The leaf of the largest gain is split next. Of its children only the lighter one is summed; the other is the parent less its sibling.

    A leaf's split does not depend on when it is made. Where questions are answered ahead, the lighter children of all leaves that may be split yet are
    asked for together; those that are not split in the end were asked for in vain.
    """
    tree = Tree()
    sums = {0: rows.sums([0])[0]}
    _leaf(tree, 0, sums[0][0].sum(0), style)
    queue = {0: best_splits(sums[0][None], style)}
    depth, known = {0: 0}, {}
    for made in range(style.leaves - 1):
        order = sorted(queue, key=lambda k: (-float(f"{queue[k].gain[0]:.9g}"), k))
        node = order[0] if order else None
        if node is None or queue[node].gain[0] <= 0:
            break
        deepest = style.depth is not None and depth[node] + 1 >= style.depth
        if rows.ahead is not None and not deepest and node not in known:
            open_ = [k for k in order if queue[k].gain[0] > 0 and k not in known and (style.depth is None or depth[k] + 1 < style.depth)][:style.leaves - 1 - made]
            known |= zip(open_, rows.ahead([(k, *_split_of(queue[k]), _lighter(sums[k], queue[k])) for k in open_]), strict=True)
        s, parent = queue.pop(node), sums.pop(node)
        pair = tree.split(node, *_split_of(s))
        rows.split(node, *_split_of(s), *pair)
        for child, side in zip(pair, _sides(parent, *_split_of(s)), strict=True):
            _leaf(tree, child, side[0, 0], style)
            depth[child] = depth[node] + 1
        if deepest:
            continue
        light = _lighter(parent, s)
        own = rows.sums([pair[light]])[0] if rows.ahead is None else known.pop(node)
        sums[pair[light]], sums[pair[1 - light]] = own, parent - own
        for child in pair:
            queue[child] = best_splits(sums[child][None], style)
    return tree


def _split_of(found: Splits) -> tuple[int, int, bool]:
    return int(found.feature[0]), int(found.cut[0]), bool(found.missing_left[0])


def _lighter(parent: np.ndarray, found: Splits) -> int:
    sides = _sides(parent, *_split_of(found))
    return int(sides[1][0, 0, 1] < sides[0][0, 0, 1])


class Rows:
    """Rows held by one task, with a gradient and a weight each; rows without weight are led to their leaves only."""

    ahead = None

    def __init__(self, bins: np.ndarray) -> None:
        self.bins = bins
        self.codes = [np.ascontiguousarray(bins[:, j]).astype(np.int64) for j in range(bins.shape[1])]
        self.members: dict[int, np.ndarray] = {}
        self.gradient = self.weight = np.zeros(len(bins))

    def begin(self, gradient: np.ndarray, weight: np.ndarray) -> None:
        self.gradient, self.weight = gradient, weight
        self.members = {0: np.arange(len(self.bins))}

    def sums(self, nodes: list[int]) -> np.ndarray:
        out = np.zeros((len(nodes), len(self.codes), BINS, 2))
        places = np.concatenate([self.members[n] for n in nodes]) if nodes else np.zeros(0, np.int64)
        shift = np.repeat(np.arange(len(nodes)) * BINS, [self.members[n].size for n in nodes])
        gradient, weight = self.gradient[places], self.weight[places]
        for j, codes in enumerate(self.codes):
            code = codes[places] + shift
            out[:, j, :, 0] = np.bincount(code, gradient, len(nodes) * BINS).reshape(-1, BINS)
            out[:, j, :, 1] = np.bincount(code, weight, len(nodes) * BINS).reshape(-1, BINS)
        return out

    def split(self, node: int, feature: int, cut: int, missing_left: bool, left: int, right: int) -> None:
        places = self.members.pop(node)
        own = self.bins[places, feature]
        goes_left = np.where(own == MISSING, missing_left, own <= cut)
        self.members[left], self.members[right] = places[goes_left], places[~goes_left]

    def values(self, tree: Tree) -> np.ndarray:
        out = np.zeros(len(self.bins))
        for node, places in self.members.items():
            out[places] = tree.value[node]
        return out


def one_sided_weights(gradient: np.ndarray, weight: np.ndarray, shares: tuple[float, float], draw: np.ndarray) -> np.ndarray:
    """Weights under sampling by gradient: the largest gradients stay, of the others a share is drawn and weighs accordingly more.

    `draw` is a uniform number of each row. Equal gradients at the border all stay.
    """
    top, other = shares
    size = np.abs(gradient)
    members = np.flatnonzero(weight > 0)
    if not members.size or top + other >= 1:
        return weight
    rank = max(1, int(np.ceil(top * members.size)))
    border = np.partition(size[members], members.size - rank)[members.size - rank]
    return np.where(size >= border, weight, np.where(draw < other / (1 - top), weight * (1 - top) / other, 0.0))


def boost(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, style: Style, row_hash: np.ndarray) -> tuple[float, list[Tree], np.ndarray]:
    """Start value, trees and the predictions of all rows; rows of weight 0 take no part in the fit."""
    base = float((weight * y).sum() / weight.sum()) if weight.sum() > 0 else 0.0
    margin, rows, trees = np.full(len(y), base), Rows(bins), []
    for number in range(style.trees):
        slope = margin - y
        own = weight if style.one_sided is None else one_sided_weights(slope * (weight > 0), weight, style.one_sided, uniform(row_hash, number))
        rows.begin(slope * own, own)
        tree = grow(rows, style)
        trees.append(tree)
        margin = margin + rows.values(tree)
    return base, trees, margin


def _mixed(row_hash: np.ndarray, number: int) -> np.ndarray:
    """53 bits of each row and tree, from hashes alone: the same wherever they are computed."""
    with np.errstate(over="ignore"):
        z = row_hash.astype(np.uint64) + np.uint64((number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z ^= z >> np.uint64(shift)
            z *= np.uint64(factor)
    z ^= z >> np.uint64(31)
    z >>= np.uint64(11)
    return z


def uniform(row_hash: np.ndarray, number: int) -> np.ndarray:
    """A number in [0, 1) of each row and tree."""
    return _mixed(row_hash, number) * 2.0 ** -53


_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))
_FIRST = 12  # bits
_begins = np.arange(2 ** _FIRST) / 2 ** _FIRST
_low, _high = (np.searchsorted(_POISSON, b, "right") for b in (_begins, _begins + 2.0 ** -_FIRST))
_DRAWN = np.where(_low == _high, _low, np.nan)


def resampled(row_hash: np.ndarray, number: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson numbers of mean 1, the limit of drawing rows with replacement."""
    bits = _mixed(row_hash, number)
    # The first bits tell the number, but where a step lies among the numbers that begin with them.
    drawn = _DRAWN[bits >> np.uint64(53 - _FIRST)]
    open_ = np.flatnonzero(np.isnan(drawn))
    drawn[open_] = np.searchsorted(_POISSON, bits[open_] * 2.0 ** -53, "right")
    return drawn


def grow_full(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int | None = None) -> Tree:
    """A least-squares tree to the last split, all nodes of a level in the same array operations.

    Nodes can be many and small, so the bins of a level are sorted instead of laid out whole once that is cheaper.
    """
    used = np.flatnonzero(weight > 0)
    bins, w = bins[used], weight[used]
    total = w.sum()
    centre = float((w * y[used]).sum() / total) if total > 0 else 0.0
    own = y[used] - centre
    feature, cut, left, right, values, weights, missing = [], [], [], [], [], [], []
    slope = w * own
    square = slope * own
    columns = [np.ascontiguousarray(bins[:, j]) for j in range(bins.shape[1])]
    node, active, level = np.zeros(used.size, np.int64), 1, 0
    while active:
        n = np.bincount(node, minlength=active)
        sum_w, sum_s, squares = (np.bincount(node, v, active) for v in (w, slope, square))
        mean = np.divide(sum_s, sum_w, out=np.zeros(active), where=sum_w > 0)
        spread = squares - sum_s * mean
        open_ = (n > 1) & (spread > TINY * np.maximum(squares, TINY)) & (depth is None or level < depth)
        best = np.full(active, -np.inf)
        best_feature, best_cut, best_missing = (np.full(active, -1) for _ in range(3))
        if not open_.all():
            keep = np.flatnonzero(open_[node])
            node, w, slope, square, *columns = (v[keep] for v in (node, w, slope, square, *columns))
        if node.size:
            for j, column in enumerate(columns):
                gain, at, lost = _node_cuts(node, column, w, slope, active, sum_w, sum_s)
                better = gain > best + _tie(best)
                best[better], best_feature[better], best_cut[better], best_missing[better] = gain[better], j, at[better], lost[better]
        split = open_ & (best - sum_s * mean > TINY * np.maximum(squares, TINY))
        begin = len(feature)
        child = begin + active + 2 * (np.cumsum(split) - 1)
        feature += np.where(split, best_feature, -1).tolist()
        cut += np.where(split, best_cut, -1).tolist()
        missing += (split & (best_missing == 1)).tolist()
        left += np.where(split, child, -1).tolist()
        right += np.where(split, child + 1, -1).tolist()
        values += (mean + centre).tolist()
        weights += sum_w.tolist()
        if not np.array_equal(split, open_):
            keep = np.flatnonzero(split[node])
            node, w, slope, square, *columns = (v[keep] for v in (node, w, slope, square, *columns))
        by, mine = best_feature[node], np.zeros(node.size, np.uint8)
        for j, column in enumerate(columns):
            np.copyto(mine, column, where=by == j)
        goes_left = np.where(mine == MISSING, (best_missing == 1)[node], mine <= best_cut[node])
        node = (child - begin - active)[node] + ~goes_left
        active, level = 2 * int(split.sum()), level + 1
    return Tree(feature, cut, missing, left, right, values, weights)


def _node_cuts(node: np.ndarray, bins: np.ndarray, w: np.ndarray, slope: np.ndarray, active: int, sum_w: np.ndarray, sum_s: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per node the best cut of one feature: sum of squared side sums over their weights, the cut, and whether missing values go left."""
    code = node * BINS + bins
    if active * BINS <= 4 * node.size:
        filled = np.arange(active * BINS)
        cell_w, cell_s = np.bincount(code, w, filled.size), np.bincount(code, slope, filled.size)
        held = np.flatnonzero(cell_w > 0)
        filled, cell_w, cell_s = filled[held], cell_w[held], cell_s[held]
    else:
        # Codes and places as one number each: sorting these is far faster than sorting places by their codes, and leaves equal codes in order.
        bits = code.size.bit_length()
        packed = np.sort(code << bits | np.arange(code.size))
        sorted_, order = packed >> bits, packed & ((1 << bits) - 1)
        begins = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
        filled, cell_w, cell_s = sorted_[begins], np.add.reduceat(w[order], begins), np.add.reduceat(slope[order], begins)
    of, bin_ = filled // BINS, filled % BINS
    lost_w, lost_s = np.zeros(active), np.zeros(active)
    lost = bin_ == MISSING
    lost_w[of[lost]], lost_s[of[lost]] = cell_w[lost], cell_s[lost]
    begins = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    ahead_w, ahead_s = np.cumsum(cell_w), np.cumsum(cell_s)
    length = np.diff(np.append(begins, of.size))
    left_w = ahead_w - np.repeat(ahead_w[begins] - cell_w[begins], length)
    left_s = ahead_s - np.repeat(ahead_s[begins] - cell_s[begins], length)
    best, cut, to_left = np.full(active, -np.inf), np.full(active, -1), np.zeros(active, np.int64)
    for side in (0, 1) if lost.any() else (0,):
        a_w, a_s = (left_w, left_s) if not side else (left_w + lost_w[of], left_s + lost_s[of])
        b_w, b_s = sum_w[of] - a_w, sum_s[of] - a_s
        fits = (b_w > TINY) & (a_w > TINY) & ~lost
        gain = np.where(fits, np.divide(a_s * a_s, a_w, out=np.zeros_like(a_s), where=fits) + np.divide(b_s * b_s, b_w, out=np.zeros_like(b_s), where=fits), -np.inf)
        most = np.maximum.reduceat(gain, begins)
        first = np.flatnonzero(gain >= np.repeat(most - _tie(most), length))
        first = first[np.concatenate(([True], of[first][1:] != of[first][:-1]))]
        known = best[of[begins]]
        better = most > known + _tie(known)
        which = of[begins][better]
        best[which], cut[which], to_left[which] = most[better], bin_[first][better], side
    return best, cut, to_left


def forest(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, style: Style, row_hash: np.ndarray, numbers: Sequence[int]) -> tuple[list[Tree], np.ndarray]:
    """Some trees of a forest, and the sum of their predictions for all rows."""
    trees, total = [], np.zeros(len(y))
    for number in numbers:
        tree = grow_full(bins, y, weight * resampled(row_hash, number) if style.resampled else weight, style.depth)
        trees.append(tree)
        total += np.array(tree.value)[tree.leaf_of(bins)]
    return trees, total
