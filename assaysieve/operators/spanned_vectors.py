"""Support-vector regression of many rows whose kernel a few of them span, solved without a number per pair of rows.

Rows are chosen as pivots until the kernel of every row with itself is that of its projection on them, up to a small rest. In the coordinates of these pivots the
primal has one unknown per pivot and a bias. Its loss is rounded off over a width that narrows in steps, each solved by Newton's method from sums over the rows. What comes out is a
function of the kernel's own space, so its primal is the true one; the rest enters the dual, and with it the duality gap, as a bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

from assaysieve.operators.kernels import squared_distances

PIVOTS = 1_000
SHARE = 8  # rows per pivot at least: with fewer, pairs of coefficients are the shorter way
HELD = 32_000_000  # coordinates that are kept; of more rows they are worked out anew in each pass
PASS_ROWS = 8_192
POOL = 2_000  # rows among which pivots are looked for together
REST = 1e-4  # of the kernel, over the number of rows
NARROWER = 0.2
CLOSE = 1e-3  # of the tolerance: how far the gap is brought down, if it goes
NEWTON = 50
LINE = 3.0 ** -np.arange(1, 25)


def kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    out = squared_distances(a, b)
    out *= -gamma
    return np.exp(out, out=out)


@dataclass
class Span:
    """Pivots, and what brings a row's kernel with them to coordinates."""

    points: np.ndarray
    turn: np.ndarray
    gamma: float

    @classmethod
    def of(cls, points: np.ndarray, gamma: float) -> Span:
        return cls(points, np.linalg.inv(np.linalg.cholesky(kernel(points, points, gamma))).T if len(points) else np.zeros((0, 0)), gamma)

    def coordinates(self, x: np.ndarray) -> np.ndarray:
        return kernel(x, self.points, self.gamma) @ self.turn

    def passes(self, x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
        for at in range(0, len(x), PASS_ROWS):
            own = slice(at, at + PASS_ROWS)
            yield own, self.coordinates(x[own])

    def rest(self, x: np.ndarray) -> np.ndarray:
        """What the pivots leave of the kernel of each row with itself."""
        return np.concatenate([np.maximum(1 - np.einsum("ij,ij->i", g, g), 0.0) for _, g in self.passes(x)])


def further_pivots(span: Span, x: np.ndarray, most: int, slack: float) -> np.ndarray:
    """Rows of `x`, the least spanned one after the other, until all of them are spanned."""
    begin = len(span.points)
    g = np.zeros((len(x), most))
    g[:, :begin] = span.coordinates(x)
    left, chosen = 1 - np.einsum("ij,ij->i", g, g), []
    for k in range(begin, most):
        i = int(left.argmax())
        if left[i] <= slack:
            break
        g[:, k] = (kernel(x, x[i:i + 1], span.gamma)[:, 0] - g[:, :k] @ g[i, :k]) / np.sqrt(left[i])
        left -= g[:, k] * g[:, k]
        left[i] = 0.0
        chosen.append(i)
    return x[chosen]


def spanning(x: np.ndarray, gamma: float, most: int, slack: float) -> tuple[Span, np.ndarray] | None:
    """At most so many rows that span all others up to `slack`, and what they leave of each; nothing if they are too few. Rows come in an order without meaning."""
    span, pool = Span.of(x[:0], gamma), np.arange(min(POOL, len(x)))
    while True:
        found = further_pivots(span, x[pool], most, slack)
        try:
            span = Span.of(np.concatenate([span.points, found]), gamma)
        except np.linalg.LinAlgError:
            return None
        rest = span.rest(x)
        lost = np.flatnonzero(rest > slack)
        if not lost.size:
            return span, rest
        if len(span.points) >= most or not len(found):
            return None
        pool = lost[np.argsort(-rest[lost], kind="stable")[:POOL]]


@dataclass
class Sums:
    """Sums over rows at one point: of the rounded loss, the loss, what rounding hides, the coefficients times what the pivots leave; the slope, and the curvature."""

    rounded: float
    loss: float
    hidden: float
    reach: float
    slope: np.ndarray
    curve: np.ndarray


def smoothed(residual: np.ndarray, round_off: float, cost: float, band: float) -> tuple[np.ndarray, np.ndarray]:
    """How far residuals lie outside the band, and the size of the coefficients: quadratic over the width of the rounding, then straight."""
    outside = np.maximum(np.abs(residual) - band, 0.0)
    return outside, np.minimum(outside / round_off, cost)


def rounded_loss(residual: np.ndarray, round_off: float, cost: float, band: float) -> float:
    outside, size = smoothed(residual, round_off, cost, band)
    return float(size @ outside - round_off / 2 * (size @ size))


class Rows:
    """Training rows in the coordinates of their pivots, kept if they are few enough."""

    def __init__(self, span: Span, x: np.ndarray, y: np.ndarray, rest: np.ndarray, cost: float, band: float) -> None:
        self.span, self.x, self.y, self.leak, self.cost, self.band = span, x, y, np.sqrt(rest), cost, band
        self.held = list(span.passes(x)) if len(x) * len(span.points) <= HELD else None

    def passes(self) -> Iterator[tuple[slice, np.ndarray]]:
        return iter(self.held) if self.held is not None else self.span.passes(self.x)

    def at(self, w: np.ndarray, bias: float, round_off: float) -> Sums:
        r = len(w)
        out = Sums(0.0, 0.0, 0.0, 0.0, np.zeros(r + 1), np.zeros((r + 1, r + 1)))
        for own, g in self.passes():
            residual = self.y[own] - g @ w - bias
            outside, size = smoothed(residual, round_off, self.cost, self.band)
            beta = np.copysign(size, residual)
            out.rounded += float(size @ outside - round_off / 2 * (size @ size))
            out.loss += self.cost * float(outside.sum())
            out.hidden += float((self.cost - size) @ outside)
            out.reach += float(self.leak[own] @ size)
            out.slope[:r] -= beta @ g
            out.slope[r] -= beta.sum()
            bent = (outside > 0) & (size < self.cost)
            some = g[bent]
            out.curve[:r, :r] += some.T @ some
            out.curve[:r, r] += some.sum(0)
            out.curve[r, r] += bent.sum()
        out.curve[r, :r] = out.curve[:r, r]
        out.curve /= round_off
        return out

    def line(self, w: np.ndarray, bias: float, dw: np.ndarray, db: float, round_off: float) -> np.ndarray:
        """The rounded loss at steps along a direction."""
        total = np.zeros(len(LINE))
        for own, g in self.passes():
            residual, change = self.y[own] - g @ w - bias, g @ dw + db
            total += [rounded_loss(residual - s * change, round_off, self.cost, self.band) for s in LINE]
        return total


def descend(rows: Rows, target: float, told: Callable[[str], None] | None = None) -> tuple[np.ndarray, float, float, float]:
    """Weights of the coordinates, bias, duality gap and primal. Widths narrow until the gap is below `target` of the primal, or rounding errors end it."""
    cost, r = rows.cost, len(rows.span.points)
    centre = float(np.median(rows.y))
    spread = max(float(np.abs(rows.y - centre).max()), 1e-12)
    w, bias, round_off, best = np.zeros(r), centre, spread / cost, None
    while True:
        here = rows.at(w, bias, round_off)
        value, steps = w @ w / 2 + here.rounded, 0
        while steps < NEWTON:
            steps += 1
            slope = here.slope.copy()
            slope[:r] += w
            curve = here.curve.copy()
            curve[np.arange(r), np.arange(r)] += 1.0
            curve[r, r] += cost / spread if curve[r, r] < cost / spread else 0.0
            move = -np.linalg.solve(curve, slope)
            gain = -float(slope @ move)
            # What this width has still to give is small against what its rounding hides.
            if gain <= 1e-3 * here.hidden or gain <= 1e-15 * value:
                break
            next_w, next_bias = w + move[:r], bias + float(move[r])
            there = rows.at(next_w, next_bias, round_off)
            if not next_w @ next_w / 2 + there.rounded <= value - 1e-4 * gain:
                lost = rows.line(w, bias, move[:r], float(move[r]), round_off)
                tried = [float((w + s * move[:r]) @ (w + s * move[:r])) / 2 + one for s, one in zip(LINE, lost, strict=True)]
                s = LINE[int(np.argmin(tried))]
                if not min(tried) < value:
                    break
                next_w, next_bias = w + s * move[:r], bias + float(s * move[r])
                there = rows.at(next_w, next_bias, round_off)
            w, bias, here, value = next_w, next_bias, there, next_w @ next_w / 2 + there.rounded
        # The dual's weights are sums of the coefficients; their total must be 0, and what is not counts with the spread.
        primal = float(w @ w / 2 + here.loss)
        apart = w + here.slope[:r]
        gap = float(apart @ apart / 2 + here.hidden + abs(here.slope[r]) * spread + here.reach ** 2 / 2)
        if told:
            told(f"width {round_off:.3g}: {steps} steps, gap {gap / max(primal, 1e-300):.3g} of the primal, rest {here.reach ** 2 / 2 / max(primal, 1e-300):.3g}")
        if best is None or gap < best[2]:
            best = w, bias, gap, primal
        if gap <= target * primal or round_off * cost <= 1e-12 * spread:
            return best
        if here.reach ** 2 / 2 > gap / 2:  # narrower widths cannot close what the pivots leave
            return best
        round_off *= NARROWER


def solve_spanned(x: np.ndarray, y: np.ndarray, gamma: float, cost: float, band: float, tolerance: float, most: int = PIVOTS) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """Pivots, their weights, bias and duality gap of the regression on all rows; nothing if too few rows span the others, or the gap stays above the tolerance."""
    span = spanning(x, gamma, min(most, len(x) // SHARE), max(REST / len(x), 1e-10))
    if span is None:
        return None
    rows = Rows(span[0], x, y, span[1], cost, band)
    w, bias, gap, primal = descend(rows, CLOSE * tolerance)
    if not gap <= tolerance * max(primal, 1e-12):
        return None
    return span[0].points, span[0].turn @ w, bias, gap
