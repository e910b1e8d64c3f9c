"""A linear chain of two labels: conditional random field with training and Viterbi decoding."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Chain:
    weights: dict[str, float]  # log-odds that a feature adds to label 1
    start: float  # log-odds of label 1 at the first place
    moves: tuple[tuple[float, float], tuple[float, float]]  # scores of label pairs

    def decode(self, scores: list[float]) -> list[int]:
        """The labels of largest total score; `scores` are the log-odds of label 1. Of equal paths the one with more 0 wins."""
        if not scores:
            return []
        best, back = [0.0, scores[0] + self.start], []
        for s in scores[1:]:
            came, now = [], []
            for label in (0, 1):
                a, b = best[0] + self.moves[0][label], best[1] + self.moves[1][label]
                came.append(int(b > a))
                now.append(max(a, b) + (s if label else 0.0))
            best = now
            back.append(came)
        label = int(best[1] > best[0])
        labels = [label]
        for came in reversed(back):
            label = came[label]
            labels.append(label)
        return labels[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], penalty: float = 0.02, steps: int = 200, rate: float = 0.2) -> Chain:
    """Maximise the penalised conditional likelihood of the labels by gradient steps; all chains are summed at once.

    Each page is a list of feature lists and a list of labels. Without pages every place gets label 0.
    """
    pages = [p for p in pages if p[0]]
    if not pages:
        return Chain({}, -1.0, ((0.0, 0.0), (0.0, 0.0)))
    names = sorted({f for features, _ in pages for place in features for f in place})
    number = {f: i for i, f in enumerate(names)}
    n, longest = len(pages), max(len(f) for f, _ in pages)
    flat = [(p * longest + t, number[f]) for p, (features, _) in enumerate(pages) for t, place in enumerate(features) for f in place]
    places, feature = (np.array(x, np.int64) for x in zip(*flat, strict=True)) if flat else (np.zeros(0, np.int64),) * 2
    size = np.array([len(f) for f, _ in pages])
    real = np.arange(longest) < size[:, None]
    gold = np.zeros((n, longest))
    for p, (_, labels) in enumerate(pages):
        gold[p, :len(labels)] = labels
    both = real[:, 1:]
    pairs = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & both).sum() for b in (0, 1)] for a in (0, 1)], float)
    params = np.zeros(len(names) + 5)
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, start, moves = params[:-5], params[-5], params[-4:].reshape(2, 2)
        score = np.bincount(places, w[feature], minlength=n * longest).reshape(n, longest)
        score[:, 0] += start
        node = np.stack([np.zeros_like(score), score], 2)
        ahead = np.zeros((n, longest, 2))
        behind = np.zeros((n, longest, 2))
        ahead[:, 0] = node[:, 0]
        for t in range(1, longest):
            went = np.logaddexp(ahead[:, t - 1, 0, None] + moves[0], ahead[:, t - 1, 1, None] + moves[1]) + node[:, t]
            ahead[:, t] = np.where(real[:, t, None], went, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            later = node[:, t + 1] + behind[:, t + 1]
            went = np.logaddexp(moves[:, 0] + later[:, 0, None], moves[:, 1] + later[:, 1, None])
            behind[:, t] = np.where(real[:, t + 1, None], went, behind[:, t])
        whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        one = np.where(real, np.exp(ahead[:, :, 1] + behind[:, :, 1] - whole[:, None]), 0.0)
        joint = np.exp(ahead[:, :-1, :, None] + moves + (node + behind)[:, 1:, None, :] - whole[:, None, None, None]) * both[:, :, None, None]
        slope = np.concatenate([
            np.bincount(feature, (np.where(real, gold, 0.0) - one).ravel()[places], minlength=len(names)),
            [(gold[:, 0] - one[:, 0]).sum()], (pairs - joint.sum((0, 1))).ravel(),
        ]) / n - penalty * params / 10
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope * slope
        params = params + rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8) * (1 - step / (steps + 1))
    moves = params[-4:].reshape(2, 2)
    return Chain(dict(zip(names, params[:-5].tolist(), strict=True)), float(params[-5]), tuple(tuple(map(float, m)) for m in moves))
