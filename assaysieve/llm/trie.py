"""Join of binary tries: pairs of 64-bit numbers that differ in few bits, as links that connect them."""

import numpy as np

PAIRS = 1 << 18  # node pairs handled at once
LEAF = 48  # pairs of numbers below a node pair from which they are compared directly


class Trie:
    """Sorted numbers; a node is a range of them with a common prefix."""

    def __init__(self, numbers: np.ndarray, first: int) -> None:
        self.numbers, self.first = numbers, first  # first: the place of these numbers among all that are joined

    def split(self, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
        """Where in each node the numbers with a set bit at this depth begin."""
        shift = np.uint64(63 - depth)
        border = ((self.numbers[low] >> shift) | np.uint64(1)) << shift
        return np.clip(np.searchsorted(self.numbers, border), low, high)


class Linked:
    """Which numbers are known to be connected."""

    def __init__(self, size: int) -> None:
        self.label = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        while True:
            open_ = a != b
            if not open_.any():
                return
            a, b = a[open_], b[open_]
            high, low = np.maximum(a, b), np.minimum(a, b)
            target = np.arange(self.label.size)
            np.minimum.at(target, high, low)
            while True:  # follow to the least label
                further = target[target]
                if np.array_equal(further, target):
                    break
                target = further
            self.label = target[self.label]
            a, b = target[a], target[b]


def join(left: Trie, right: Trie, frontier: tuple[np.ndarray, ...], depth: int, budget: int, first_half: int, linked: Linked) -> None:
    """Connect the numbers of node pairs that differ in at most `budget` bits, and in at most `first_half` of the first 32.

    `frontier` holds ranges of both tries and the bits in which their prefixes of `depth` bits differ. Node pairs are followed
    down together; a pair ends where its prefixes differ in too many bits, or where all below it is already connected. `left is right` joins a
    trie with itself; a node is then paired with itself or a later one.
    """
    stack = [(depth, *frontier)]
    while stack:
        depth, al, ah, bl, bh, bits = stack.pop()
        # Ranges whose numbers all have one label, and the same on both sides, hold nothing new.
        step = np.concatenate(([0], np.cumsum(linked.label[1:] != linked.label[:-1])))
        of = linked.label
        known = (step[left.first + al] == step[left.first + ah - 1]) & (step[right.first + bl] == step[right.first + bh - 1]) & (
            of[left.first + al] == of[right.first + bl])
        al, ah, bl, bh, bits = (x[~known] for x in (al, ah, bl, bh, bits))
        size = (ah - al) * (bh - bl)
        small = size <= LEAF if depth < 64 else np.ones(al.size, bool)
        if small.any():
            width = (bh - bl)[small]
            which = np.repeat(np.flatnonzero(small), size[small])
            begin = np.cumsum(size[small]) - size[small]
            at = np.arange(which.size) - np.repeat(begin, size[small])
            wide = np.repeat(width, size[small])
            a, b = al[which] + at // wide, bl[which] + at % wide
            near = np.bitwise_count(left.numbers[a] ^ right.numbers[b]) <= budget
            linked.add(left.first + a[near], right.first + b[near])
            al, ah, bl, bh, bits = (x[~small] for x in (al, ah, bl, bh, bits))
        if not al.size:
            continue
        am, bm = left.split(al, ah, depth), right.split(bl, bh, depth)
        same = (al == bl) & (ah == bh) if left is right else np.zeros(al.size, bool)
        parts = [(al, am, bl, bm, bits, None), (am, ah, bm, bh, bits, None), (al, am, bm, bh, bits + 1, None), (am, ah, bl, bm, bits + 1, ~same)]
        new = []
        for a0, a1, b0, b1, n, only in parts:
            keep = (a1 > a0) & (b1 > b0) & (n <= (first_half if depth < 32 else budget))
            new.append([x[keep if only is None else keep & only] for x in (a0, a1, b0, b1, n)])
        merged = [np.concatenate(x) for x in zip(*new, strict=True)]
        for begin in range(0, merged[0].size, PAIRS):
            stack.append((depth + 1, *(x[begin:begin + PAIRS] for x in merged)))


def nodes(numbers: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and prefix of the nodes at a depth."""
    prefix = numbers >> np.uint64(64 - depth) if depth else np.zeros(numbers.size, np.uint64)
    begin = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1]))) if numbers.size else np.zeros(0, np.int64)
    return begin, np.append(begin[1:], numbers.size).astype(np.int64) if numbers.size else begin, prefix[begin]
