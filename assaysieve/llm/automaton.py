"""Generalised suffix automaton over word numbers, and a scanner that streams texts through it.

The automaton holds all word sequences that occur in any of the given items. Streaming a text gives its matching
statistics: at every word, the longest sequence ending there that occurs in an item, as a state and a length.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np


class Automaton:
    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, like: int | None = None) -> int:
        self.step.append({} if like is None else dict(self.step[like]))
        self.link.append(-1 if like is None else self.link[like])
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, word: int) -> int:
        """The state reached from p by word that holds no longer sequences than p's longest plus the word."""
        q = self.step[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, like=q)
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, words: Iterable[int]) -> None:
        """Insert one item. Each item starts anew at the root, so no sequence runs from one item into the next."""
        last = 0
        for word in words:
            if word in self.step[last]:
                last = self._split(last, word)
                continue
            new, p = self._state(self.length[last] + 1), last
            while p >= 0 and word not in self.step[p]:
                self.step[p][word] = new
                p = self.link[p]
            self.link[new] = self._split(p, word) if p >= 0 else 0
            last = new

    def stream(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        step, link, length = self.step, self.link, self.length
        state = n = 0
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                n = length[state]
            if word in step[state]:
                state = step[state][word]
                n += 1
            yield state, n

    def suffix(self, state: int, size: int) -> int:
        """The state of the last `size` words of any sequence of `state` that has at least so many."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state


class Scanner:
    """Finds where texts share at least `least` consecutive words with the items.

    A match of two or more words consists of word pairs of the items. One array operation marks these pairs in all
    texts of a piece; only the runs of marked pairs with enough words are streamed through the automaton. A match cannot reach
    beyond its run, so the matching statistics inside are the true ones.
    """

    def __init__(self, items: list[list[bytes]], least: int) -> None:
        self.least = max(1, least)
        self.number: dict[bytes, int] = {}
        self.items = [[self.number.setdefault(w, len(self.number)) for w in words] for words in items]
        self.automaton = Automaton()
        pairs = set()
        for words in self.items:
            self.automaton.add(words)
            pairs.update(a * len(self.number) + b for a, b in zip(words, words[1:], strict=False))
        self.pairs = np.array(sorted(pairs), np.int64)

    def runs(self, texts: list[str | None], split: Callable[[str | None], list[bytes]]) -> tuple[list[int], dict[int, list[tuple[int, list[int]]]]]:
        """Words per text, and per text number the candidate runs as (first word, word numbers)."""
        found: dict[int, list[tuple[int, list[int]]]] = {}
        number, parts, sizes = self.number.get, [], []
        for text in texts:
            words = split(text)
            sizes.append(len(words))
            parts.append(np.fromiter((number(w, -1) for w in words), np.int64, len(words)))
            parts.append(np.array([-1], np.int64))  # no pair spans two texts
        if not self.items or not parts:
            return sizes, found
        ids = np.concatenate(parts)
        known = ids >= 0
        if self.pairs.size:
            code = ids[:-1] * len(self.number) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, code), self.pairs.size - 1)
            joined = known[:-1] & known[1:] & (self.pairs[at] == code)
        else:
            joined = np.zeros(max(ids.size - 1, 0), bool)
        begins = np.flatnonzero(known & ~np.concatenate(([False], joined)))
        ends = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
        wide = ends - begins >= self.least
        starts = np.concatenate(([0], np.cumsum(np.array(sizes, np.int64) + 1)))
        begins, ends = begins[wide], ends[wide]
        for text, begin, end in zip(np.searchsorted(starts, begins, "right") - 1, begins, ends, strict=True):
            found.setdefault(int(text), []).append((int(begin - starts[text]), ids[begin:end].tolist()))
        return sizes, found
