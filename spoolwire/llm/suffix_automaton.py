"""Generalised suffix automaton over sequences of word ids.

It accepts exactly the substrings of any one item. Every state knows the
items that contain its ``window``-word suffix, and the items shorter than a
window that end there.
"""

from __future__ import annotations

import numpy as np


class SuffixAutomaton:
    def __init__(self, sequences: list[list[int]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        owners: list[set[int]] = [set()]
        ends = []
        for item, seq in enumerate(sequences):
            last = 0
            for word in seq:
                last = self._extend(last, word, owners)
                owners[last].add(item)
            ends.append(last)
        by_length = sorted(range(1, len(self.next)), key=lambda v: -self.length[v])
        for v in by_length:
            if self.link[v] > 0:
                owners[self.link[v]] |= owners[v]
        # of each state: the ancestor that holds its window-word suffix, and the short items among its suffixes
        self.top = [0] * len(self.next)
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.next)
        own: dict[int, list[tuple[int, int]]] = {}
        for item, (seq, v) in enumerate(zip(sequences, ends, strict=True)):
            if 0 < len(seq) < window:
                own.setdefault(v, []).append((len(seq), item))
        for v in reversed(by_length):
            up = self.link[v]
            if self.length[v] >= window:
                self.top[v] = v if self.length[up] < window else self.top[up]
            self.short[v] = self.short[up] + tuple(own.get(v, ()))
        self.items = {v: tuple(sorted(owners[v])) for v in range(1, len(self.next)) if self.top[v] == v}

    def _extend(self, last: int, word: int, owners: list[set[int]]) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word, owners)
        cur = self._state({}, self.length[last] + 1, owners)
        p = last
        while p != -1 and word not in self.next[p]:
            self.next[p][word] = cur
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            q = self.next[p][word]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word, owners)
        return cur

    def _split(self, p: int, q: int, word: int, owners: list[set[int]]) -> int:
        clone = self._state(dict(self.next[q]), self.length[p] + 1, owners)
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _state(self, edges: dict[int, int], length: int, owners: list[set[int]]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        owners.append(set())
        return len(self.next) - 1

    def match(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit word ranges (end exclusive, in order of their ends) and the items found in ``words``."""
        spans, found, v, n = [], set(), 0, 0
        for i, word in enumerate(words):
            while v and word not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            v = self.next[v].get(word, 0)
            n = n + 1 if v else 0
            if n >= self.window:
                spans.append((i + 1 - n, i + 1))
                found.update(self.items[self.top[v]])
            for m, item in self.short[v]:
                if m <= n:
                    spans.append((i + 1 - m, i + 1))
                    found.add(item)
        return spans, found

    def pairs(self, sequences: list[list[int]]) -> np.ndarray:
        """Sorted distinct ``first << 32 | second`` of all neighbouring words of the items."""
        return np.unique(np.array([a << 32 | b for s in sequences for a, b in zip(s[:-1], s[1:], strict=True)], np.int64))
