"""Generalised suffix automaton over words of many short texts."""

from __future__ import annotations


class Automaton:
    """All word sequences that occur in the given items.

    ``scan`` follows a text word by word and keeps the length of the longest match that ends there.
    A window is ``window`` consecutive words of an item, or a whole shorter item.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                coded.append((item, ids))
                last = 0
                for c in ids:
                    last = self._extend(last, c)
        self.shortest = min([window, *(len(ids) for _, ids in coded)])
        # the state of the last `window` words of a longer match
        self.upper = [0] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            if self.length[state] >= window:
                above = self.link[state]
                self.upper[state] = state if self.length[above] < window else self.upper[above]
        self.items: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, object]]] = {}
        for item, ids in coded:
            state, size = 0, 0
            for c in ids:
                state, size = self.next[state][c], size + 1
                if size >= window:
                    self.items.setdefault(self.upper[state], set()).add(item)
            if size < window:
                self.short.setdefault(state, []).append((size, item))
        #: nearest state with short items, the state itself or up its links
        self.near = [-1] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            if state in self.short:
                self.near[state] = state
            elif state:
                self.near[state] = self.near[self.link[state]]

    def _state(self, length: int, link: int, next_: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(next_)
        return len(self.link) - 1

    def _split(self, state: int, c: int) -> int:
        """The state reached from ``state`` by ``c``, with exactly one word more."""
        target = self.next[state][c]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(c) == target:
            self.next[state][c] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and c not in self.next[state]:
            self.next[state][c] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, c)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word ranges covered by windows, merged and ascending, and the items they are from."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        known, shortest, done = self.vocabulary, self.shortest, 0
        if not known:
            return spans, items
        # each run of `shortest` known words holds one of these places
        for place in range(shortest - 1, len(words), shortest):
            if place < done or words[place] not in known:
                continue
            first, last = place, place + 1
            while first > done and words[first - 1] in known:
                first -= 1
            while last < len(words) and words[last] in known:
                last += 1
            done = last
            if last - first >= shortest:
                self._follow(words, first, last, spans, items)
        return spans, items

    def _follow(self, words, first, last, spans, items) -> None:
        state = size = 0
        window, known, next_, link = self.window, self.vocabulary, self.next, self.link
        for i in range(first, last):
            c = known[words[i]]
            while state and c not in next_[state]:
                state = link[state]
                size = self.length[state]
            if c not in next_[state]:
                continue
            state, size = next_[state][c], size + 1
            start = i + 1
            if size >= window:
                start = i + 1 - window
                items |= self.items[self.upper[state]]
            near = self.near[state]
            while near >= 0:
                for length, item in self.short[near]:
                    if size >= length:
                        items.add(item)
                        start = min(start, i + 1 - length)
                near = self.near[link[near]] if near else -1
            if start <= i:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
