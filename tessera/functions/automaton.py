"""Many patterns looked up in long texts at once: an automaton over all of them, walked by many lanes of the text in step."""

from __future__ import annotations

import numpy as np

#: Lanes that walk together, and places that are held before only the first of each pattern and text are kept.
LANES, HELD = 2048, 1 << 20


class Automaton:
    """Aho-Corasick over byte strings, as arrays: where each state goes on each letter, which pattern ends in it, and its next suffix in which one ends."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.size = np.array([len(p) for p in patterns], np.int64)
        self.longest = int(self.size.max(initial=0))
        n = len(patterns)
        table = np.zeros((n, self.longest), np.uint8)
        for k, p in enumerate(patterns):
            table[k, : len(p)] = np.frombuffer(p, np.uint8)
        used = np.unique(table[np.arange(self.longest) < self.size[:, None]])
        #: A letter's column; all letters that no pattern has share the last one.
        self.letter = np.full(256, len(used), np.uint8 if len(used) < 255 else np.int64)
        self.letter[used] = np.arange(len(used))
        width = len(used) + 1
        table = self.letter[table]
        levels, edges, at, states = [], [], np.zeros(n, np.int64), 1
        for depth in range(self.longest):
            live = np.flatnonzero(self.size > depth)
            edge, of = np.unique(at[live] * width + table[live, depth], return_inverse=True)
            at[live] = states + of
            levels.append(np.arange(states, states + len(edge)))
            edges.append(edge)
            states += len(edge)
        self.go = np.zeros((states, width), np.int32)
        self.ends = np.full(states, -1, np.int32)
        self.ends[at] = np.arange(n)
        self.next = np.full(states, -1, np.int32)
        fail = np.zeros(states, np.int32)
        child = np.zeros((states, width), bool)
        for level, edge in zip(levels, edges):
            self.go.reshape(-1)[edge] = level
            child.reshape(-1)[edge] = True
        for depth, (level, edge) in enumerate(zip(levels, edges)):
            parent, letter = edge // width, edge % width
            if depth:
                fail[level] = self.go[fail[parent], letter]
            # a state without a child goes where its longest suffix goes, whose row is whole by now
            self.go[level] = np.where(child[level], self.go[level], self.go[fail[level]])
            self.next[level] = np.where(self.ends[fail[level]] >= 0, fail[level], self.next[fail[level]])
        self.next[self.next == 0] = -1
        self.some = (self.ends >= 0) | (self.next >= 0)

    def first_places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pattern, place from 0): each pattern's first place in each text that holds it."""
        found: list[np.ndarray] = [np.zeros((3, 0), np.int64)]
        if not self.longest or not any(texts):
            return tuple(found[0])
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        begins = np.r_[0, ends[:-1]]
        # lanes overlap by what a pattern can reach beyond one
        lane = max(8 * self.longest, 256, -(-len(data) // LANES))
        starts = [np.arange(b, e, lane) for b, e in zip(begins, ends)]
        text = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        start = np.concatenate(starts)
        held = 0
        for low in range(0, len(start), LANES):
            of, at = text[low : low + LANES], start[low : low + LANES]
            stop = np.minimum(at + lane + self.longest - 1, ends[of])
            order = np.argsort(at - stop, kind="stable")  # long lanes first, so that those that are done are the last
            of, at, stop = of[order], at[order], stop[order]
            state = np.zeros(len(at), np.int32)
            for _ in range(int((stop - at).max())):
                live = int(np.searchsorted(at - stop, 0, "left"))
                of, at, stop, state = of[:live], at[:live], stop[:live], state[:live]
                state = self.go[state, self.letter[data[at]]]
                at = at + 1
                hit = np.flatnonzero(self.some[state])
                if len(hit):
                    places = self._ending(state[hit], of[hit], at[hit] - begins[of[hit]])
                    found.append(places)
                    held += places.shape[1]
                    if held > HELD:
                        found = [_first(np.hstack(found))]
                        held = found[0].shape[1] // 2
        return tuple(_first(np.hstack(found)))

    def _ending(self, state: np.ndarray, of: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(text, pattern, place) of all patterns that end in states, by their suffixes as well."""
        parts = []
        while len(state):
            one = self.ends[state]
            own = one >= 0
            parts.append(np.stack([of[own], one[own], end[own] - self.size[one[own]]]))
            state = self.next[state]
            more = state >= 0
            state, of, end = state[more], of[more], end[more]
        return np.hstack(parts)


def _first(found: np.ndarray) -> np.ndarray:
    """The first place of each text and pattern."""
    found = found[:, np.lexsort((found[2], found[1], found[0]))]
    new = np.ones(found.shape[1], bool)
    new[1:] = (found[0, 1:] != found[0, :-1]) | (found[1, 1:] != found[1, :-1])
    return found[:, new]
