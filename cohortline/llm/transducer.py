"""A minimal acyclic transducer: a set of byte strings in sorted order, each with its lexicographic ordinal.

Built incrementally from the sorted strings: what lies below the common prefix with the next string is final, so its
states are looked up among the equal ones seen before. A state knows how many strings it accepts, and an arc adds the number
of those that come before it: the sum along a path is the string's ordinal. Strings are streamed through it many at a
time, one byte position after another.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    def __init__(self, words: Iterable[bytes]):
        """``words``: distinct and in ascending order; ``ValueError`` if they are not."""
        register: dict[tuple, int] = {}
        self.states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        counts: list[int] = []

        def settled(state: list) -> int:
            key = (state[0], tuple(state[1]))
            found = register.get(key)
            if found is None:
                found = register[key] = len(counts)
                self.states.append(key)
                counts.append(key[0] + sum(counts[target] for _, target in key[1]))
            return found

        path: list[list] = [[False, []]]
        previous = None
        for word in words:
            shared = 0
            if previous is not None:
                if word <= previous:
                    raise ValueError("the strings must be distinct and sorted")
                for a, b in zip(previous, word):
                    if a != b:
                        break
                    shared += 1
            while len(path) > shared + 1:
                state = path.pop()
                path[-1][1].append((previous[len(path) - 1], settled(state)))
            for _ in word[shared:]:
                path.append([False, []])
            path[-1][0] = True
            previous = word
        while len(path) > 1:
            state = path.pop()
            path[-1][1].append((previous[len(path) - 1], settled(state)))
        self.root = settled(path[0])
        self.size = counts[self.root]
        keys, targets, adds = [], [], []
        for state, (final, arcs) in enumerate(self.states):
            before = int(final)
            for label, target in arcs:
                keys.append(state << 8 | label)
                targets.append(target)
                adds.append(before)
                before += counts[target]
        # States are numbered and arcs of a state are made in ascending order, so the keys are sorted.
        self.keys = np.array(keys, np.int64)
        self.targets = np.array(targets, np.int64)
        self.adds = np.array(adds, np.int64)
        self.final = np.array([final for final, _ in self.states], bool)

    def ordinals(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ordinal of each string ``data[start : start + size]``, -1 for those that are not in the set."""
        out = np.full(len(starts), -1, np.int64)
        own, state, total, i = np.arange(len(starts)), np.full(len(starts), self.root), np.zeros(len(starts), np.int64), 0
        while len(own):
            ended = sizes[own] == i
            whole = ended & self.final[state]
            out[own[whole]] = total[whole]
            own, state, total = own[~ended], state[~ended], total[~ended]
            if not len(own) or not len(self.keys):
                break
            key = state << 8 | data[starts[own] + i]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            found = self.keys[at] == key
            own, at = own[found], at[found]
            state, total = self.targets[at], total[found] + self.adds[at]
            i += 1
        return out
