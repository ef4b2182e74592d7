"""Minimal acyclic transducer from sorted words to their ordinals, held in arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Transducer(NamedTuple):
    """Transitions by ``256 state + byte``, where they lead, how many words they pass over, and which states end a word.

    The ordinal of a word is the sum of what its transitions pass over: the words that branch
    off before them. State 0 is the start.
    """

    keys: np.ndarray
    targets: np.ndarray
    passed: np.ndarray
    final: np.ndarray

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """Ordinal of each word, -1 where it is none of the transducer's; all words take a step at a time."""
        size = np.fromiter(map(len, words), dtype="i8", count=len(words))
        begin = np.cumsum(size) - size
        letters = np.frombuffer(b"".join(words), dtype="u1")
        state, total = np.zeros(len(words), dtype="i8"), np.zeros(len(words), dtype="i8")
        going, step = np.flatnonzero(size > 0), 0
        if not len(self.keys):
            return np.where((size == 0) & bool(self.final[:1].any()), 0, -1)
        while len(going):
            wanted = state[going] * 256 + letters[begin[going] + step]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            there = self.keys[at] == wanted
            state[going[~there]] = -1
            going, at = going[there], at[there]
            total[going] += self.passed[at]
            state[going] = self.targets[at]
            step += 1
            going = going[size[going] > step]
        return np.where((state >= 0) & self.final[state], total, -1)

    def word(self, ordinal: int) -> bytes:
        """The word of an ordinal, by the inverse walk."""
        state, word, left = 0, bytearray(), ordinal
        while True:
            first, stop = np.searchsorted(self.keys, (state * 256, state * 256 + 256))
            if left == 0 and self.final[state]:
                return bytes(word)
            at = first + int(np.searchsorted(self.passed[first:stop], left, side="right")) - 1
            word.append(int(self.keys[at]) & 255)
            left -= int(self.passed[at])
            state = int(self.targets[at])

    def packed(self) -> bytes:
        head = np.array([len(self.keys), len(self.final)], dtype="<i8")
        return b"".join(a.tobytes() for a in (head, self.keys, self.targets, self.passed, self.final))

    @classmethod
    def unpacked(cls, data: bytes) -> Transducer:
        n, states = np.frombuffer(data, dtype="<i8", count=2).tolist()
        numbers = np.frombuffer(data, dtype="<i8", offset=16, count=3 * n).reshape(3, n)
        return cls(*numbers, np.frombuffer(data, dtype=bool, offset=16 + 24 * n, count=states))


def build(words: list[bytes]) -> Transducer:
    """Transducer of strictly ascending words.

    A word leaves the path of the word before it where both part; what lies behind on that path
    can grow no more, and each of its states is replaced by an equal one met before, if any.
    """
    # A node is [ends a word, {byte: node or number of a finished state}].
    register: dict[tuple, int] = {}
    edges: list[list[tuple[int, int]]] = []
    ends: list[bool] = []
    path = [[False, {}]]

    def finish(node: list) -> int:
        shape = (node[0], tuple(node[1].items()))
        if shape not in register:
            register[shape] = len(edges)
            edges.append(sorted(node[1].items()))
            ends.append(node[0])
        return register[shape]

    before = b""
    for word in words:
        common = 0
        limit = min(len(word), len(before))
        while common < limit and word[common] == before[common]:
            common += 1
        for depth in range(len(before), common, -1):
            path[depth - 1][1][before[depth - 1]] = finish(path[depth])
        del path[common + 1 :]
        path += [[False, {}] for _ in range(len(word) - common)]
        path[-1][0] = True
        before = word
    for depth in range(len(before), 0, -1):
        path[depth - 1][1][before[depth - 1]] = finish(path[depth])
    start = finish(path[0])
    # Finished states have smaller numbers than those that lead to them; the start becomes 0.
    last = len(edges) - 1
    count, rows = [], []
    for state, own in enumerate(edges):
        passed = int(ends[state])
        for byte, target in own:
            rows.append(((last - state) * 256 + byte, last - target, passed))
            passed += count[target]
        count.append(passed)
    assert start == last
    table = np.array(sorted(rows), dtype="<i8").reshape(-1, 3).T
    return Transducer(*table.copy(), np.array(ends[::-1], dtype=bool))
