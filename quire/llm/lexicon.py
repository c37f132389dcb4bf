"""A minimal acyclic transducer over byte strings, kept in flat arrays that workers memory-map.

Words share prefixes and suffixes in one automaton.  Every edge carries the
number of words that sort before those behind it, so a walk adds up the word's
place in the sorted word list; the outputs lie in a second array at that place.
"""

from __future__ import annotations

import numpy as np

MAGIC = 0x5155495245303031


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The file image for words and their output ids."""
    words = sorted(entries)
    # incremental construction: states behind the current word are final and merged through the register
    register: dict[tuple, int] = {}
    finished: list[tuple[bool, tuple]] = []  # (final, ((byte, state), ...)) of each state

    def settle(node: list) -> int:
        form = (node[0], tuple(node[1]))
        state = register.get(form)
        if state is None:
            state = register[form] = len(finished)
            finished.append(form)
        return state

    path: list[list] = [[False, []]]
    last = b""
    for word in words:
        k = 0
        while k < min(len(last), len(word)) and last[k] == word[k]:
            k += 1
        while len(path) > k + 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], settle(node)))
        path += [[False, []] for _ in word[k:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        node = path.pop()
        path[-1][1].append((last[len(path) - 1], settle(node)))
    root = settle(path[0])

    counts = np.zeros(len(finished), np.int64)
    keys, targets, skips = [], [], []
    for s, (final, edges) in enumerate(finished):  # targets come before their sources
        total = int(final)
        for byte, t in edges:
            keys.append(s << 8 | byte)
            targets.append(t)
            skips.append(total)
            total += int(counts[t])
        counts[s] = total
    finals = np.array([f for f, _ in finished], np.uint32)
    starts = np.cumsum([0, *(len(entries[w]) for w in words)]).astype(np.uint32)
    ids = np.array([i for w in words for i in entries[w]], np.uint32)
    parts = [np.array(keys, np.uint32), np.array(targets, np.uint32), np.array(skips, np.uint32), finals, starts, ids]
    head = np.array([MAGIC, root, *map(len, parts)], np.uint64)
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str) -> None:
        head = np.fromfile(path, np.uint64, 8)
        if int(head[0]) != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        self.root = int(head[1])
        body = np.memmap(path, np.uint32, "r", offset=64)
        cuts = np.cumsum([0, *head[2:].tolist()]).astype(np.int64)
        self.keys, self.targets, self.skips, self.finals, self.starts, self.ids = (body[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
        self.n_states = len(self.finals)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word among the sorted words, -1 if it is none; all words walk in step."""
        n = len(words)
        place = np.zeros(n, np.int64)
        if not n or not len(self.keys):
            return np.where(np.array([not w for w in words], bool) & bool(len(self.finals) and self.finals[self.root]), 0, -1)
        lengths = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        offset = np.cumsum(lengths) - lengths
        state = np.full(n, self.root, np.int64)
        walking = np.arange(n)
        step = 0
        while True:
            done = walking[lengths[walking] == step]
            place[done] = np.where(self.finals[state[done]] == 1, place[done], -1)
            walking = walking[lengths[walking] > step]
            if not len(walking):
                return place
            key = (state[walking] << 8 | flat[offset[walking] + step]).astype(np.uint32)
            e = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[e] == key
            place[walking[~ok]] = -1
            walking, e = walking[ok], e[ok]
            place[walking] += self.skips[e]
            state[walking] = self.targets[e]
            step += 1

    def output(self, place: int) -> list[int]:
        return self.ids[self.starts[place] : self.starts[place + 1]].tolist()
