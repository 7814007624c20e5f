"""Hashes of word shingles for many texts at once.

A word is a run of characters other than ASCII white space, in lower case. A shingle is five words in
a row; a text of one to four words has one shingle of all its words, a text without words has none.
"""

from __future__ import annotations

import numpy as np

from parlance.llm.tokens import SliceHash, mixed

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
BLOCK_BYTES = 400_000


class Shingler:
    def __init__(self, words: int = 5):
        self.words = words
        self.hash = SliceHash(0x9E3779B97F4A7C15)

    def hashes(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text the hashes of its shingles in order, repeats included."""
        out, block, size = [], [], 0
        for t in texts:
            data = (t or "").lower().encode("utf-8", "surrogatepass")
            if block and size + len(data) > BLOCK_BYTES:
                out += self._block(block)
                block, size = [], 0
            block.append(data)
            size += len(data) + 1
        return out + (self._block(block) if block else [])

    def _block(self, texts: list[bytes]) -> list[np.ndarray]:
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        space = _SPACE[data]
        begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        ends = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
        word = self.hash.slices(data, begins, ends)
        edges = np.cumsum([len(t) + 1 for t in texts])
        last = np.searchsorted(begins, edges)  # words before the end of each text
        first = np.concatenate([[0], last[:-1]])
        n, k = len(word), self.words
        rolled = np.zeros(max(n - k + 1, 0), dtype=np.uint64)
        for j in range(k):
            rolled = rolled * np.uint64(0x100000001B3) + word[j : n - k + 1 + j]
        rolled = mixed(rolled)
        out = []
        for b, e in zip(first.tolist(), last.tolist(), strict=True):
            if e - b >= k:
                out.append(rolled[b : e - k + 1])
            elif e > b:
                h = np.uint64(e - b)
                for w in word[b:e]:
                    h = np.uint64((int(h) * 0x100000001B3 + int(w)) & 0xFFFFFFFFFFFFFFFF)
                out.append(mixed(np.array([h], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
        return out
