"""A growing hash table from 64-bit keys to positions, looked up and filled by whole arrays."""

from __future__ import annotations

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class IntTable:
    """Linear probing over arrays; the value of a key is the order in which it was added. Keys must be new and distinct when added."""

    def __init__(self, bits: int = 12):
        self._clear(bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.n = 0

    def _clear(self, bits: int) -> None:
        self.bits = bits
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)

    def __len__(self) -> int:
        return self.n

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys; -1 where absent."""
        slot = ((keys * _FACTOR) >> self.shift).astype(np.int64)
        out = self.values[slot]
        wrong = np.flatnonzero((out >= 0) & (self.slots[slot] != keys))
        mask = (1 << self.bits) - 1
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & mask
            s = slot[wrong]
            got = self.values[s]
            out[wrong] = got
            wrong = wrong[(got >= 0) & (self.slots[s] != keys[wrong])]
        return out

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Add new keys; their positions."""
        first = self.n
        while self.n + len(keys) > len(self.keys):
            self.keys = np.concatenate((self.keys, np.zeros_like(self.keys)))
        self.keys[first : first + len(keys)] = keys
        self.n += len(keys)
        if 2 * self.n > 1 << self.bits:
            bits = self.bits
            while 3 * self.n > 1 << bits:
                bits += 1
            self._clear(bits)
            self._place(self.keys[: self.n], np.arange(self.n, dtype=np.int32))
        else:
            self._place(keys, np.arange(first, self.n, dtype=np.int32))
        return np.arange(first, self.n)

    def _place(self, keys: np.ndarray, values: np.ndarray) -> None:
        slot = ((keys * _FACTOR) >> self.shift).astype(np.int64)
        mask = (1 << self.bits) - 1
        todo = np.arange(len(keys))
        while len(todo):
            s = slot[todo]
            free = self.values[s] < 0
            self.values[s[free]] = values[todo[free]]  # of several that want one slot the last stays
            won = self.values[s] == values[todo]
            self.slots[s[won]] = keys[todo[won]]
            todo = todo[~won]
            slot[todo] = (slot[todo] + 1) & mask
