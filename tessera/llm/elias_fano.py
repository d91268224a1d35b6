"""Elias-Fano sequences and a two-level n-gram trie made of them, kept in memory-mapped files."""

from __future__ import annotations

import json

import numpy as np

#: Most lower bits of an element, so that eight bytes hold them at any bit offset.
LOWER = 56
#: Searches that are made together.
TOGETHER = 1 << 15


def encode_monotone(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Lower bits packed, and upper bits in unary: a one for each element, a zero for each step of the upper part."""
    n = len(values)
    low = min(LOWER, max(0, int(universe // max(n, 1)).bit_length() - 1))
    values = values.astype(np.uint64)
    shifts = np.arange(low, dtype=np.uint64)
    some = 1 << 16  # a multiple of eight, so that stretches end with whole bytes
    pack = lambda x: np.packbits(x, bitorder="little")
    lower = [pack(((values[i : i + some, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()) for i in range(0, n, some)] if low else []
    at = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros(64 * (int(at[-1]) // 64 + 1) if n else 0, np.uint8)
    bits[at] = 1
    return {"lower": np.concatenate([*lower, np.zeros(8, np.uint8)]), "upper": pack(bits).view("<u8"), "shape": np.array([n, low], np.int64)}


class EliasFano:
    """A monotone sequence. Beside its bits only counts of ones and zeros up to each word of the upper part are held."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.lower, self.upper = parts["lower"], parts["upper"]
        self.n, self.low = (int(x) for x in parts["shape"])
        self.ones = np.cumsum(np.bitwise_count(self.upper), dtype=np.int64)
        self.zeros = 64 * np.arange(1, len(self.upper) + 1) - self.ones

    def __len__(self) -> int:
        return self.n

    def _select(self, k: np.ndarray, one: int) -> np.ndarray:
        """Places of the kth bits (from 0) that are `one` in the upper part."""
        total = self.ones if one else self.zeros
        out = np.empty(len(k), np.int64)
        for i in range(0, len(k), TOGETHER):
            own = k[i : i + TOGETHER]
            at = np.searchsorted(total, own, side="right")
            rest = own - np.where(at > 0, total[np.maximum(at - 1, 0)], 0)
            word, place = np.asarray(self.upper[at]), 64 * at
            word = word if one else ~word
            for width in (32, 16, 8, 4, 2, 1):  # by halves, by their numbers of ones
                half = word & np.uint64((1 << width) - 1)
                there = np.bitwise_count(half)
                up = rest >= there
                place += width * up
                rest = rest - there * up
                word = np.where(up, word >> np.uint64(width), half)
            out[i : i + TOGETHER] = place
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        """Lower bits of elements."""
        if not self.low:
            return np.zeros(len(i), np.int64)
        bit = i * self.low
        raw = np.asarray(self.lower)[(bit >> 3)[:, None] + np.arange(8)]
        word = np.ascontiguousarray(raw).view("<u8")[:, 0] >> (bit & 7).astype(np.uint64)
        return (word & np.uint64((1 << self.low) - 1)).astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        """Elements by their places."""
        return ((self._select(i, 1) - i) << self.low) | self._low(i)

    def slice(self, i: int, j: int) -> np.ndarray:
        return self.at(np.arange(i, max(i, min(j, self.n))))

    def successors(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x the place of the first element that is at least x (n if there is none), and whether it is x.

        Zeros of the upper part bound the elements that share x's upper bits;
        among these the lower bits decide by binary search.
        """
        x = np.asarray(x, np.int64)
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        high, low = x >> self.low, x & ((1 << self.low) - 1)
        zeros = int(self.zeros[-1])
        edge = lambda h: np.where(h < 0, 0, np.where(h < zeros, self._select(np.clip(h, 0, max(zeros - 1, 0)), 0) - h, self.n)) if zeros else np.where(h < 0, 0, self.n)
        lo, hi = np.minimum(edge(high - 1), self.n), np.minimum(edge(high), self.n)
        end = hi.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < low[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        same = lo < end
        same[same] = self._low(lo[same]) == low[same]
        return lo, same

    def successor(self, x: int, i: int, j: int) -> int:
        """The first place in [i, j) whose element is at least x; j if there is none."""
        return int(np.clip(self.successors(np.array([x]))[0][0], i, j))


#: The least chance that has a code of its own; codes are spaced evenly by logarithm, and 0 stands for no chance.
LEAST = 1e-13


def quantise(chances: np.ndarray) -> np.ndarray:
    """One byte for each chance."""
    at = 255 + 254 * np.log(np.clip(chances, LEAST, 1.0)) / -np.log(LEAST)
    return np.where(chances > 0, np.maximum(np.round(at), 1), 0).astype(np.uint8)


#: The chance that each code stands for; never above 1.
LEVELS = np.concatenate(([0.0], LEAST ** ((255 - np.arange(1, 256)) / 254)))


class BigramTrie:
    """Contexts with the weight of what they leave to single words; their successors with a smoothed probability.

    Level one: context keys, a monotone sequence, each with the quantised weight
    of its back-off and a monotone pointer to its successors. Level two:
    successors as ranks among all words of the trie, relative to the context, so
    that all of them are one monotone sequence; beside it a byte for each, the
    quantised discounted probability. Keys have 63 bits.
    """

    def __init__(self, parts: dict[str, np.ndarray]):
        self.codes, self.weights = parts["codes"], parts["weights"]
        own = lambda name: EliasFano({k[4:]: v for k, v in parts.items() if k.startswith(name)})
        self.contexts, self.words, self.pointers, self.following = own("ctx_"), own("wrd_"), own("ptr_"), own("suc_")

    @staticmethod
    def build(context: np.ndarray, word: np.ndarray, chance: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """From distinct pairs in order of context and word, with their discounted probabilities, and the contexts' weights."""
        contexts, first = np.unique(context, return_index=True)
        words = np.unique(word)
        pointer = np.append(first, len(context)).astype(np.int64)
        owner = np.repeat(np.arange(len(contexts)), np.diff(pointer))
        place = owner * max(len(words), 1) + np.searchsorted(words, word)
        out = {"codes": quantise(chance), "weights": quantise(weight)}
        for name, values, universe in (("ctx", contexts, 1 << 63), ("wrd", words, 1 << 63), ("ptr", pointer, len(context) + 1), ("suc", place, max(1, len(contexts) * len(words)))):
            out |= {f"{name}_{k}": v for k, v in encode_monotone(values, universe).items()}
        return out

    @staticmethod
    def save(parts: dict[str, np.ndarray], path: str) -> None:
        """One file: a line that lists the arrays, then the arrays."""
        at, index = 0, {}
        for k, v in parts.items():
            index[k] = (at, v.dtype.str, len(v))
            at += -(-v.nbytes // 8) * 8
        head = json.dumps(index).encode()
        head += b" " * (-(len(head) + 1) % 8) + b"\n"
        with open(path, "wb") as f:
            f.write(head)
            for v in parts.values():
                f.write(v.tobytes() + bytes(-v.nbytes % 8))

    @staticmethod
    def open(path: str) -> BigramTrie:
        with open(path, "rb") as f:
            head = f.readline()
        data = np.memmap(path, np.uint8, "r")
        parts = {}
        for k, (at, kind, n) in json.loads(head).items():
            start = len(head) + at
            parts[k] = data[start : start + n * np.dtype(kind).itemsize].view(kind)
        return BigramTrie(parts)

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of pairs, and of their contexts' weights; 0 where they are absent.

        A pair is the successor of its own rank in the range that its context's
        pointer gives.
        """
        code, weight = np.zeros(len(context), np.uint8), np.zeros(len(context), np.uint8)
        if not len(self.contexts) or not len(context):
            return code, weight
        run = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))  # a context's pairs mostly stand together
        many = np.diff(np.append(run, len(context)))
        own, there = self.contexts.successors(context[run])
        own[~there] = 0
        begin, end = self.pointers.at(own), self.pointers.at(own + 1)
        i, known, begin, end = (np.repeat(x, many) for x in (own, there, begin, end))
        weight[known] = np.asarray(self.weights)[i[known]]
        distinct, inverse = np.unique(word, return_inverse=True)
        w, there = (x[inverse] for x in self.words.successors(distinct))
        both = np.flatnonzero(known & there)
        place, hit = self.following.successors(i[both] * len(self.words) + w[both])
        hit &= (place >= begin[both]) & (place < end[both])
        code[both[hit]] = np.asarray(self.codes)[place[hit]]
        return code, weight
