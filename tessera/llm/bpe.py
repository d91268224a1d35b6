"""Byte-level BPE by backtracking, and decoding through an offset table.

A text is divided into pre-tokens with array operations. Each distinct
pre-token is encoded once per worker: an Aho-Corasick automaton gives the
longest vocabulary entry at every position, and a table of compatible pairs
tells whether two neighbouring tokens can stand in an exact merge result. When
no prefix of a match fits, the encoder steps back one token and marks the
position as dead, so that work stays linear in the length. The results equal
those of applying the merges in order.

Pre-tokens of up to 48 bytes move along the automaton's forward edges together,
as arrays; longer ones go through the automaton with its failure links, one by
one. Tokens of a pre-token are remembered by a 64-bit hash of it alone: of a
million pre-tokens two share one with a chance of 3 * 10 ** -8.

Nulls and empty texts give no tokens; an empty table gives no blocks. Texts are
encoded whole. The text of an added token gives that token's id, as the
tokenizers library does by default.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex

from .inttable import IntTable
from .textcore import Block, blocks, ragged, span_hashes

#: Bytes of tokens and keys that a worker remembers before it starts afresh.
CACHE_BYTES = 24 << 20
#: Pairs of tokens whose compatibility a worker remembers before it starts afresh.
PAIRS = 300_000
#: Pre-tokens of up to so many bytes are encoded together, longer ones one by one.
TOGETHER = 48
LETTER, NUMBER, BLANK, OTHER = range(4)
#: Suffixes that the public byte-level pattern splits off after an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def character_classes(path: str) -> np.ndarray:
    """Class of every code point. The tokenizer file's own pre-tokenizer settles which are letters and numbers."""
    from tokenizers import Tokenizer

    table = np.full(0x110000, OTHER, np.uint8)
    split = Tokenizer.from_file(path).pre_tokenizer
    for first in range(0, 0x110000, 1 << 13):  # in stretches, so that little memory is taken
        stretch = "".join(chr(c) for c in range(first, first + (1 << 13)) if not 0xD800 <= c < 0xE000)
        for kind, pattern, lead in ((LETTER, r"\p{L}", "a"), (NUMBER, r"\p{N}", "1")):
            members = regex.findall(pattern, stretch)
            probe = "".join(f"!{lead}{c}" for c in members)
            joined = {a for _, (a, b) in split.pre_tokenize_str(probe) if b - a == 2}
            table[[ord(c) for i, c in enumerate(members) if 3 * i + 1 in joined]] = kind
        table[[ord(c) for c in regex.findall(r"\s", stretch)]] = BLANK
    return table


class Vocabulary:
    """A byte-level BPE vocabulary, its pair table, automaton and offset table."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        raw = {t: bytes(alphabet[c] for c in t) for t in vocab if t not in self.added}
        self.ids = {b: vocab[t] for t, b in raw.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            whole = vocab[a + b]
            self.merged[vocab[a], vocab[b]] = (rank, whole)
            self.halves.setdefault(whole, (vocab[a], vocab[b]))
        #: Order in which tokens arise: single bytes first, then by rank of the merge that makes them.
        self.order = {i: -1 for i in self.ids.values()}
        for (_, _), (rank, whole) in self.merged.items():
            if self.order[whole] < 0 and self.halves.get(whole):
                self.order[whole] = rank
        size = max([*self.ids.values(), *self.added.values()]) + 1
        pieces = [b""] * size
        for b, i in self.ids.items():
            pieces[i] = b
        for text, i in self.added.items():
            pieces[i] = text.encode()
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.offset = np.concatenate(([0], np.cumsum(self.length)[:-1]))
        self.store = np.frombuffer(b"".join(pieces), np.uint8)
        self.lengths = self.length.tolist()
        self.decimal = [str(i) for i in range(size)]
        self.shorter: dict[int, int] = {}
        for b, i in self.ids.items():
            for n in range(len(b) - 1, 0, -1):
                if (j := self.ids.get(b[:n])) is not None:
                    self.shorter[i] = j
                    break
        self.automaton = ahocorasick.Automaton()
        for b, i in self.ids.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b) - 1))
        self.automaton.make_automaton()
        self.compatible_pairs = lru_cache(maxsize=1 << 14)(self.compatible)
        self.whole = self.ids | {t.encode(): i for t, i in self.added.items()}
        self.pair_table, self.pair_ok = IntTable(), np.zeros(0, bool)
        self.shorter_token = np.full(size, -1, np.int64)
        self.shorter_token[list(self.shorter)] = list(self.shorter.values())
        self._arrays()

    def _arrays(self) -> None:
        """The automaton's forward edges as arrays."""
        edges: dict[int, int] = {}
        tokens = [-1]
        for b, i in self.ids.items():
            node = 0
            for byte in b:
                key = node << 8 | byte
                nxt = edges.get(key)
                if nxt is None:
                    nxt = edges[key] = len(tokens)
                    tokens.append(-1)
                node = nxt
            tokens[node] = i
        self.node_token = np.array(tokens, np.int32)
        self.edges = IntTable(19)
        self.edges.add(np.array(list(edges), np.uint64))
        self.edge_child = np.array(list(edges.values()), np.int64)
        self.root_child = np.array([edges.get(b, -1) for b in range(256)], np.int32)
        self.root_token = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b, in order of rank, leaves exactly the tokens a and b.

        Along the seam the right edge of a and the left edge of b are taken
        apart, latest merge first. At each stage the two parts that touch must
        not have a merge that would have come before the merge undone last.
        """
        left, right, limit, ok = a, b, 1 << 60, True
        order, halves, merged = self.order, self.halves, self.merged
        while True:
            hit = merged.get((left, right))
            if hit is not None and hit[0] < limit:
                ok = False
                break
            x, y = order[left], order[right]
            if x < 0 and y < 0:
                break
            if x > y:
                limit, left = x, halves[left][1]
            else:  # of equal ranks the left one is made first, and a merge across the seam too
                limit, right = y + 1, halves[right][0]
        return ok

    def compatible_all(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """compatible() of arrays, through the table of pairs met so far."""
        keys = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
        at = self.pair_table.find(keys)
        if (at < 0).any():
            if len(self.pair_table) > PAIRS:
                self.pair_table, self.pair_ok = IntTable(), np.zeros(0, bool)
                at[:] = -1
            new = np.unique(keys[at < 0])
            told = [self.compatible(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in new.tolist()]
            self.pair_table.add(new)
            self.pair_ok = np.concatenate((self.pair_ok, np.array(told, bool)))
            at = self.pair_table.find(keys)
        return self.pair_ok[at]

    def longest_matches(self, data: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The longest token that begins at each byte and ends by stop: the automaton's forward edges, followed from all bytes at once."""
        best = self.root_token[data]
        at = np.arange(len(data))
        node = self.root_child[data]
        live = np.flatnonzero((node >= 0) & (at + 1 < stop))
        node, at = node[live].astype(np.int64), live + 1
        while len(live):
            edge = self.edges.find((node.astype(np.uint64) << np.uint64(8)) | data[at].astype(np.uint64))
            go = edge >= 0
            live, at, edge = live[go], at[go] + 1, edge[go]
            node = self.edge_child[edge]
            token = self.node_token[node]
            found = token >= 0
            best[live[found]] = token[found]
            more = at < stop[live]
            live, at, node = live[more], at[more], node[more]
        return best

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """encode_piece() of each: all ids, and how many each has. Short pieces move forward and back together."""
        ids = self.whole
        whole = np.array([ids.get(p, -1) for p in pieces], np.int32)
        sizes = np.ones(len(pieces), np.int64)
        long = {i: self.encode_piece(pieces[i]) for i in np.flatnonzero(whole < 0).tolist() if len(pieces[i]) > TOGETHER}
        sizes[list(long)] = [len(x) for x in long.values()]
        short = np.array([i for i in np.flatnonzero(whole < 0).tolist() if i not in long], np.int64)
        tokens = self._together([pieces[i] for i in short.tolist()]) if len(short) else None
        if tokens is not None:
            sizes[short] = tokens[1]
        begin = np.concatenate(([0], np.cumsum(sizes)))
        out = np.zeros(begin[-1], np.int32)
        out[begin[:-1][whole >= 0]] = whole[whole >= 0]
        for i, x in long.items():
            out[begin[i] : begin[i + 1]] = x
        if tokens is not None:
            out[ragged(begin[short], tokens[1])] = tokens[0]
        return out, sizes

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        short = pieces
        base = np.concatenate(([0], np.cumsum(size)[:-1]))
        longest = self.longest_matches(data, np.repeat(base + size, size))
        width = int(size.max()) + 1
        alive = np.ones((len(short), width), bool)
        stack = np.zeros((len(short), width), np.int32)
        depth, at = np.zeros(len(short), np.int64), np.zeros(len(short), np.int64)
        token = longest[base].astype(np.int64)
        live = np.arange(len(short))
        length, shorter = self.length, self.shorter_token
        while len(live):
            t, d, p = token[live], depth[live], at[live]
            last = np.where(d > 0, stack[live, np.maximum(d - 1, 0)], -1)
            end = p + length[t]
            fits = alive[live, end]
            check = np.flatnonzero(fits & (last >= 0))
            if len(check):
                fits[check] = self.compatible_all(last[check], t[check])
            yes, no = live[fits], live[~fits]
            stack[yes, d[fits]] = t[fits]
            depth[yes] += 1
            at[yes] = end[fits]
            inside = yes[at[yes] < size[yes]]
            token[inside] = longest[base[inside] + at[inside]]
            less = shorter[t[~fits]]
            token[no] = less
            back, popped = no[less < 0], last[~fits][less < 0]
            alive[back, at[back]] = False
            depth[back] -= 1
            token[back] = popped
            at[back] -= length[popped]
            live = live[at[live] < size[live]]
        return stack[np.arange(width) < depth[:, None]], depth

    def encode_piece(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * (n + 1)
        for end, (token, back) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - back] = token  # matches with one start come in order of length
        alive = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        lengths, shorter, compatible = self.lengths, self.shorter, self.compatible_pairs
        while at < n:
            last = out[-1] if out else -1
            while True:
                end = at + lengths[token]
                if alive[end] and (last < 0 or compatible(last, token)):
                    out.append(token)
                    at, token = end, longest[end]
                    break
                token = shorter.get(token, -1)
                if token < 0:
                    alive[at] = 0
                    token = out.pop()
                    at -= lengths[token]
                    break
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def classes(path: str) -> np.ndarray:
    return character_classes(path)


class Encoder:
    """Encodes blocks of texts; remembers the tokens of pre-tokens it has met."""

    def __init__(self, path: str, cache: int = CACHE_BYTES):
        self.vocab, self.table, self.limit = vocabulary(path), classes(path), cache
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.vocab.added, key=len, reverse=True)).encode()) if self.vocab.added else None
        self._forget()

    def _forget(self) -> None:
        self.known = IntTable(16)
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0

    def pieces(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of the block; starts and ends of its pre-tokens in them; the texts' offsets in them."""
        text = block.raw.decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        if n == len(block.raw):
            at = block.offsets
            place = lambda x: x
        else:
            before = np.zeros(len(block.raw) + 1, np.int64)
            np.cumsum((block.bytes & 0xC0) != 0x80, out=before[1:])
            at = before[block.offsets]
            place = lambda x: before[x]
        fences = at
        specials: list[tuple[int, int]] = []
        if self.special is not None:
            specials = [m.span() for m in self.special.finditer(block.raw)]
            rows = np.array(specials, np.int64).reshape(-1, 2)
            if len(rows):
                own = block.rows_of(rows[:, 0]) == block.rows_of(rows[:, 1] - 1)
                rows = place(rows[own])
                fences = np.union1d(at, rows.ravel())
                specials = [tuple(x) for x in rows.tolist()]
        if not n:
            zero = np.zeros(0, np.int64)
            return points, zero, zero, at
        kind = self.table[points]
        begin = np.empty(n, bool)
        begin[0] = True
        np.not_equal(kind[1:], kind[:-1], out=begin[1:])
        begin[fences[fences < n]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], n)
        fence = np.zeros(n + 1, bool)
        fence[fences] = True
        run = kind[starts]
        # White space before anything but a fence gives its last character away.
        blank = (run == BLANK) & ~fence[ends]
        last = ends[blank] - 1
        begin[last] = True
        attached = last[points[last] == 0x20] + 1
        begin[attached] = False
        # An apostrophe alone, not after a space of its own, takes a contraction's letters.
        quote = (run == OTHER) & (ends - starts == 1)
        quote &= points[starts] == 0x27
        quote &= begin[starts]
        quote[:-1] &= (run[1:] == LETTER) & ~fence[ends[:-1]]
        if len(quote):
            quote[-1] = False
        for i in np.flatnonzero(quote):
            p, stop = int(starts[i]) + 1, int(ends[i + 1])
            word = text[p : min(stop, p + 2)]
            for c in CONTRACTIONS:
                if word.startswith(c):
                    begin[p] = False
                    if p + len(c) < stop:
                        begin[p + len(c)] = True
                    break
        for a, b in specials:
            begin[a + 1 : b] = False
            begin[a] = True
        starts = np.flatnonzero(begin)
        return points, starts, np.append(starts[1:], n), at

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in the block, and where each text's begin."""
        points, starts, ends, at = self.pieces(block)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(block.n + 1, np.int64)
        keys = span_hashes(points, starts, ends)
        entry = self.known.find(keys)
        miss = np.flatnonzero(entry < 0)
        if len(miss):
            new, first = np.unique(keys[miss], return_index=True)
            if 60 * (len(self.known) + len(new)) + 8 * self.used > self.limit and len(self.known):
                self._forget()
                new, first = np.unique(keys, return_index=True)
                miss = np.arange(len(keys))
            first = miss[first]
            lead = np.append(np.flatnonzero((block.bytes & 0xC0) != 0x80), len(block.raw)) if len(points) < len(block.raw) else np.arange(len(points) + 1)
            self._learn(new, [block.raw[a:b] for a, b in zip(lead[starts[first]].tolist(), lead[ends[first]].tolist(), strict=True)])
            entry[miss] = self.known.find(keys[miss])
        sizes = self.sizes[entry].astype(np.int64)
        ids = self.flat[ragged(self.starts[entry], sizes)]
        total = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        return ids, total[np.searchsorted(starts, at)]

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        flat, sizes = self.vocab.encode_pieces(pieces)
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while len(self.known) + len(keys) > len(self.sizes):
            self.starts, self.sizes = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.sizes))
        self.flat[self.used : self.used + len(flat)] = flat
        at = self.known.add(keys)
        self.starts[at], self.sizes[at] = self.used + np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes
        self.used += len(flat)


def decode_bytes(vocab: Vocabulary, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bytes of all ids, one after another, and where each id's bytes begin."""
    sizes = vocab.length[ids]
    begin = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(sizes, out=begin[1:])
    return vocab.store[ragged(vocab.offset[ids], sizes)].tobytes(), begin


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_column(column, path: str):
    """For each block of a string column: the block, its token ids and the texts' offsets in them."""
    tool = encoder(path)
    for block in blocks(column):
        yield block, *tool.encode(block)
